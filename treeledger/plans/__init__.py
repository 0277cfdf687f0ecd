"""Whole jobs composed of operators: serving listings, planning writes and copies."""
