"""Operators that take and give DataFrames."""
