"""File trees as tables: bulk listing, routing, comparing and copying on Spark."""
