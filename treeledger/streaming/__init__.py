"""Byte streams of files: reading, committing and overwriting contents in bulk batch jobs."""
