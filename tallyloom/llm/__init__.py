"""Operators for large text corpora: quality, duplicates, contamination, packing, token files."""
