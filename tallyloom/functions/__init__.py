"""Column expressions: numbers, windows, keys, text."""
