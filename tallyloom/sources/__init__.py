"""Readers: event lines, tables, rules, JSON and CSV rows, topics."""
