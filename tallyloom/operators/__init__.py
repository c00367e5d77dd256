"""Operators over events, rules and results."""
