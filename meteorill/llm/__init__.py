"""Operators and queries for preparing training text, and the tables they share."""
