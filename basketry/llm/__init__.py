"""Operators for training text, their queries and SQL. Nothing outside imports this package."""
