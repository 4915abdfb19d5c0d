"""Reusable relational operators: DataFrame in, DataFrame out, lazy unless stated."""
