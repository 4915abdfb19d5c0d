"""Readers and writers for extracts, tables and load reports."""
