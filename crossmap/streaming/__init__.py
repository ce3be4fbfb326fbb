"""Incremental runs over arriving framework files."""
