"""Incremental runs over files and tables."""
