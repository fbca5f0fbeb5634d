"""Incremental loads of landed files."""
