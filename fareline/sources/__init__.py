"""Readers, writers and tables on files."""
