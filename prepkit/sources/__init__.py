"""Readers, writers and the table-to-table stage helper."""
