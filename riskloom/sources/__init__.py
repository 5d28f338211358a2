"""Readers: landed files, event bus, tables."""
