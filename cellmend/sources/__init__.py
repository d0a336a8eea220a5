"""Readers and writers: delimited text, JSON, file listings, inventories."""
