"""Readers: invoice documents, message topics, layer files, and the given tables."""
