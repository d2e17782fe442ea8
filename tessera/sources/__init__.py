"""Schemas, readers, writers and the extraction manifest."""
