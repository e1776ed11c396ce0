"""Schemas, readers, writers and test-data adapters."""
