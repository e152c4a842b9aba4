"""Declared schemas, readers and writers, data-quality rules, test-data adapter."""
