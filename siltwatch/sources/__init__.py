"""Readers, table schemas and sinks."""
