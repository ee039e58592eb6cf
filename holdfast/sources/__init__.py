"""Readers, table layout and sinks."""
