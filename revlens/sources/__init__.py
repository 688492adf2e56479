"""Readers, row keys and sinks."""
