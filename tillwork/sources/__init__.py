"""Readers of landed data and dated sinks."""
