"""Readers of landed files and sinks."""
