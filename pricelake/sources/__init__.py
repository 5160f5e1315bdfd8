"""Inputs derived from the driver tables, and file sources and sinks."""
