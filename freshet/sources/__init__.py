"""Batch and streaming inputs, and the table sinks."""
