"""Structured Streaming jobs. Every one can run to the end of its input and stop."""
