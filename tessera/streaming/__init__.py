"""Structured Streaming forms of the reference's polling loop: STR-1..4."""
