"""Composite plans PIP-1..3 and the versioned catalog store."""
