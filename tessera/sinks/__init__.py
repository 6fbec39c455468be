"""Catalog sinks SNK-1..5."""

from tessera.sinks.writers import publish, write_csv, write_json, write_parquet

__all__ = ["publish", "write_csv", "write_json", "write_parquet"]
