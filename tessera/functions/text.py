"""PRJ-6: per-group value rules (replace, add suffix, add prefix) in config order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def apply_value_rules(c: Column, rules: dict) -> Column:
    """Apply the rules of one group in the order their keys appear."""
    for op, arg in rules.items():
        if op == "replace":
            for pair in arg if isinstance(arg, list) else [arg]:
                c = F.replace(c, F.lit(pair["old"]), F.lit(pair["new"]))
        elif op == "add suffix":
            c = F.concat(c, F.lit(arg))
        elif op == "add prefix":
            c = F.concat(F.lit(arg), c)
        else:
            raise ValueError(f"unknown value rule {op!r}")
    return c
