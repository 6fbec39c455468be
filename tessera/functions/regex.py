"""Python-style named groups on the JVM regex engine (PRJ-5)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_NAMED = re.compile(r"\(\?P<([A-Za-z_][A-Za-z0-9_]*)>")
_BACK = re.compile(r"\(\?P=([A-Za-z_][A-Za-z0-9_]*)\)")


def group_names(pattern: str) -> list[str]:
    """Named groups of a Python pattern, in group-index order."""
    gi = re.compile(pattern).groupindex
    return sorted(gi, key=gi.get)


def to_java_pattern(pattern: str) -> tuple[str, dict[str, int]]:
    """Rewrite ``(?P<name>`` to plain ``(``; Java group names may not hold ``_``,
    so groups, and back references to them, are addressed by index, taken from
    Python's own parse."""
    index = dict(re.compile(pattern).groupindex)
    java = _BACK.sub(lambda m: f"(?:\\{index[m.group(1)]})", _NAMED.sub("(", pattern))
    return java, index


def extract_groups(c: Column | str, pattern: str, match: bool = True) -> dict[str, Column]:
    """Named group -> column; NULL where the pattern does not apply.

    ``match=True`` anchors at the start like ``re.match``.
    """
    c = F.col(c) if isinstance(c, str) else c
    java, index = to_java_pattern(pattern)
    if match:
        java = f"^(?:{java})"  # all of the pattern: the start belongs to every alternative
    hit = c.rlike(java)
    return {name: F.when(hit, F.regexp_extract(c, java, idx)) for name, idx in index.items()}


def matches(c: Column, pattern: str, anywhere: bool = False) -> Column:
    """Whether a Python pattern fits the start of ``c`` (or some part of it)."""
    java, _ = to_java_pattern(pattern)
    return c.rlike(java if anywhere else f"^(?:{java})")
