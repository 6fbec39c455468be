"""Column-expression helpers: all built-in Spark SQL, no Python UDFs."""

from tessera.functions.keys import compose_key
from tessera.functions.nulls import null_if_token, normalize_nulls
from tessera.functions.ranking import sequence_within
from tessera.functions.regex import extract_groups, group_names, to_java_pattern
from tessera.functions.text import apply_value_rules

__all__ = [
    "compose_key", "null_if_token", "normalize_nulls", "sequence_within", "extract_groups",
    "group_names", "to_java_pattern", "apply_value_rules",
]
