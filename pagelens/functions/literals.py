"""Literal arrays and maps as single SQL expressions.

``F.array(*[F.lit(x) ...])`` costs one Python-to-JVM call per element; a
table of a few hundred entries built that way in several expressions made
building a job's DataFrame take seconds. One ``F.expr`` call parses the
whole literal on the JVM side instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sql_string(s: str) -> str:
    """A Spark SQL string literal (backslash escapes)."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def string_array(values: list[str]) -> Column:
    return F.expr("array(" + ", ".join(sql_string(v) for v in values) + ")") if values \
        else F.array().cast("array<string>")


def packed_map_sql(d: dict[str, str]) -> str:
    """A large map as one string literal, split into a map when the plan is folded
    (the unit separators occur in no key or value)."""
    pairs = "\x1e".join(f"{k}\x1f{v}" for k, v in d.items())
    return f"str_to_map({sql_string(pairs)}, '\x1e', '\x1f')"


def long_string_map_sql(d: dict[int, str]) -> str:
    keys = ", ".join(f"{int(k)}L" for k in d)
    vals = ", ".join(sql_string(v) for v in d.values())
    return f"map_from_arrays(array({keys}), array({vals}))"
