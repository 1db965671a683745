"""Conditions between a target row ``t`` and a source row ``s``."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F


def key_condition(keys: Sequence[str], left: str = "t", right: str = "s") -> str:
    """Equality of all key columns as SQL text, for ``F.expr``."""
    return " AND ".join(f"{left}.`{k}` = {right}.`{k}`" for k in keys)


def any_changed(
    columns: Sequence[str], null_safe: bool = True, left: str = "t", right: str = "s"
) -> Column:
    """True when at least one column differs.

    With ``null_safe=False`` a comparison with NULL is NULL, as for SQL ``!=``, so a change from or
    to NULL alone goes unnoticed.
    """

    def differs(name: str) -> Column:
        old, new = F.col(f"{left}.`{name}`"), F.col(f"{right}.`{name}`")
        return ~old.eqNullSafe(new) if null_safe else old != new

    return reduce(lambda a, b: a | b, map(differs, columns), F.lit(False))
