"""The entry/exit fold of Q2 as a native column expression (AGG-2)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_TAKE_FIRST = (
    "CASE WHEN r.dir = 0 THEN r.seg <= a.first.seg AND r.pos < a.first.pos"
    " ELSE r.seg >= a.first.seg AND r.pos > a.first.pos END"
)
_TAKE_LAST = (
    "CASE WHEN r.dir = 0 THEN r.seg >= a.last.seg AND r.pos > a.last.pos"
    " ELSE r.seg <= a.last.seg AND r.pos < a.last.pos END"
)


def fold_endpoints_sql(reports: str, row_type: str) -> str:
    """SQL text of the fold over ``reports`` (an array of ``row_type`` structs with ``dir seg
    pos``, sorted by (time, seq)): ``struct(first, last)``, row 0 starting both; NULLs if empty.

    The array appears once in the text: the fold starts from NULLs instead of looking up row 0.
    """
    none = f"CAST(NULL AS {row_type})"
    return (
        f"aggregate({reports}, named_struct('first', {none}, 'last', {none}), (a, r) -> "
        f"CASE WHEN a.first IS NULL THEN named_struct('first', r, 'last', r) "
        f"WHEN {_TAKE_FIRST} THEN named_struct('first', r, 'last', a.last) "
        f"WHEN {_TAKE_LAST} THEN named_struct('first', a.first, 'last', r) ELSE a END)"
    )


def fold_endpoints(reports: str, row_type: str) -> Column:
    """The fold as a Column; ``reports`` is a SQL expression (e.g. a column name)."""
    return F.expr(fold_endpoints_sql(reports, row_type))
