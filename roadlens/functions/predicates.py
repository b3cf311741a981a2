"""Row predicates and column helpers (FLT-1, FLT-2, event-time columns)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlens.config import SPEED_LIMIT, STRETCH_HI, STRETCH_LO


def speeding(df: DataFrame, limit: int = SPEED_LIMIT) -> DataFrame:
    """Reports faster than ``limit`` (strict)."""
    return df.where(F.col("speed") > F.lit(limit))


def in_stretch(df: DataFrame, lo: int = STRETCH_LO, hi: int = STRETCH_HI) -> DataFrame:
    """Reports on segments ``lo .. hi`` (inclusive)."""
    return df.where(F.col("seg").between(lo, hi))


def event_time(col: str | Column = "time", time_unit: str = "ms") -> Column:
    """`time` as a TIMESTAMP: milliseconds (as the reference reads it) or seconds."""
    c = F.col(col) if isinstance(col, str) else col
    if time_unit == "ms":
        return F.timestamp_millis(c)
    if time_unit == "s":
        return F.timestamp_seconds(c)
    raise ValueError(f"time_unit must be 'ms' or 's', not {time_unit!r}")
