"""Event-time sessions per vehicle (WIN-1, TIM-1, KEY-1/3, AGG-3).

Two reports of a vehicle belong to one session when the later follows the earlier by at
most ``gap`` time units (inclusive, as Flink merges touching session windows). The session is
named by the ``time`` of its first report (``session_start``); starts are unique per vehicle.

Batch plan: ``lag(time)`` inside each (vehicle, block) marks breaks, a running max of break
times gives the session start. Hot vehicles are split in time blocks (``plans.blocks``); the
first report of a hot block is judged against the previous block's last ``time``, and rows
before the block's first break take the latest break of earlier blocks -- both from a small
per-block summary. Sessions are then plain grouped aggregates (partial aggregation).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadlens.config import DEFAULT_SKEW, Params, SkewPolicy
from roadlens.plans.blocks import BLK, UPTO, over, split_hot
from roadlens.schema import ORDER


def sessionize(
    reports: DataFrame,
    gap_units: int,
    keys: Sequence[str] = ("vid",),
    order: Sequence[str] = ORDER,
    policy: SkewPolicy = DEFAULT_SKEW,
) -> DataFrame:
    """Add ``session_start`` (INT, ``time`` of the session's first report) to every report."""
    return sessionize_split(reports, gap_units, keys, order, policy)[0]


def sessionize_split(
    reports: DataFrame,
    gap_units: int,
    keys: Sequence[str] = ("vid",),
    order: Sequence[str] = ORDER,
    policy: SkewPolicy = DEFAULT_SKEW,
) -> tuple[DataFrame, bool]:
    """``sessionize`` plus whether hot keys were split (False: the plain per-key plan)."""
    keys = list(keys)
    gap = F.lit(int(gap_units)).cast("bigint")
    t = F.col("time").cast("bigint")
    b, hot = split_hot(reports, keys, "time", policy, order[1] if len(order) > 1 else None)
    if not hot:
        w = over(keys, order)
        brk = f"CASE WHEN lag(time) {w} IS NULL OR CAST(time AS BIGINT) - lag(time) {w} > {int(gap_units)} THEN time END"
        marked = reports.selectExpr("*", f"{brk} AS _bt")
        plain = marked.selectExpr(
            *[f"`{c}`" for c in reports.columns],
            f"CAST(max(_bt) {over(keys, order, UPTO)} AS INT) AS session_start",
        )
        return plain, False
    w = Window.partitionBy(*keys, BLK).orderBy(*order)
    prev = F.lag("time").over(w)
    # a break starts a session; the first report of a hot block is decided from summaries
    brk = F.when(prev.isNull() & (F.col(BLK) < 0), F.col("time")).when(
        t - prev > gap, F.col("time")
    )
    marked = b.select("*", brk.alias("_bt"))
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = marked.select("*", F.max("_bt").over(upto).alias("_ls"))

    summ = (
        marked.where(F.col(BLK) >= 0)
        .groupBy(*keys, BLK)
        .agg(F.min("time").alias("_t0"), F.max("time").alias("_t1"), F.max("_bt").alias("_bm"))
    )
    wb = Window.partitionBy(*keys).orderBy(BLK)
    prev_t1 = F.lag("_t1").over(wb)
    heads = summ.select(
        *keys,
        BLK,
        "_bm",
        F.when(prev_t1.isNull() | (F.col("_t0").cast("bigint") - prev_t1 > gap), F.col("_t0")).alias(
            "_hd"
        ),
    )
    carry = heads.select(
        *keys,
        BLK,
        "_hd",
        F.max(F.greatest("_bm", "_hd"))
        .over(wb.rowsBetween(Window.unboundedPreceding, -1))
        .alias("_cy"),
    )
    joined = local.join(carry, on=[*keys, BLK], how="left")
    start = F.greatest("_ls", "_hd", "_cy").cast("int")
    return joined.select(*reports.columns, start.alias("session_start")), True


def sessions(
    reports: DataFrame,
    params: Params = Params(),
    keys: Sequence[str] = ("vid",),
    policy: SkewPolicy = DEFAULT_SKEW,
) -> DataFrame:
    """One row per session: ``vid, session_start, session_end, n`` (first/last time, reports)."""
    s = sessionize(reports.select(*keys, *ORDER), params.gap_units, keys, policy=policy)
    return s.groupBy(*keys, "session_start").agg(
        F.max("time").alias("session_end"), F.count(F.lit(1)).alias("n")
    )
