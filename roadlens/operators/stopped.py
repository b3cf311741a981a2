"""Q3 accident reporter and the count window it is built on (WIN-2, AGG-5, FLT-5, PRJ-3),
plus the commented-out sliding event-time variant (WIN-3).

``countWindow(4, 1)`` keyed by vehicle fires on every report with the last <= 4 reports of
that vehicle. A batch DataFrame expresses that as the frame ``ROWS BETWEEN 3 PRECEDING AND
CURRENT ROW``; the split-safe ``trailing`` helper evaluates it per (vehicle, block).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.config import (
    DEFAULT_SKEW,
    SLIDING_SIZE_SECONDS,
    SLIDING_SLIDE_SECONDS,
    STOP_REPORTS,
    UNIT_PER_SECOND,
    SkewPolicy,
)
from roadlens.functions.predicates import event_time
from roadlens.plans.blocks import running, trailing
from roadlens.schema import ACCIDENT_COLS, ORDER

_HEAD = ("time", "xway", "seg", "dir", "pos")


def count_window(
    reports: DataFrame,
    size: int = STOP_REPORTS,
    keys: Sequence[str] = ("vid",),
    order: Sequence[str] = ORDER,
    policy: SkewPolicy = DEFAULT_SKEW,
) -> DataFrame:
    """One row per report (one firing of the count window of ``size``, slide 1).

    Adds ``_n`` (rows in the window), ``_first`` (struct of the window's first report),
    ``_min_pos`` and ``_max_pos``; the current report is the window's last.
    """
    cols = list(dict.fromkeys([*keys, *order, "time", "vid", "xway", "seg", "dir", "pos"]))
    exprs = {
        "_n": "count(1)",
        "_first": f"first(struct({', '.join(_HEAD)}))",
        "_min_pos": "min(pos)",
        "_max_pos": "max(pos)",
    }
    return trailing(reports.select(*cols), list(keys), list(order), size - 1, exprs, policy=policy)


def every_slide(cw: DataFrame, slide: int, keys: Sequence[str], order: Sequence[str], policy: SkewPolicy) -> DataFrame:
    """The rows of ``count_window`` at which a window of ``slide`` fires: every ``slide``-th report of its
    key, counted from the first. The ordinal is a running count, so a hot key's blocks carry it on."""
    if slide < 1:
        raise ValueError("slide must be >= 1")
    if slide == 1:
        return cw
    counted = running(cw, list(keys), list(order), {"_ordinal": ("count", None)}, policy=policy)
    return counted.where(f"_ordinal % {int(slide)} = 0").drop("_ordinal")


def count_window_firings(
    reports: DataFrame,
    size: int = STOP_REPORTS,
    policy: SkewPolicy = DEFAULT_SKEW,
    order: Sequence[str] = ORDER,
    slide: int = 1,
) -> DataFrame:
    """``vid, time1, time2, n, pos1, pos2``: size, first and last report of every firing of the count
    window (``size``, ``slide``): after every ``slide`` reports of a vehicle, with its last ``size`` (or
    fewer) ones. ``slide > size`` leaves reports between two windows out."""
    cw = count_window(reports, size, order=order, policy=policy)
    return every_slide(cw, slide, ["vid"], order, policy).selectExpr(*FIRING)


FIRING = (
    "vid", "_first.time AS time1", "time AS time2", "CAST(_n AS BIGINT) AS n", "_first.pos AS pos1", "pos AS pos2",
)


def accident_reporter(
    reports: DataFrame,
    size: int = STOP_REPORTS,
    keys: Sequence[str] = ("vid",),
    policy: SkewPolicy = DEFAULT_SKEW,
    order: Sequence[str] = ORDER,
) -> DataFrame:
    """``time1, time2, vid, xway, seg, dir, pos`` for every ``size`` reports in a row at one
    position; all fields but ``time2`` come from the first of them. A stop of k >= size
    reports emits k - size + 1 rows. Extra ``keys`` (e.g. xway, dir) narrow the match;
    ``order=ARRIVAL`` counts reports as they arrived, whatever their ``time``."""
    return stops(count_window(reports, size, keys=keys, order=order, policy=policy), size)


def stops(windows: DataFrame, size: int) -> DataFrame:
    """The rows of ``count_window`` that hold ``size`` reports at one position, as accidents."""
    hit = windows.where(f"_n = {int(size)} AND _min_pos = _max_pos")
    return hit.selectExpr(
        "_first.time AS time1", "time AS time2", "vid", "_first.xway AS xway",
        "_first.seg AS seg", "_first.dir AS dir", "_first.pos AS pos",
    ).select(*ACCIDENT_COLS)


def stopped_sliding(
    reports: DataFrame,
    size_seconds: int = SLIDING_SIZE_SECONDS,
    slide_seconds: int = SLIDING_SLIDE_SECONDS,
    time_unit: str = "ms",
    count: int = STOP_REPORTS,
    watermark: str | None = None,
) -> DataFrame:
    """WIN-3: per vehicle and sliding event-time window, fire when exactly ``count`` reports
    share the position of the window's first report. ``time2`` is the window's last report
    even if it moved. Each report joins ``size/slide`` windows: their starts are exploded,
    which keeps a partitioning by vehicle, so reports that have one are not shuffled again.
    Both aggregation steps are partial (map-side combined), so no window collects rows.

    A stream takes ``F.window`` for the starts when ``watermark`` is given (e.g. ``"0 seconds"``): two
    chained windowed aggregations in append mode, a window emitted once the watermark
    passes its end.
    """
    keyed = reports.select(
        "vid", "time", "seq", "xway", "seg", "dir", "pos", event_time("time", time_unit).alias("_ts")
    )
    if watermark is not None:
        keyed = keyed.withWatermark("_ts", watermark)
        win = F.window("_ts", f"{size_seconds} seconds", f"{slide_seconds} seconds").alias("_w")
    else:
        size, slide = size_seconds * UNIT_PER_SECOND[time_unit], slide_seconds * UNIT_PER_SECOND[time_unit]
        newest = f"CAST(time AS BIGINT) - pmod(CAST(time AS BIGINT), {slide}L)"
        starts = f"transform(sequence(0, {-(-size // slide) - 1}), k -> {newest} - k * {slide}L)"
        keyed = keyed.drop("_ts").withColumn("_w", F.expr(f"explode(filter({starts}, w -> w > time - {size}L))"))
        win = "_w"
    by_pos = keyed.groupBy("vid", win, "pos").agg(
        F.expr("count(1) AS _same"),
        F.expr("min(struct(time, seq, xway, seg, dir)) AS _head"),
        F.expr("max(struct(time, seq)) AS _tail"),
    )
    per_window = by_pos.groupBy("vid", "_w").agg(
        F.expr("min_by(struct(_same, pos, _head), _head) AS _f"),
        F.expr("max(_tail) AS _last"),
    )
    return per_window.where(f"_f._same = {int(count)}").selectExpr(
        "_f._head.time AS time1",
        "_last.time AS time2",
        "vid",
        "_f._head.xway AS xway",
        "_f._head.seg AS seg",
        "_f._head.dir AS dir",
        "_f.pos AS pos",
    )
