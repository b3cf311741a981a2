"""Position reports derived from the generic ``events`` table (test and benchmark input).

Each ``user_id`` becomes a vehicle. Direction is constant per vehicle, segments advance with
each *step*, and even vehicles hold still for 4 reports out of every 6, so every query has
work to do. Two clocks, and a mixed form of the first:

* ``clock="event"``   -- ``time`` = seconds of ``ts`` since 2024-01-01 (view A)
* ``clock="cadence"`` -- ``time`` = 30 s per report with a 300 s pause every 24 reports (view B)
* ``mixed_reports``     -- view A with directions and segments that change from report to report and
  positions that do not follow them (view C): sessions that only the row-by-row fold decides

The per-vehicle report number ``rn`` is a running count; it goes through the split-safe
``running`` helper, so a user holding a large share of all events is split over tasks.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlens.config import DEFAULT_SKEW, SkewPolicy
from roadlens.plans.blocks import hot_key_table, running
from roadlens.sources.reports import reports_to_lines

# Fixed values of the view (shared with the DuckDB oracle text in __spark_entry__.py):
#   epoch 2024-01-01 00:00:00 UTC = 1704067200 s; stop pattern: 6-report cycle, 3 moving
#   steps; segment cycle of 7 starting at 51 (dir 0) or 57 (dir 1); 800 position units per
#   segment; position jitter (step*37 + vid*53) mod 800; cadence 30 s, pause 300 s per 24.
VIEW_EPOCH = _dt.datetime(2024, 1, 1)


def _micros_since_epoch(ts: Column, dtype: T.DataType) -> Column:
    """Microseconds since 1970-01-01: exact, and order-preserving for ``ts``."""
    if isinstance(dtype, T.TimestampNTZType):
        # wall-clock difference of TIMESTAMP_NTZ values: independent of the session time zone
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)
    return F.unix_micros(ts)


def _seconds(micros: Column) -> Column:
    """Whole seconds (floor), exact integer arithmetic."""
    return ((micros - F.pmod(micros, F.lit(1_000_000))) / F.lit(1_000_000)).cast("bigint")


def reports_from_events(
    events: DataFrame, clock: str = "event", policy: SkewPolicy = DEFAULT_SKEW
) -> DataFrame:
    """Columns ``seq time vid speed xway lane dir seg pos`` (``seq`` = ``event_id``)."""
    return reports_and_policy(events, clock, policy)[0]


def reports_and_policy(
    events: DataFrame, clock: str = "event", policy: SkewPolicy = DEFAULT_SKEW
) -> tuple[DataFrame, SkewPolicy]:
    """The report view plus the skew policy for vehicle-keyed operators on it.

    The view numbers each user's events, which needs the hot-key check on ``user_id``.
    ``vid`` is ``user_id`` and every report is one event, so any subset of the view has
    no more reports per vehicle than the user has events: when no user is hot, no vehicle
    is hot in any query on the view, and the returned policy skips the repeated check.
    """
    if clock not in ("event", "cadence"):
        raise ValueError("clock must be 'event' or 'cadence'")
    ts_type = events.schema["ts"].dataType
    epoch_s = int(VIEW_EPOCH.replace(tzinfo=_dt.timezone.utc).timestamp())
    ev = events.select(
        "event_id",
        "user_id",
        "value",
        "ts",
        (_seconds(_micros_since_epoch(F.col("ts"), ts_type)) - F.lit(epoch_s)).alias("_secs"),
        _micros_since_epoch(F.col("ts"), ts_type).alias("_us"),
    )
    hot = hot_key_table(ev, ["user_id"], "_us", policy, boundaries=False) if policy.enabled else None
    checked = policy if hot is not None else replace(policy, enabled=False)
    numbered = running(
        ev,
        keys=["user_id"],
        order=["ts", "event_id"],
        aggs={"_rn1": ("count", None)},
        axis="_us",
        axis_orders_like="ts",
        policy=checked,
    )
    time = "CAST(_secs AS INT)" if clock == "event" else "CAST(30 * rn + 300 * (rn div 24) AS INT)"
    fwd = "(user_id div 2) % 2 = 0"
    staged = numbered.selectExpr(
        "event_id", "user_id", "value", "_secs", "CAST(_rn1 - 1 AS INT) AS rn"
    ).selectExpr(
        "event_id AS seq",
        f"{time} AS time",
        "user_id AS vid",
        "CAST(floor(value) AS INT) AS speed",
        "CAST(user_id % 3 AS INT) AS xway",
        "CAST(event_id % 5 AS INT) AS lane",
        f"CAST(CASE WHEN {fwd} THEN 0 ELSE 1 END AS INT) AS dir",
        "CAST(CASE WHEN user_id % 2 = 0 THEN (rn div 6) * 3 + greatest(rn % 6 - 3, 0) ELSE rn END AS INT) AS step",
    )
    view = staged.selectExpr(
        "seq",
        "time",
        "vid",
        "speed",
        "xway",
        "lane",
        "dir",
        "CAST(CASE WHEN dir = 0 THEN 51 + step % 7 ELSE 57 - step % 7 END AS INT) AS seg",
        "step",
    ).selectExpr(
        "seq", "time", "vid", "speed", "xway", "lane", "dir", "seg",
        "CAST(seg * 800 + (CAST(step AS BIGINT) * 37 + vid * 53) % 800 AS INT) AS pos",
    )
    return view, checked


def mixed_reports(reports: DataFrame) -> DataFrame:
    """View C (see above); ``seq``, ``time`` and ``vid`` are kept."""
    return reports.selectExpr(
        "seq", "time", "vid", "speed", "xway", "lane",
        "CAST(seq % 3 % 2 AS INT) AS dir",
        "CAST(52 + (seq * 7919 + vid) div 3 % 5 AS INT) AS seg",
        "CAST((seq * 7919 + vid * 31) % 40000 AS INT) AS pos",
    )


def unordered_reports(reports: DataFrame) -> DataFrame:
    """The reports in another order of arrival: the last 1,024 first, and so on; ``time`` falls along ``seq``."""
    return reports.withColumn("seq", F.expr("(1048576 - seq div 1024) * 1099511627776 + seq % 1024"))


def spoiled_lines(reports: DataFrame) -> DataFrame:
    """Text lines of the reports (``seq, value``), of which two thirds are changed: extra fields and signs that
    the parser takes, and lines that it refuses."""
    line = reports_to_lines(reports).selectExpr("seq", "value AS l", "substr(value, locate(',', value)) AS rest")
    return line.selectExpr("seq", """CASE seq % 16
        WHEN 1 THEN concat(l, ',9') WHEN 2 THEN concat(l, ',') WHEN 3 THEN concat('+', l)
        WHEN 4 THEN substring_index(l, ',', 7) WHEN 5 THEN '' WHEN 6 THEN 'time,vid,speed,xway,lane,dir,seg,pos'
        WHEN 7 THEN concat('1,', rest) WHEN 8 THEN concat(' ', l) WHEN 9 THEN concat('2147483648', rest)
        WHEN 10 THEN concat('"1"', rest) WHEN 11 THEN concat(substring_index(l, ',', 7), ',') WHEN 12 THEN NULL
        ELSE l END AS value""")


def load_reports(
    spark: SparkSession, sf_dir: str, clock: str = "event", policy: SkewPolicy = DEFAULT_SKEW
) -> DataFrame:
    """Read ``events.parquet`` under ``sf_dir`` (only the needed columns) and derive reports."""
    return load_reports_and_policy(spark, sf_dir, clock, policy)[0]


def load_reports_and_policy(
    spark: SparkSession, sf_dir: str, clock: str = "event", policy: SkewPolicy = DEFAULT_SKEW
) -> tuple[DataFrame, SkewPolicy]:
    """``load_reports`` plus the vehicle skew policy (see ``reports_and_policy``)."""
    events = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet").select(
        "event_id", "ts", "user_id", "value"
    )
    return reports_and_policy(events, clock=clock, policy=policy)
