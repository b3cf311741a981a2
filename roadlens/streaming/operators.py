"""Structured Streaming twins of the three queries (§2.7 of the survey).

* ``stream_speed_radar``       -- keyed running max, per-report output; Spark refuses row windows
  on streams, so it is ``applyInPandasWithState`` with state (first report, max so far).
* ``stream_accident_reporter`` -- count window of 4 sliding by 1; state = the last 3 reports.
  Both take a hash bucket of vehicles per call, in numpy, and hold the states of its vehicles.
* ``stream_average_speed_control`` -- exact: a custom stateful operator with an event-time
  timeout and O(1) state per vehicle (``streaming.speed_control``); fast: ``session_window``
  with a watermark (delay 0, as the ascending-timestamp extractor) and arg-min/arg-max.

Per call, a group holds the reports of one vehicle (Q1, Q3: of one bucket of vehicles) in one micro-batch,
bounded by the trigger's ``maxFilesPerTrigger`` / ``maxBytesPerTrigger``; the state is O(1) per vehicle. A bucket
that gets reports has its state written as a whole; ``buckets`` sets their number, which a checkpoint fixes.
Reports inside a micro-batch are ordered by (time, seq); micro-batches follow arrival.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from roadlens.config import SPEED_LIMIT, STOP_REPORTS, Params
from roadlens.functions.predicates import event_time, in_stretch, speeding
from roadlens.schema import ACCIDENT_COLS, SPEED_CONTROL_COLS, SPEED_RADAR_COLS

_RADAR_OUT = T.StructType(
    [
        T.StructField("time", T.IntegerType()),
        T.StructField("vid", T.LongType()),
        T.StructField("xway", T.IntegerType()),
        T.StructField("seg", T.IntegerType()),
        T.StructField("dir", T.IntegerType()),
        T.StructField("max_speed", T.IntegerType()),
    ]
)
BUCKETS = 4096  # groups of vehicles: a call from Spark to Python costs milliseconds, so one serves many vehicles
NULL = 2**63 - 1  # stands for null in the arrays of a group; it sorts last


def _longs(columns: tuple[str, ...]) -> T.StructType:
    return T.StructType([T.StructField(c, T.ArrayType(T.LongType())) for c in columns])


def _in_buckets(reports: DataFrame, columns: tuple[str, ...], buckets: int):
    """``reports`` grouped by a hash bucket of ``vid``; null is ``NULL``, and null vehicles have bucket -1."""
    bucket = F.when(F.col("vid").isNull(), -1).otherwise(F.pmod(F.xxhash64("vid"), F.lit(buckets)))
    longs = [F.coalesce(F.col(c).cast("bigint"), F.lit(NULL)).alias(c) for c in columns]
    return reports.select(bucket.cast("int").alias("_bucket"), *longs).groupBy("_bucket")


def _after_state(
    pdfs: Iterator[pd.DataFrame], state: GroupState, columns: tuple[str, ...], held: tuple[str, ...]
) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """A bucket's rows by vehicle: those that the state holds in their order, then new ones by (time, seq).

    Also whether a row is new, and its vehicle's first row. ``columns`` that are not ``held`` are ``NULL`` in held rows.
    """
    new = pd.concat(list(pdfs), ignore_index=True)
    old = dict(zip(held, state.get)) if state.exists else {c: [] for c in held}
    n = len(old["vid"])
    cols = {c: np.concatenate([np.asarray(old.get(c, [NULL] * n), np.int64), new[c].to_numpy(np.int64)]) for c in columns}
    fresh = np.arange(n + len(new)) >= n
    time, seq = np.where(fresh, cols["time"], 0), np.where(fresh, cols["seq"], 0)
    order = np.lexsort((seq, time, fresh, cols["vid"]))  # stable
    cols, fresh = {c: v[order] for c, v in cols.items()}, fresh[order]
    vid = cols["vid"]
    first = np.flatnonzero(np.append(True, vid[1:] != vid[:-1]))
    return cols, fresh, np.repeat(first, np.diff(np.append(first, len(vid))))


def _frame(columns: dict[str, np.ndarray], schema: T.StructType) -> pd.DataFrame:
    """Columns of integers in the types of ``schema``, ``NULL`` as null."""
    out = {}
    for f in schema.fields:
        v = columns[f.name]
        kind = np.int64 if isinstance(f.dataType, T.LongType) else np.int32
        out[f.name] = pd.arrays.IntegerArray(np.where(v == NULL, 0, v).astype(kind), v == NULL)
    return pd.DataFrame(out)


_RADAR_COLS = ("vid", "time", "seq", "speed", "xway", "seg", "dir")
_RADAR_HELD = ("vid", "time", "speed", "xway", "seg", "dir")  # per vehicle: first report, largest speed so far


def _radar_step(key: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    cols, fresh, first = _after_state(pdfs, state, _RADAR_COLS, _RADAR_HELD)
    # one running maximum: the speeds of each vehicle lie above those of the vehicles before it
    step = first * 2**33
    run = np.maximum.accumulate(cols["speed"] + step) - step
    last = np.append(first[1:] != first[:-1], True)
    heads = {c: cols[c][first] for c in ("vid", "time", "xway", "seg", "dir")} | {"speed": run}
    state.update(tuple(heads[c][last].tolist() for c in _RADAR_HELD))
    out = {c: v[fresh] for c, v in heads.items()}
    out["max_speed"] = out["speed"]
    if key[0] < 0:
        out["vid"] = np.full(len(out["vid"]), NULL)
    yield _frame(out, _RADAR_OUT)


def stream_speed_radar(reports: DataFrame, limit: int = SPEED_LIMIT, buckets: int = BUCKETS) -> DataFrame:
    """Streaming Q1: one output row per speeding report (append mode)."""
    out = _in_buckets(speeding(reports, limit), _RADAR_COLS, buckets).applyInPandasWithState(
        _radar_step, _RADAR_OUT, _longs(_RADAR_HELD), "append", GroupStateTimeout.NoTimeout
    )
    return out.select(*SPEED_RADAR_COLS)


_HELD = ("vid", "time", "seq", "xway", "seg", "dir", "pos")
_ACC_OUT = T.StructType(
    [
        T.StructField("time1", T.IntegerType()),
        T.StructField("time2", T.IntegerType()),
        T.StructField("vid", T.LongType()),
        T.StructField("xway", T.IntegerType()),
        T.StructField("seg", T.IntegerType()),
        T.StructField("dir", T.IntegerType()),
        T.StructField("pos", T.IntegerType()),
    ]
)


def _stopped_step_factory(size: int):
    hold = size - 1

    def step(key: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        cols, fresh, first = _after_state(pdfs, state, _HELD, _HELD)
        pos, at = cols["pos"], np.arange(len(fresh))
        ends = np.flatnonzero(fresh & (at - first >= hold))
        same = np.ones(len(ends), dtype=bool)
        for back in range(1, size):
            same &= pos[ends - back] == pos[ends]
        hits = ends[same]
        # the vehicle's last ``hold`` rows
        past = np.append(np.flatnonzero(first[1:] != first[:-1]) + 1, len(first))
        past = past[np.searchsorted(past, at, "right")]
        state.update(tuple(cols[c][past - at <= hold].tolist() for c in _HELD))
        if not len(hits):
            return
        out = {c: cols[c][hits - hold] for c in _HELD}
        out |= {"time1": out["time"], "time2": cols["time"][hits]}
        # null positions are equal; null is written as 0, a null vehicle as the smallest number
        out = {c: np.where(v == NULL, 0, v) for c, v in out.items()}
        if key[0] < 0:
            out["vid"] = np.full(len(hits), -(2**63))
        yield _frame(out, _ACC_OUT)

    return step


def stream_accident_reporter(reports: DataFrame, size: int = STOP_REPORTS, buckets: int = BUCKETS) -> DataFrame:
    """Streaming Q3: every ``size`` reports in a row at one position (append mode)."""
    out = _in_buckets(reports, _HELD, buckets).applyInPandasWithState(
        _stopped_step_factory(size), _ACC_OUT, _longs(_HELD), "append", GroupStateTimeout.NoTimeout
    )
    return out.select(*ACCIDENT_COLS)


# ------------------------------------------------------------------------------------------
# Q2: session windows
# ------------------------------------------------------------------------------------------

_FOLD_FIELDS = ("time", "seq", "xway", "dir", "seg", "pos")


def stream_average_speed_control(
    reports: DataFrame, params: Params = Params(), exact: bool = True
) -> DataFrame:
    """Streaming Q2 in append mode: a session is emitted once it is closed -- by a later
    report more than a gap away, or by the watermark passing its end.

    ``exact=True``: the custom stateful operator of ``streaming.speed_control`` (exact fold,
    O(1) state per vehicle). ``exact=False``: ``session_window`` with arg-min/arg-max
    aggregates (O(1) state per session; assumes one direction class per session).
    The watermark follows the largest ``time`` seen on the stretch (delay 0), so reports
    behind it are dropped, as in the reference. At the end of a bounded input the last
    sessions stay open; ``runners`` appends a far-future flush report to close them.
    """
    if exact:
        from roadlens.streaming.speed_control import stream_speed_control_stateful

        return stream_speed_control_stateful(reports, params)
    lo, hi = params.lo_seg, params.hi_seg
    on = in_stretch(reports.select("vid", *_FOLD_FIELDS), lo, hi)
    timed = on.withColumn("_ts", event_time("time", params.time_unit)).withWatermark("_ts", "0 seconds")
    gap = f"{params.gap_units} {'milliseconds' if params.time_unit == 'ms' else 'seconds'}"
    row = f"struct({', '.join(_FOLD_FIELDS)})"
    agg = timed.groupBy("vid", F.session_window("_ts", gap).alias("_sw")).agg(
        F.expr("count(1) AS n"),
        F.expr("count(CASE WHEN dir = 0 THEN 1 END) AS _nf"),
        F.expr(f"min_by({row}, struct(pos, time, seq)) AS _amin"),
        F.expr(f"min_by({row}, struct(-CAST(pos AS BIGINT), time, seq)) AS _amax"),
    )
    ends = agg.selectExpr(
        "vid",
        "n",
        "CASE WHEN _nf = n THEN _amin ELSE _amax END AS first",
        "CASE WHEN _nf = n THEN _amax ELSE _amin END AS last",
    )
    crossed = f"(first.seg = {lo} AND last.seg = {hi}) OR (first.seg = {hi} AND last.seg = {lo})"
    # try_divide: a one-report session (possible only when lo == hi) gives NULL, not an error
    avg = (
        "try_divide(CAST(abs(first.pos - last.pos) AS DOUBLE),"
        f" CAST(n - 1 AS DOUBLE) * CAST({float(params.interval)!r} AS DOUBLE))"
        f" * CAST({float(params.factor)!r} AS DOUBLE)"
    )
    out = ends.where(crossed).selectExpr(
        "first.time AS time1", "last.time AS time2", "vid", "first.xway AS xway",
        "first.dir AS dir", f"{avg} AS avg_speed",
    )
    return out.where(f"avg_speed > CAST({float(params.avg_limit)!r} AS DOUBLE)").select(*SPEED_CONTROL_COLS)
