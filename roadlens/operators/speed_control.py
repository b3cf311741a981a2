"""Q2 average speed control (AGG-2, AGG-3, AGG-4, FLT-2, FLT-3, FLT-4, PRJ-2).

Per vehicle and session of reports on segments ``lo..hi``, an ordered fold picks an entry
report (``first``) and an exit report (``last``); when they sit on the two end segments the
average speed is ``abs(first.pos - last.pos) / ((n - 1) * interval) * factor``.

The fold, row by row in (time, seq) order, starting with first = last = row 0:

* ``dir == 0``: if seg <= first.seg and pos < first.pos -> first := row;
  else if seg >= last.seg and pos > last.pos -> last := row
* otherwise:    if seg >= first.seg and pos > first.pos -> first := row;
  else if seg <= last.seg and pos < last.pos -> last := row

When a session has one direction class (all ``dir == 0`` or none) and ``seg`` never falls
as ``pos`` rises, the fold is exactly "earliest arg-min / arg-max of pos" (swapped for
``dir != 0``): ``pos < first.pos`` then implies ``seg <= first.seg``, and an update of
``first`` can never be an update of ``last``. Both facts are checked per session with plain
aggregates (per-segment min/max of ``pos``), so such sessions are decided by one grouped
aggregate with map-side partial aggregation. Only sessions failing the check run the
sequential fold, streamed over sorted rows with O(1) state (``mapInPandas``).

With hot vehicles such a session is cut into blocks, and each block loses the rows that can
change nothing, whatever the state before it (``prune``). In a run of one direction class
``first`` only moves one way, so a row that an earlier row of the run is at least as low as
(``dir == 0``: ``seg`` and ``pos`` not larger) never becomes ``first``; such a row surely reaches
the second test, so behind it no row that is not higher becomes ``last``. What is left, in
order, folds to the same entry and exit.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlens.config import DEFAULT_SKEW, Params, SkewPolicy
from roadlens.functions.fold import fold_endpoints_sql
from roadlens.functions.predicates import in_stretch
from roadlens.operators.sessions import sessionize_split
from roadlens.plans.blocks import BLK, UPTO, WHOLE, over, split_hot
from roadlens.schema import ORDER

_ROW = ("time", "seq", "xway", "dir", "seg", "pos")
_ROW_TYPES = {
    "time": T.IntegerType(),
    "seq": T.LongType(),
    "xway": T.IntegerType(),
    "dir": T.IntegerType(),
    "seg": T.IntegerType(),
    "pos": T.IntegerType(),
}
def _row() -> Column:
    return F.struct(*[F.col(c) for c in _ROW])


def _monotone(lo: int, hi: int) -> Column:
    """No two reports with pos_a < pos_b and seg_a > seg_b (from per-segment min/max)."""
    ok = F.lit(True)
    prefix_max = F.col(f"_mx{lo}")
    for s in range(lo + 1, hi + 1):
        ok = ok & F.coalesce(F.col(f"_mn{s}") >= prefix_max, F.lit(True))
        prefix_max = F.greatest(prefix_max, F.col(f"_mx{s}"))
    return ok


def _fold_factory(group: list[str], names: list[str], counted: bool = False):
    """The exact sequential fold over rows sorted by (*group, time, seq), one row per group."""

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []
        key = None
        n = 0
        first = last = None
        for pdf in batches:
            keys = list(zip(*[pdf[c].tolist() for c in group]))
            rows = list(zip(*[pdf[c].tolist() for c in _ROW]))
            sizes = pdf["_n"].tolist() if counted else [0] * len(rows)
            for k, r, size in zip(keys, rows, sizes):
                if k != key:
                    if key is not None:
                        out.append((*key, n, *first, *last))
                    key, n, first, last = k, size, r, r
                _, _, _, d, seg, pos = r
                if d == 0:
                    if seg <= first[4] and pos < first[5]:
                        first = r
                    elif seg >= last[4] and pos > last[5]:
                        last = r
                else:
                    if seg >= first[4] and pos > first[5]:
                        first = r
                    elif seg <= last[4] and pos < last[5]:
                        last = r
                n += not counted
            if len(out) >= 4096:
                yield pd.DataFrame(out, columns=names)
                out = []
        if key is not None:
            out.append((*key, n, *first, *last))
        if out:
            yield pd.DataFrame(out, columns=names)

    return fold


def prune(
    rows: DataFrame, lo: int, hi: int, group: Sequence[str], policy: SkewPolicy = DEFAULT_SKEW, order: Sequence[str] = ORDER
) -> DataFrame:
    """``rows`` of sessions (keys ``group``) without those that cannot change the fold, found block by block.

    A block is a stretch of a large session in ``order`` (two columns); all of it is windows over
    (session, block, run), so no task holds a session whole. Each session keeps its number of
    rows as ``_n``.
    """
    cols = list(dict.fromkeys([*group, *order, *_ROW]))
    part = [*group, BLK]
    sizes = rows.groupBy(*group).agg(F.count("*").alias("_n"))
    cut, split = split_hot(rows.select(*cols), list(group), order[0], policy, order[1])
    cut = cut if split else cut.withColumn(BLK, F.lit(-1).cast("bigint"))
    # the mirror image of the other direction class: one rule for both
    turned = cut.selectExpr("*", "dir = 0 AS _d", f"CASE WHEN dir = 0 THEN seg ELSE {lo + hi} - seg END AS _s", "CASE WHEN dir = 0 THEN 1L ELSE -1L END * pos AS _p")
    runs = turned.selectExpr("*", f"CASE WHEN lag(_d) {over(part, order)} <> _d THEN 1 ELSE 0 END AS _c")
    runs = runs.selectExpr("*", f"sum(_c) {over(part, order, UPTO)} AS _r")
    before = over([*part, "_r"], order, "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING")
    lows = runs.selectExpr("*", *[f"min(CASE WHEN _s <= {k} THEN _p END) {before} AS _low{k}" for k in range(lo, hi + 1)])
    never_first = "coalesce(CASE _s " + " ".join(f"WHEN {k} THEN _low{k}" for k in range(lo, hi + 1)) + " END <= _p, FALSE)"
    tested = lows.selectExpr(*cols, BLK, "_r", "_s", "_p", f"{never_first} AS _nf")
    highs = tested.selectExpr("*", *[f"max(CASE WHEN _nf AND _s >= {k} THEN _p END) {before} AS _high{k}" for k in range(lo, hi + 1)])
    never_last = "coalesce(CASE _s " + " ".join(f"WHEN {k} THEN _high{k}" for k in range(lo, hi + 1)) + " END >= _p, FALSE)"
    return highs.where(f"NOT (_nf AND {never_last})").select(*cols).join(sizes, list(group))


def exact_fold(rows: DataFrame, keys: Sequence[str] = ("vid",), order: Sequence[str] = ORDER) -> DataFrame:
    """Sequential fold per (keys, session_start): ``keys, session_start, n, first, last``.

    Rows of a session meet in one task, sorted, and are streamed through the fold with O(1)
    state (``mapInPandas`` over the sorted partition; no group is collected in memory).
    """
    group = [*keys, "session_start"]
    schema = T.StructType(
        [
            *[rows.schema[c] for c in group],
            T.StructField("n", T.LongType()),
            *[T.StructField(f"f_{c}", _ROW_TYPES[c]) for c in _ROW],
            *[T.StructField(f"l_{c}", _ROW_TYPES[c]) for c in _ROW],
        ]
    )
    counted = "_n" in rows.columns  # pruned rows bring the session's size along
    sorted_rows = (
        rows.select(*dict.fromkeys([*group, *order, *_ROW]), *(["_n"] if counted else []))
        .repartition(*group)
        .sortWithinPartitions(*group, *order)
    )
    folded = sorted_rows.mapInPandas(_fold_factory(group, schema.fieldNames(), counted), schema=schema)
    return folded.select(
        *group,
        "n",
        F.struct(*[F.col(f"f_{c}").alias(c) for c in _ROW]).alias("first"),
        F.struct(*[F.col(f"l_{c}").alias(c) for c in _ROW]).alias("last"),
    )


def _monotone_sql(lo: int, hi: int) -> str:
    """SQL twin of ``_monotone`` over columns ``_mn<k>`` / ``_mx<k>``."""
    terms = ["TRUE"]
    prefix = f"_mx{lo}"
    for k in range(lo + 1, hi + 1):
        terms.append(f"coalesce(_mn{k} >= {prefix}, TRUE)")
        prefix = f"greatest({prefix}, _mx{k})"
    return " AND ".join(terms)


def _endpoints_unsplit(s: DataFrame, lo: int, hi: int, keys: Sequence[str] = ("vid",)) -> DataFrame:
    """Exact endpoints when every vehicle sits in one task (no hot key).

    The rows are already partitioned by vehicle; whole-session window aggregates (no new
    exchange) tell each report whether its session passes the check. One aggregate then
    takes arg-min/arg-max for passing sessions and collects the reports of the others
    only -- bounded by a non-hot vehicle -- for the native ``aggregate`` fold.
    """
    group = [*keys, "session_start"]
    w = over(group, ["time", "seq"], WHOLE)
    marks = [f"count(1) {w} AS _n", f"count(CASE WHEN dir = 0 THEN 1 END) {w} AS _nfwd"]
    for k in range(lo, hi + 1):
        marks.append(f"min(CASE WHEN seg = {k} THEN pos END) {w} AS _mn{k}")
        marks.append(f"max(CASE WHEN seg = {k} THEN pos END) {w} AS _mx{k}")
    simple = f"(_nfwd = 0 OR _nfwd = _n) AND {_monotone_sql(lo, hi)}"
    cols = [*group, *_ROW]
    marked = s.selectExpr(*cols, *marks).selectExpr(*cols, f"{simple} AS _simple")
    row = f"struct({', '.join(_ROW)})"
    agg = marked.groupBy(*group).agg(
        F.expr("count(1) AS n"),
        F.expr(f"min_by({row}, struct(pos, time, seq)) AS _amin"),
        F.expr(f"min_by({row}, struct(-CAST(pos AS BIGINT), time, seq)) AS _amax"),
        F.expr("count(CASE WHEN dir = 0 THEN 1 END) AS _nfwd"),
        F.expr("bool_and(_simple) AS _simple"),
        F.expr(f"collect_list(CASE WHEN NOT _simple THEN {row} END) AS _hard"),
    )
    row_type = f"struct<{','.join(f'{c}:{t.simpleString()}' for c, t in _ROW_TYPES.items())}>"
    simple_ends = (
        "named_struct('first', CASE WHEN _nfwd = n THEN _amin ELSE _amax END,"
        " 'last', CASE WHEN _nfwd = n THEN _amax ELSE _amin END)"
    )
    fold = fold_endpoints_sql("sort_array(_hard)", row_type)
    # a generator is a barrier: filters on `first` and `last` above it do not repeat the fold
    return agg.selectExpr(*group, "n", f"inline(array(CASE WHEN _simple THEN {simple_ends} ELSE {fold} END))")


def session_endpoints(
    reports: DataFrame,
    params: Params = Params(),
    exact: bool = True,
    policy: SkewPolicy = DEFAULT_SKEW,
    keys: Sequence[str] = ("vid",),
) -> DataFrame:
    """Per session on the stretch: ``keys, session_start, n, first, last`` (structs of _ROW).

    ``keys`` must contain ``vid``; extra keys (e.g. ``xway``, ``dir``) split sessions further.
    """
    keys = list(dict.fromkeys(keys))
    if "vid" not in keys:
        raise ValueError("keys must contain 'vid'")
    lo, hi = params.lo_seg, params.hi_seg
    group = [*keys, "session_start"]
    on_stretch = in_stretch(reports.select(*dict.fromkeys([*keys, *_ROW])), lo, hi)
    s, split = sessionize_split(on_stretch, params.gap_units, keys, policy=policy)
    if exact and not split:
        return _endpoints_unsplit(s, lo, hi, keys)
    return endpoints_split(s, lo, hi, keys, exact, policy)


def endpoints_split(
    s: DataFrame,
    lo: int,
    hi: int,
    keys: Sequence[str] = ("vid",),
    exact: bool = True,
    policy: SkewPolicy = DEFAULT_SKEW,
    order: Sequence[str] = ORDER,
) -> DataFrame:
    """Endpoints of sessions of any size, ``s`` with ``session_start``; reports are folded in ``order``.

    One grouped aggregate with map-side partial aggregation decides the sessions that pass the check;
    the others are pruned (unless ``policy`` is off: no vehicle is hot) and folded row by row.
    """
    group = [*keys, "session_start"]
    if exact:
        # The same null test the semi join below would infer, stated once before the branches
        # split: both branches then share one plan and Spark reuses its shuffle output.
        not_null = F.lit(True)
        for c in group:
            not_null = not_null & F.col(c).isNotNull()
        s = s.where(not_null)
    neg_pos = -F.col("pos").cast("bigint")
    aggs = [
        F.count(F.lit(1)).alias("n"),
        F.min_by(_row(), F.struct("pos", *order)).alias("_amin"),
        F.min_by(_row(), F.struct(neg_pos, *order)).alias("_amax"),
        F.count(F.when(F.col("dir") == 0, F.lit(1))).alias("_nfwd"),
    ]
    if exact:
        for k in range(lo, hi + 1):
            on_k = F.col("seg") == F.lit(k)
            aggs.append(F.min(F.when(on_k, F.col("pos"))).alias(f"_mn{k}"))
            aggs.append(F.max(F.when(on_k, F.col("pos"))).alias(f"_mx{k}"))
    agg = s.groupBy(*group).agg(*aggs)
    fwd = F.col("_nfwd") == F.col("n")
    first = F.when(fwd, F.col("_amin")).otherwise(F.col("_amax"))
    last = F.when(fwd, F.col("_amax")).otherwise(F.col("_amin"))
    if not exact:
        return agg.select(*group, "n", first.alias("first"), last.alias("last"))
    simple = ((F.col("_nfwd") == 0) | fwd) & _monotone(lo, hi)
    easy = agg.where(simple).select(*group, "n", first.alias("first"), last.alias("last"))
    hard_keys = agg.where(~simple).select(*group)
    hard_rows = s.join(hard_keys, on=group, how="left_semi")
    if policy.enabled:  # some vehicle may be hot
        hard_rows = prune(hard_rows, lo, hi, group, policy, order)
    return easy.unionByName(exact_fold(hard_rows, keys, order))


def stretch_crossings(
    reports: DataFrame,
    params: Params = Params(),
    exact: bool = True,
    policy: SkewPolicy = DEFAULT_SKEW,
    keys: Sequence[str] = ("vid",),
) -> DataFrame:
    """Sessions whose entry and exit reports lie on the two end segments, with their
    average speed (before the ``avg_speed > limit`` test)."""
    return crossings(session_endpoints(reports, params, exact, policy, keys), params)


def crossings(ep: DataFrame, params: Params = Params()) -> DataFrame:
    """The crossings among session endpoints, with their average speed."""
    lo, hi = params.lo_seg, params.hi_seg
    crossed = (
        f"(first.seg = {lo} AND last.seg = {hi}) OR (first.seg = {hi} AND last.seg = {lo})"
    )
    # try_divide: a one-report session (possible only when lo == hi) gives NULL, not an error
    avg = (
        "try_divide(CAST(abs(first.pos - last.pos) AS DOUBLE),"
        f" CAST(n - 1 AS DOUBLE) * CAST({float(params.interval)!r} AS DOUBLE))"
        f" * CAST({float(params.factor)!r} AS DOUBLE)"
    )
    return ep.where(crossed).selectExpr(
        "first.time AS time1",
        "last.time AS time2",
        "vid",
        "first.xway AS xway",
        "first.dir AS dir",
        f"{avg} AS avg_speed",
    )


def average_speed_control(
    reports: DataFrame,
    params: Params = Params(),
    exact: bool = True,
    policy: SkewPolicy = DEFAULT_SKEW,
    keys: Sequence[str] = ("vid",),
) -> DataFrame:
    """``time1, time2, vid, xway, dir, avg_speed`` of crossings faster than the limit."""
    sc = stretch_crossings(reports, params, exact, policy, keys)
    return sc.where(f"avg_speed > CAST({float(params.avg_limit)!r} AS DOUBLE)")
