"""Split-safe per-key ordered computations.

Ordered per-vehicle operators (running aggregates, lags, trailing row frames) are windows
partitioned by the vehicle. If one vehicle held a third of all reports, a plain
``Window.partitionBy("vid")`` would hand that third to a single task. The helpers here keep
the declarative window plan but partition by ``(key, block)``:

* ``split_hot`` counts rows per key on a seeded sample (map-side partially aggregated).
  Keys above ``SkewPolicy.hot_rows`` rows are *hot*; they are cut into contiguous ranges
  of ``(axis, tiebreak)`` ("blocks", ~``block_rows`` rows each) at quantile boundaries taken
  on the same sample, and each row finds its block with a native binary search. Ordinary
  keys keep a single block ``-1``. The boundary table is bounded (``max_hot_keys`` keys,
  ``max_total_blocks`` boundaries) and broadcast; keys past the bound stay single-block
  (exact, unsplit). ``checked_policy`` runs the check once for several operators on
  subsets of the same rows.
* ``running`` computes running aggregates inside each block and adds a carry from earlier
  blocks, taken from per-block summaries (a few rows per block, windowed per key).
* ``trailing`` computes frames of the current row and the ``h`` rows before it inside each
  block; the first ``h`` rows of each hot block are recomputed over the *edge table* (the
  first and last ``h`` rows of every hot block), which holds all rows they can reach.

With no hot key the helpers build the plain per-key window plan and nothing else. With hot
keys, every filter on the block column sits on a window partition column, so Catalyst
pushes it below the window and the exchange: the hot-only branches read and shuffle hot
rows only.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlens.config import DEFAULT_SKEW, SkewPolicy

BLK = "_blk"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hot_key_table(
    df: DataFrame,
    keys: Sequence[str],
    axis: str | Column,
    policy: SkewPolicy = DEFAULT_SKEW,
    tiebreak: str | None = None,
    boundaries: bool = True,
) -> DataFrame | None:
    """Hot keys with their block boundaries (``keys, _q``), or None if no key is hot.

    ``boundaries=False`` stops after the first job (hot keys only, no ``_q``): enough to
    know whether any key is hot.

    ``_q`` is an ascending array of ``struct(t, s)``: a row belongs after every boundary
    that is <= ``struct(axis, tiebreak)``.

    One job over a seeded Bernoulli sample of the rows (fraction ``f`` chosen so that a key
    with ``hot_rows`` rows is expected to show ``sample_rows`` times; ``f = 1`` for tiny
    thresholds, then the counts are exact). The sample is grouped by key with map-side
    partial aggregation, so the shuffle is ~``f`` times the rows; a key is hot when its
    sampled count passes half its expectation -- a key with ``hot_rows`` rows is missed
    with negligible probability, and a smaller key that is split only costs balance.

    Only when some key is hot, a second job over the same sample (hot keys only) takes a
    grid of ``quantile_grid`` approximate quantiles of the axis per hot key. A hot key gets
    ``nb`` blocks (``rows / block_rows``, at most ``max_blocks``; all hot keys together at
    most ``max_total_blocks``, block size grows when that budget is reached) and ``nb - 1``
    ascending boundaries interpolated on its quantile grid, so blocks follow the key's
    density over the axis -- a burst gets many blocks. The table that reaches the driver and
    is broadcast holds at most ``max_hot_keys`` keys and ``max_total_blocks`` boundaries.
    Boundaries only affect balance, never results: any monotone block assignment is
    stitched back exactly.

    Hot instants: when several boundaries of a key fall on one axis value (a large share of
    its rows at one ``time``), a third job on the sample (those instants only) takes
    quantiles of the ``tiebreak`` column there, and the repeated boundaries become
    ``(t, s_k)`` pairs, so one instant is split over several blocks in ``(time, seq)`` order.
    """
    ax = _col(axis).cast("bigint")
    frac = min(1.0, policy.sample_rows / max(1, policy.hot_rows))
    rows = df.sample(fraction=frac, seed=policy.seed) if frac < 1.0 else df
    threshold = policy.hot_rows if frac >= 1.0 else 0.5 * policy.hot_rows * frac
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    hot = (
        counts.where(F.col("_n") > F.lit(threshold))
        .orderBy(F.col("_n").desc(), *keys)
        .limit(policy.max_hot_keys)
    )
    found = hot.collect()  # at most max_hot_keys rows
    if not found:
        return None
    if not boundaries:
        return df.sparkSession.createDataFrame(found, schema=hot.schema)
    # blocks per hot key, within the total budget (arithmetic on the bounded hot-key list)
    estimates = [r["_n"] / frac for r in found]
    block = max(policy.block_rows, math.ceil(sum(estimates) / policy.max_total_blocks))
    nbs = [int(min(policy.max_blocks, max(1, math.ceil(e / block)))) for e in estimates]
    spark = df.sparkSession
    hot_keys = spark.createDataFrame(
        [(*[r[k] for k in keys], nb) for r, nb in zip(found, nbs)],
        schema=T.StructType([*[hot.schema[k] for k in keys], T.StructField("_nb", T.IntegerType())]),
    )
    grid = policy.quantile_grid
    fractions = ", ".join(f"{i / grid!r}" for i in range(grid + 1))  # 0 .. 1: min .. max
    quant = (
        rows.select(*keys, ax.alias("_ax"))
        .join(F.broadcast(hot_keys), on=list(keys), how="inner")
        .groupBy(*keys, "_nb")
        .agg(F.expr(f"percentile_approx(_ax, array({fractions})) AS _g"))
    )
    # boundary i of nb sits at grid position x = i * grid / nb, interpolated between grid points
    x = f"(i * {grid}.0 / _nb)"
    j = f"CAST(floor({x}) AS INT)"
    point = f"_g[{j}] + ({x} - floor({x})) * (_g[{j} + 1] - _g[{j}])"
    pick = f"CASE WHEN _nb > 1 THEN transform(sequence(1, _nb - 1), i -> CAST(floor({point}) AS BIGINT)) ELSE array() END"
    bounds = quant.selectExpr(*[f"`{k}`" for k in keys], f"CAST({pick} AS ARRAY<BIGINT>) AS _q")
    times = {tuple(r[k] for k in keys): list(r["_q"]) for r in bounds.collect()}
    ties = _hot_instants(times) if tiebreak else {}
    seq_grid = _instant_quantiles(rows, keys, ax, tiebreak, ties, grid, hot.schema) if ties else {}
    key_fields = [hot.schema[k] for k in keys]
    schema = T.StructType([*key_fields, T.StructField("_q", T.ArrayType(_BOUND))])
    table = [(*key, _composite(key, ts, seq_grid)) for key, ts in times.items()]
    return spark.createDataFrame(table, schema=schema)


LOWEST = -(2**63)
_BOUND = T.StructType([T.StructField("t", T.LongType()), T.StructField("s", T.LongType())])


def _hot_instants(times: dict[tuple, list[int]]) -> dict[tuple, int]:
    """(key..., t) -> number of boundaries sitting on t, for runs of 2 or more."""
    out = {}
    for key, ts in times.items():
        for t in set(ts):
            n = ts.count(t)
            if n >= 2:
                out[(*key, t)] = n
    return out


def _instant_quantiles(rows, keys, ax, tiebreak, ties, grid, key_schema) -> dict[tuple, list[int]]:
    """Quantile grid of ``tiebreak`` among sampled rows at each hot instant (bounded list)."""
    spark = rows.sparkSession
    inst = spark.createDataFrame(
        list(ties),
        schema=T.StructType([*[key_schema[k] for k in keys], T.StructField("_t", T.LongType())]),
    )
    fractions = ", ".join(f"{i / grid!r}" for i in range(grid + 1))
    q = (
        rows.select(*keys, ax.alias("_t"), F.col(tiebreak).cast("bigint").alias("_s"))
        .join(F.broadcast(inst), on=[*keys, "_t"], how="inner")
        .groupBy(*keys, "_t")
        .agg(F.expr(f"percentile_approx(_s, array({fractions})) AS _g"))
    )
    return {(*[r[k] for k in keys], r["_t"]): list(r["_g"]) for r in q.collect()}


def _composite(key: tuple, ts: list[int], seq_grid: dict[tuple, list[int]]) -> list[tuple[int, int]]:
    """Boundaries as (t, s): (t, lowest) except inside a run of equal t at a hot instant,
    where the run's later boundaries are interpolated on the instant's quantiles of s."""
    out: list[tuple[int, int]] = []
    i = 0
    while i < len(ts):
        t = ts[i]
        j = i
        while j < len(ts) and ts[j] == t:
            j += 1
        run = j - i
        g = seq_grid.get((*key, t))
        out.append((t, LOWEST))
        for k in range(1, run):
            if g:
                x = k * (len(g) - 1) / run
                lo = int(math.floor(x))
                hi = min(lo + 1, len(g) - 1)
                out.append((t, int(math.floor(g[lo] + (x - lo) * (g[hi] - g[lo])))))
            else:
                out.append((t, LOWEST))
        i = j
    return out


def checked_policy(
    df: DataFrame,
    keys: Sequence[str],
    axis: str | Column,
    policy: SkewPolicy = DEFAULT_SKEW,
) -> SkewPolicy:
    """Check ``df`` once; if no key is hot, return a policy that skips the check.

    A key's rows in any subset of ``df`` are at most its rows in ``df``, so operators on
    subsets of ``df`` keyed by ``keys`` can use the returned policy.
    """
    if not policy.enabled or hot_key_table(df, keys, axis, policy, boundaries=False) is not None:
        return policy
    return replace(policy, enabled=False)


def split_hot(
    df: DataFrame,
    keys: Sequence[str],
    axis: str | Column,
    policy: SkewPolicy = DEFAULT_SKEW,
    tiebreak: str | None = None,
) -> tuple[DataFrame, bool]:
    """``(df with _blk, True)`` when some key is hot, else ``(df, False)`` unchanged.

    ``axis`` then ``tiebreak`` must be the leading columns of the per-key order. Callers
    build the plain per-key plan when no key is hot (nothing to stitch together).
    """
    hot = hot_key_table(df, keys, axis, policy, tiebreak) if policy.enabled else None
    if hot is None:
        return df, False
    return _assign_blocks(df, keys, axis, hot, tiebreak), True


def _tiebreak(order: Sequence[str], axis: str | Column | None, orders_like: str | None = None) -> str | None:
    """The second order column, usable to split an instant only when the axis orders rows
    exactly as the first order column does (the column itself, or one declared with
    ``axis_orders_like``); a coarser axis, e.g. whole seconds of a timestamp, is not."""
    if len(order) < 2:
        return None
    same = axis is None or (isinstance(axis, str) and axis == order[0]) or orders_like == order[0]
    return order[1] if same else None


SEARCH_STEPS = 17  # halvings: enough for up to 2**16 boundaries per key (max_blocks <= 65536)


def _block_of(axis_sql: str, steps: int) -> str:
    """SQL: how many boundaries in ``_q`` are <= the point -- a binary search in ``steps``
    halvings, as a native higher-order ``aggregate`` (no Python)."""
    mid = "CAST((a.lo + a.hi) div 2 AS INT)"
    return (
        f"aggregate(sequence(1, {steps}), named_struct('lo', 0, 'hi', size(_q)), (a, i) -> "
        f"CASE WHEN a.lo >= a.hi THEN a "
        f"WHEN _q[{mid}] <= {axis_sql} THEN named_struct('lo', {mid} + 1, 'hi', a.hi) "
        f"ELSE named_struct('lo', a.lo, 'hi', {mid}) END).lo"
    )


def _assign_blocks(
    df: DataFrame, keys: Sequence[str], axis: str | Column, hot: DataFrame, tiebreak: str | None
) -> DataFrame:
    cols = df.columns
    tb = F.coalesce(F.col(tiebreak).cast("bigint"), F.lit(LOWEST)) if tiebreak else F.lit(LOWEST)
    joined = (
        df.join(F.broadcast(hot), on=list(keys), how="left")
        .withColumn("_ax", _col(axis).cast("bigint"))
        .withColumn("_tb", tb.cast("bigint"))
    )
    point = "named_struct('t', _ax, 's', _tb)"
    blk = f"CASE WHEN _q IS NULL THEN -1 ELSE {_block_of(point, SEARCH_STEPS)} END"
    return joined.selectExpr(*[f"`{c}`" for c in cols], f"CAST({blk} AS BIGINT) AS {BLK}")


# ----------------------------------------------------------------------------------------
# running aggregates
# ----------------------------------------------------------------------------------------
# Expressions are SQL text (one call to the JVM each, however large the expression).

UPTO = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
WHOLE = "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING"

_LOCAL = {"sum": "sum({v})", "count": "count(1)", "max": "max({v})", "min": "min({v})", "first": "first({v})"}
_BLOCK = {"sum": "sum({v})", "count": "count(1)", "max": "max({v})", "min": "min({v})", "first": "min_by({v}, {k})"}
_CARRY = {"sum": "sum({c})", "count": "sum({c})", "max": "max({c})", "min": "min({c})", "first": "first({c})"}
_COMBINE = {
    "sum": "{l} + coalesce({c}, 0)",
    "count": "{l} + coalesce({c}, 0)",
    "max": "greatest({l}, {c})",
    "min": "least({l}, {c})",
    "first": "coalesce({c}, {l})",
}


def over(partition: Sequence[str], order: Sequence[str], frame: str = "") -> str:
    """``OVER (PARTITION BY .. ORDER BY .. frame)`` for column names."""
    part = ", ".join(f"`{c}`" for c in partition)
    ordr = f" ORDER BY {', '.join(f'`{c}`' for c in order)}" if order else ""
    return f"OVER (PARTITION BY {part}{ordr} {frame})"


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    aggs: dict[str, tuple[str, str | None]],
    axis: str | Column | None = None,
    policy: SkewPolicy = DEFAULT_SKEW,
    axis_orders_like: str | None = None,
) -> DataFrame:
    """Add running aggregates (first row .. current row, per key, in ``order``).

    ``axis`` (default: the first order column) places hot-key blocks; if it is another
    column that orders rows exactly like the first order column (e.g. its microseconds),
    name that column in ``axis_orders_like`` so hot instants can be split on ``order[1]``.

    ``aggs`` maps an output name to ``(kind, sql)`` with kind one of
    ``sum count max min first`` and ``sql`` a SQL expression over ``df``'s columns
    (``first`` is the expression's value at the key's first row). One shuffle of the rows
    by the key (by ``(key, block)`` with hot keys, which add a small summary pass).
    """
    for kind, _ in aggs.values():
        if kind not in _LOCAL:
            raise ValueError(f"unknown running aggregate {kind!r}")
    keys, order = list(keys), list(order)
    tiebreak = _tiebreak(order, axis, axis_orders_like)
    axis = axis if axis is not None else order[0]
    b, hot = split_hot(df, keys, axis, policy, tiebreak)
    if not hot:
        w = over(keys, order, UPTO)
        return df.selectExpr(
            "*", *[f"{_LOCAL[k].format(v=v)} {w} AS `{n}`" for n, (k, v) in aggs.items()]
        )
    w = over([*keys, BLK], order, UPTO)
    main = b.selectExpr(
        "*", *[f"{_LOCAL[k].format(v=v)} {w} AS `_l_{n}`" for n, (k, v) in aggs.items()]
    )
    order_key = f"struct({', '.join(f'`{o}`' for o in order)})"
    summ = (
        b.where(F.col(BLK) >= 0)
        .groupBy(*keys, BLK)
        .agg(*[F.expr(f"{_BLOCK[k].format(v=v, k=order_key)} AS `_b_{n}`") for n, (k, v) in aggs.items()])
    )
    before = over(keys, [BLK], "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING")
    carry = summ.selectExpr(
        *[f"`{k}`" for k in keys],
        BLK,
        *[f"{_CARRY[k].format(c=f'`_b_{n}`')} {before} AS `_c_{n}`" for n, (k, _) in aggs.items()],
    )
    joined = main.join(carry, on=[*keys, BLK], how="left")
    return joined.selectExpr(
        *[f"`{c}`" for c in df.columns],
        *[
            f"{_COMBINE[k].format(l=f'`_l_{n}`', c=f'`_c_{n}`')} AS `{n}`"
            for n, (k, _) in aggs.items()
        ],
    )


# ----------------------------------------------------------------------------------------
# trailing row frames
# ----------------------------------------------------------------------------------------


def trailing(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    preceding: int,
    exprs: dict[str, str],
    axis: str | Column | None = None,
    policy: SkewPolicy = DEFAULT_SKEW,
) -> DataFrame:
    """Add aggregates over the frame ``ROWS BETWEEN preceding PRECEDING AND CURRENT ROW``.

    ``exprs`` maps output names to SQL aggregate expressions (without ``OVER``).
    """
    h = int(preceding)
    if h < 0:
        raise ValueError("preceding must be >= 0")
    keys, order = list(keys), list(order)
    tiebreak = _tiebreak(order, axis)
    axis = axis if axis is not None else order[0]
    frame = f"ROWS BETWEEN {h} PRECEDING AND CURRENT ROW"
    b, hot = split_hot(df, keys, axis, policy, tiebreak)
    if not hot:
        w = over(keys, order, frame)
        return df.selectExpr("*", *[f"{e} {w} AS `{n}`" for n, e in exprs.items()])
    base = b.columns
    names = [f"`{n}`" for n in exprs]
    cols = [f"`{c}`" for c in df.columns]
    part = [*keys, BLK]
    main = b.selectExpr(
        "*",
        *[f"{e} {over(part, order, frame)} AS `{n}`" for n, e in exprs.items()],
        f"row_number() {over(part, order)} AS _rn",
        f"count(1) {over(part, order, WHOLE)} AS _cnt",
    )
    exact = main.where(f"{BLK} < 0 OR _rn > {h}").selectExpr(*cols, *names)
    if h == 0:
        return exact
    edges = main.where(f"{BLK} >= 0 AND (_rn <= {h} OR _rn > _cnt - {h})").select(*base, "_rn")
    fixed = (
        edges.selectExpr("*", *[f"{e} {over(keys, order, frame)} AS `{n}`" for n, e in exprs.items()])
        .where(f"_rn <= {h}")
        .selectExpr(*cols, *names)
    )
    return exact.unionByName(fixed)
