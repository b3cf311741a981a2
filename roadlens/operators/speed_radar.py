"""Q1 speed radar: speeding reports with the vehicle's running maximum speed (AGG-1, PRJ-1).

As written in the reference, the keyed rolling ``max`` advances only the speed; every other
field stays that of the vehicle's *first* speeding report, and one row is emitted per
speeding report.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.config import DEFAULT_SKEW, SPEED_LIMIT, SkewPolicy
from roadlens.functions.predicates import speeding
from roadlens.plans.blocks import running
from roadlens.schema import ORDER, SPEED_RADAR_COLS

FROZEN = ("time", "xway", "seg", "dir")


def running_max(
    df: DataFrame,
    value: str = "speed",
    keys: Sequence[str] = ("vid",),
    order: Sequence[str] = ORDER,
    frozen: Sequence[str] = FROZEN,
    emit: str = "per_report",
    policy: SkewPolicy = DEFAULT_SKEW,
) -> DataFrame:
    """Running max of ``value`` per key; ``frozen`` columns keep the key's first row.

    ``emit="per_report"``: one row per input row (``keys``, ``frozen``, ``max_<value>``).
    ``emit="final"``: one row per key, the last of those rows -- a plain grouped aggregate
    with map-side partial aggregation.
    """
    out_name = f"max_{value}"
    first = f"struct({', '.join(frozen)})"
    unpack = [f"_first.{c} AS {c}" for c in frozen]
    if emit == "final":
        key = f"struct({', '.join(order)})"
        agg = df.groupBy(*keys).agg(
            F.expr(f"max({value}) AS {out_name}"), F.expr(f"min_by({first}, {key}) AS _first")
        )
        return agg.selectExpr(*keys, *unpack, out_name)
    if emit != "per_report":
        raise ValueError("emit must be 'per_report' or 'final'")
    rolled = running(
        df,
        keys=list(keys),
        order=list(order),
        aggs={out_name: ("max", value), "_first": ("first", first)},
        policy=policy,
    )
    return rolled.selectExpr(*keys, *unpack, out_name)


def speed_radar(
    reports: DataFrame,
    limit: int = SPEED_LIMIT,
    emit: str = "per_report",
    policy: SkewPolicy = DEFAULT_SKEW,
    order: Sequence[str] = ORDER,
) -> DataFrame:
    """``time, vid, xway, seg, dir, max_speed`` for every report with ``speed > limit``.

    ``order=ARRIVAL`` takes a vehicle's reports strictly as they arrived, whatever their ``time``.
    """
    fast = speeding(reports.select(*dict.fromkeys(["time", "seq", *order, "vid", "speed", "xway", "seg", "dir"])), limit)
    out = running_max(fast, "speed", order=order, emit=emit, policy=policy)
    return out.select(*SPEED_RADAR_COLS)


def speed_radar_final(
    reports: DataFrame, limit: int = SPEED_LIMIT, policy: SkewPolicy = DEFAULT_SKEW, order: Sequence[str] = ORDER
) -> DataFrame:
    """One row per speeding vehicle: the last row ``speed_radar`` emits for it."""
    return speed_radar(reports, limit, emit="final", policy=policy, order=order)
