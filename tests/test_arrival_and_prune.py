"""Arrival order as an option (TIM-4), and the pruning of rows that cannot change the Q2 fold (AGG-2)."""

import random

import pytest

from roadlens import Params, accident_reporter, average_speed_control, speed_radar, speed_radar_final
from roadlens.operators.sessions import sessionize
from roadlens.operators.speed_control import exact_fold, prune, session_endpoints
from roadlens.schema import ARRIVAL
from tests import model
from tests.property_data import random_reports
from tests.util import POLICIES, SPLIT_ALL, collect, dicts, frame

SECONDS = Params(time_unit="s")


def by_arrival(rows):
    """The model orders by (time, seq): give it the arrival as time, and the time back afterwards."""
    return [{**r, "time": r["seq"]} for r in rows], {r["seq"]: r["time"] for r in rows}


@pytest.mark.parametrize("policy", list(POLICIES))
@pytest.mark.parametrize("seed", [1, 2])
def test_arrival_order(spark, seed, policy):
    tuples = random_reports(seed)
    df = frame(spark, tuples).repartition(3)
    rows, time = by_arrival(dicts(tuples))
    radar = sorted((time[r[0]], *r[1:]) for r in model.speed_radar(rows))
    assert collect(speed_radar(df, policy=POLICIES[policy], order=ARRIVAL)) == radar
    stops = sorted((time[r[0]], time[r[1]], *r[2:]) for r in model.accident_reporter(rows))
    assert stops and collect(accident_reporter(df, policy=POLICIES[policy], order=ARRIVAL)) == stops
    if seed == 1:
        assert collect(speed_radar_final(df, order=ARRIVAL)) == sorted({r[1]: r for r in sorted(radar, key=lambda r: r[5])}.values())


def one_session(seed, n=3000, mixed=True):
    rnd = random.Random(seed)
    t, rows = 0, []
    for _ in range(n):
        t += rnd.choice([0, 1, 10, 31])
        rows.append((t, 7, 100, 1, 1, rnd.choice([0, 1, 2]) if mixed and rnd.random() < 0.2 else 0, rnd.randint(52, 56), rnd.randint(0, 400)))
    return rows


@pytest.mark.parametrize("mixed", [True, False])
@pytest.mark.parametrize("seed", range(4))
def test_pruned_session_folds_alike(spark, seed, mixed):
    tuples = one_session(seed, mixed=mixed)
    s = sessionize(frame(spark, tuples).repartition(4), SECONDS.gap_units)
    kept = prune(s, 52, 56, ["vid", "session_start"], SPLIT_ALL).cache()
    try:
        assert kept.count() < len(tuples) * (0.9 if mixed else 0.8)
        (got,) = exact_fold(kept).collect()
        first, last = model.fold(sorted(dicts(tuples), key=lambda r: (r["time"], r["seq"])))
        assert (got.n, got["first"].seq, got["last"].seq) == (len(tuples), first["seq"], last["seq"])
    finally:
        kept.unpersist()


def test_one_hard_session_over_blocks(spark):
    tuples = one_session(9, 600) + random_reports(4)
    got = session_endpoints(frame(spark, tuples), SECONDS, policy=SPLIT_ALL)
    got = sorted((r.vid, r.session_start, r.n, r["first"].seq, r["last"].seq) for r in got.collect())
    assert got == model.endpoints(dicts(tuples), SECONDS.gap_units)
    assert collect(average_speed_control(frame(spark, tuples), SECONDS, policy=SPLIT_ALL)) == collect(average_speed_control(frame(spark, tuples), SECONDS))
