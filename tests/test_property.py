"""Random report streams (mixed directions, segments unrelated to positions, tied times)
against the plain-Python model, on the plain and on the split plans."""

import pytest
from pyspark.sql import functions as F

from roadlens.config import Params
from roadlens.operators.sessions import sessionize
from roadlens.operators.speed_control import session_endpoints, stretch_crossings
from roadlens.operators.speed_radar import speed_radar
from roadlens.operators.stopped import accident_reporter
from roadlens.functions.fold import fold_endpoints
from tests import model
from tests.property_data import random_reports
from tests.util import POLICIES, collect, dicts, frame

ROW_TYPE = "struct<time:int,seq:bigint,xway:int,dir:int,seg:int,pos:int>"
SEEDS = [3, 17, 2024]


@pytest.mark.parametrize("seed", SEEDS)
@pytest.mark.parametrize("policy", ["default", "split", "sampled"])
def test_speed_radar_and_accidents(spark, seed, policy):
    rows = random_reports(seed)
    df = frame(spark, rows)
    p = POLICIES[policy]
    assert collect(speed_radar(df, policy=p)) == model.speed_radar(dicts(rows))
    assert collect(accident_reporter(df, policy=p)) == model.accident_reporter(dicts(rows))


@pytest.mark.parametrize("seed", SEEDS)
@pytest.mark.parametrize("policy", ["default", "split", "sampled"])
def test_session_fold(spark, seed, policy):
    rows = random_reports(seed)
    df = frame(spark, rows)
    ep = session_endpoints(df, Params(time_unit="s"), exact=True, policy=POLICIES[policy])
    got = collect(ep.select("vid", "session_start", "n", "first.seq", "last.seq"))
    assert got == model.endpoints(dicts(rows), gap=31)
    crossings = collect(stretch_crossings(df, Params(time_unit="s"), policy=POLICIES[policy]))
    want = model.stretch_crossings(dicts(rows), gap=31)
    assert [c[:5] for c in crossings] == [w[:5] for w in want]
    assert all(abs(c[5] - w[5]) < 1e-9 for c, w in zip(crossings, want))


@pytest.mark.parametrize("seed", SEEDS)
def test_fold_expression(spark, seed):
    """The higher-order ``aggregate`` fold used by the streaming query equals the model."""
    rows = random_reports(seed)
    s = sessionize(frame(spark, rows).where(F.col("seg").between(52, 56)), 31)
    row = F.struct("time", "seq", "xway", "dir", "seg", "pos")
    agg = s.groupBy("vid", "session_start").agg(
        F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list(row)).alias("rows")
    )
    ends = agg.select("vid", "session_start", "n", fold_endpoints("rows", ROW_TYPE).alias("e"))
    got = collect(ends.select("vid", "session_start", "n", "e.first.seq", "e.last.seq"))
    assert got == model.endpoints(dicts(rows), gap=31)


@pytest.mark.parametrize("seed", SEEDS[:2])
@pytest.mark.parametrize("policy", ["default", "split", "sampled"])
def test_extra_keys(spark, seed, policy):
    """keys=(vid, xway, dir): sessions per vehicle, expressway and direction."""
    rows = random_reports(seed)
    df = frame(spark, rows)
    keys = ("vid", "xway", "dir")
    got = collect(stretch_crossings(df, Params(time_unit="s"), policy=POLICIES[policy], keys=keys))
    want = model.stretch_crossings(dicts(rows), gap=31, keys=keys)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert all(abs(g[5] - w[5]) < 1e-9 for g, w in zip(got, want))


@pytest.mark.parametrize("policy", ["default", "split"])
def test_accident_reporter_extra_keys(spark, policy):
    rows = random_reports(5)
    keys = ("vid", "xway")
    got = collect(accident_reporter(frame(spark, rows), keys=keys, policy=POLICIES[policy]))
    assert got == model.accident_reporter(dicts(rows), keys=keys)
