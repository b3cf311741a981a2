"""One vehicle holds a third of all reports: it is found, split into blocks, results unchanged."""

import random

import pytest
from pyspark.sql import functions as F

from roadlens.config import Params, SkewPolicy
from roadlens.operators.sessions import sessions
from roadlens.operators.speed_control import stretch_crossings
from roadlens.operators.speed_radar import speed_radar
from roadlens.operators.stopped import accident_reporter
from roadlens.plans.blocks import hot_key_table, split_hot
from tests import model
from tests.util import NO_SPLIT, collect, dicts, frame

# thresholds scaled down with the data: a vehicle above 400 reports is hot, blocks of ~60
HOT = SkewPolicy(hot_rows=400, block_rows=60, max_blocks=64, max_hot_keys=8, sample_rows=120)


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(7)
    rows = []
    for vid in range(40):
        n = 1200 if vid == 5 else 60  # vehicle 5: 1200 of 3540 reports
        t, pos = 0, 0
        for i in range(n):
            t += rnd.choice([30, 30, 30, 31, 32, 600])
            if rnd.random() < 0.35:
                pos = rnd.randint(0, 2) * 5280
            seg = 52 + (i // 3) % 5
            rows.append((t, vid, rnd.randint(70, 130), 0, 1, vid % 2, seg, pos + seg))
    return rows, frame(spark, rows)


def test_hot_vehicle_is_found_and_split(spark, skewed):
    rows, df = skewed
    hot = hot_key_table(df, ["vid"], "time", HOT)
    assert hot is not None and [r["vid"] for r in hot.collect()] == [5]
    blocked, is_hot = split_hot(df, ["vid"], "time", HOT)
    assert is_hot
    blocks = blocked.where(F.col("vid") == 5).select("_blk").distinct().count()
    assert blocks >= 10
    assert blocked.where(F.col("vid") != 5).select("_blk").distinct().collect()[0][0] == -1


def test_results_equal_unsplit_and_model(spark, skewed):
    rows, df = skewed
    assert collect(speed_radar(df, policy=HOT)) == collect(speed_radar(df, policy=NO_SPLIT))
    assert collect(speed_radar(df, policy=HOT)) == model.speed_radar(dicts(rows))
    assert collect(accident_reporter(df, policy=HOT)) == model.accident_reporter(dicts(rows))
    p = Params(time_unit="s")
    assert collect(sessions(df.where("seg BETWEEN 52 AND 56"), p, policy=HOT)) == collect(
        sessions(df.where("seg BETWEEN 52 AND 56"), p, policy=NO_SPLIT)
    )
    got = collect(stretch_crossings(df, p, policy=HOT))
    want = model.stretch_crossings(dicts(rows), gap=31)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert all(abs(g[5] - w[5]) < 1e-9 for g, w in zip(got, want))


@pytest.mark.parametrize("clock", ["event", "cadence"])
def test_report_view_split_equals_plain(spark, smoke_dir, clock):
    """The view numbers each user's events with a running count: exact on split plans too."""
    from roadlens.sources.events_view import load_reports, load_reports_and_policy
    from tests.util import SAMPLED, SPLIT_ALL

    plain = collect(load_reports(spark, smoke_dir, clock=clock, policy=NO_SPLIT))
    assert collect(load_reports(spark, smoke_dir, clock=clock, policy=SPLIT_ALL)) == plain
    assert collect(load_reports(spark, smoke_dir, clock=clock, policy=SAMPLED)) == plain
    _, policy = load_reports_and_policy(spark, smoke_dir, clock=clock)
    assert not policy.enabled  # no user is hot in the test data: the check is not repeated
    _, policy = load_reports_and_policy(spark, smoke_dir, clock=clock, policy=SPLIT_ALL)
    assert policy.enabled  # every user is hot under SPLIT_ALL: vehicle operators check again


def test_block_layout_is_clamped(spark):
    """Blocks come from a sample; reports outside the sampled range still get a valid block."""
    rows = [(t, 1, 50, 0, 1, 0, 52, 0) for t in range(0, 3000)] + [(10**6, 1, 50, 0, 1, 0, 52, 0)]
    policy = SkewPolicy(hot_rows=500, block_rows=100, max_blocks=16, max_hot_keys=4, sample_rows=50)
    blocked, hot = split_hot(frame(spark, rows), ["vid"], "time", policy)
    assert hot
    blocks = [r[0] for r in blocked.select("_blk").distinct().collect()]
    assert min(blocks) >= 0 and max(blocks) <= 15 and len(blocks) > 4


def test_blocks_follow_density(spark):
    """A burst (2,400 reports within 2,400 s) after a sparse tail (300 reports over ~3 years):
    quantile boundaries spread the burst over many blocks; uniform widths would not."""
    rows = [(10**5 * i, 1, 50, 0, 1, 0, 52, 0) for i in range(300)]
    rows += [(10**8 + i, 1, 50, 0, 1, 0, 52, 0) for i in range(2400)]
    policy = SkewPolicy(hot_rows=500, block_rows=150, max_blocks=64, max_hot_keys=4, sample_rows=1000)
    blocked, hot = split_hot(frame(spark, rows), ["vid"], "time", policy)
    assert hot
    sizes = [r["n"] for r in blocked.groupBy("_blk").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(sizes) >= 15
    assert max(sizes) <= 3 * 150
    # and the split result stays exact
    df = frame(spark, rows)
    assert collect(speed_radar(df, policy=policy)) == collect(speed_radar(df, policy=NO_SPLIT))


def test_hot_instant_is_split_by_seq(spark):
    """3,000 reports of one vehicle share one time value: split by seq, results unchanged."""
    rnd = random.Random(11)
    rows = [(30 * i, 1, rnd.randint(85, 130), 0, 1, 0, 52 + i % 5, rnd.choice([0, 0, 7])) for i in range(200)]
    rows += [(10_000, 1, rnd.randint(85, 130), 0, 1, 0, 52 + i % 5, rnd.choice([0, 0, 7])) for i in range(3000)]
    rows += [(10_030 + 30 * i, 1, rnd.randint(85, 130), 0, 1, 0, 56, 9) for i in range(100)]
    rnd.shuffle(rows)
    policy = SkewPolicy(hot_rows=500, block_rows=150, max_blocks=64, max_hot_keys=4, sample_rows=1000)
    df = frame(spark, rows)
    blocked, hot = split_hot(df, ["vid"], "time", policy, tiebreak="seq")
    assert hot
    at_instant = blocked.where(F.col("time") == 10_000).groupBy("_blk").count().collect()
    assert len(at_instant) >= 10 and max(r["count"] for r in at_instant) <= 3 * 150
    assert collect(speed_radar(df, policy=policy)) == collect(speed_radar(df, policy=NO_SPLIT))
    assert collect(accident_reporter(df, policy=policy)) == collect(accident_reporter(df, policy=NO_SPLIT))
    p = Params(time_unit="s")
    assert collect(stretch_crossings(df, p, policy=policy)) == collect(stretch_crossings(df, p, policy=NO_SPLIT))
    assert collect(sessions(df, p, policy=policy)) == collect(sessions(df, p, policy=NO_SPLIT))


def test_report_view_hot_instant(spark):
    """One user with 2,000 events at one timestamp: the view's report numbering is exact."""
    import datetime as dt

    from roadlens.sources.events_view import reports_from_events

    base = dt.datetime(2024, 1, 1, 8, 0, 0)
    rows = [(i, base, 7, "view", float(i % 120), "{}") for i in range(2000)]
    rows += [(2000 + i, base + dt.timedelta(seconds=i + 1), 7, "view", 95.0, "{}") for i in range(300)]
    rows += [(5000 + i, base + dt.timedelta(seconds=7 * i), 8, "click", 91.0, "{}") for i in range(50)]
    events = spark.createDataFrame(
        rows, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    )
    policy = SkewPolicy(hot_rows=400, block_rows=100, max_blocks=64, max_hot_keys=4, sample_rows=1000)
    got = collect(reports_from_events(events, policy=policy))
    assert got == collect(reports_from_events(events, policy=NO_SPLIT))
    from roadlens.plans.blocks import split_hot

    ev = events.selectExpr("user_id", "event_id", "ts", "timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts) AS _us")
    blocked, hot = split_hot(ev, ["user_id"], "_us", policy, tiebreak="event_id")
    assert hot
    at_instant = blocked.where(F.col("event_id") < 2000).select("_blk").distinct().count()
    assert at_instant >= 8
