"""Streams with a carry (KEY-1..4, WIN-2, TIM-1), the quarantine on a stream, the outputs' commit."""

import os
import tempfile

import pytest

from roadlens import accident_reporter, speed_radar
from roadlens.operators.stopped import count_window_firings
from roadlens.sources.folders import exists
from roadlens.sources.reports import bad_lines, lines_to_reports
from roadlens.sources.sinks import MANIFEST, finish_commit, write_all
from roadlens.streaming import carried
from roadlens.streaming.quarantine import Quarantine, stream_quarantine
from tests.property_data import random_reports
from tests.test_parser import CASES
from tests.util import SPLIT_ALL, collect, dicts, frame


def folder():
    return tempfile.mkdtemp(prefix="roadlens-test-")


def cut(tuples, parts=3):
    """Reports in time order, cut into micro-batches; one vehicle holds a third of them."""
    rows = sorted(tuples, key=lambda t: t[0])
    rows = [(t[0], 1 if i % 3 == 0 else t[1], *t[2:]) for i, t in enumerate(rows)]
    return rows, [len(rows) * i // parts for i in range(parts + 1)]


def run(spark, operator, df, bounds):
    for batch, (lo, hi) in enumerate(zip(bounds[:-1], bounds[1:])):
        operator(df.where(f"seq >= {lo} AND seq < {hi}"), batch)
    return operator.results().drop("batch")


@pytest.mark.parametrize("name", ["radar", "accident", "window"])
def test_batches_equal_the_whole(spark, name):
    rows, bounds = cut(random_reports(3))
    df = frame(spark, rows).repartition(3)
    step, carry, out, want = {
        "radar": (carried.radar_step(policy=SPLIT_ALL), carried.RADAR_CARRY, carried.RADAR_OUT, speed_radar(df)),
        "accident": (carried.accident_step(policy=SPLIT_ALL), carried.COUNT_CARRY, carried.ACCIDENT_OUT, accident_reporter(df)),
        "window": (carried.count_window_step(3, 5), carried.COUNT_CARRY, carried.FIRING_OUT, count_window_firings(df, 3, slide=5)),
    }[name]
    operator = carried.Carried(spark, folder(), step, carry, out)
    got = collect(run(spark, operator, df, bounds))
    assert got and got == collect(want)
    operator(df.where(f"seq >= {bounds[-2]}"), len(bounds) - 2)  # the last batch again, as after a failure
    assert collect(operator.results().drop("batch")) == got
    assert not exists(spark, f"{operator.folder}/carry/0")


@pytest.mark.parametrize("size,slide", [(1, 1), (4, 2), (2, 7), (5, 5)])
def test_count_window_by_ordinal(spark, size, slide):
    tuples = random_reports(5)
    want = []
    for vid in {t[1] for t in tuples}:
        mine = sorted((r for r in dicts(tuples) if r["vid"] == vid), key=lambda r: (r["time"], r["seq"]))
        for k in range(slide, len(mine) + 1, slide):
            held = mine[max(0, k - size) : k]
            want.append((vid, held[0]["time"], held[-1]["time"], len(held), held[0]["pos"], held[-1]["pos"]))
    df = frame(spark, tuples)
    assert want and collect(count_window_firings(df, size, slide=slide)) == sorted(want)
    assert collect(count_window_firings(df, size, policy=SPLIT_ALL, slide=slide)) == sorted(want)


def test_empty_batch_keeps_the_carry(spark):
    rows = [(t, 7, 100, 1, 1, 0, 52, 5) for t in range(5)]
    df = frame(spark, rows)
    operator = carried.Carried(spark, folder(), carried.accident_step(), carried.COUNT_CARRY, carried.ACCIDENT_OUT)
    assert collect(run(spark, operator, df, [0, 3, 3, 5])) == collect(accident_reporter(df)) != []


def test_bad_window(spark):
    with pytest.raises(ValueError):
        carried.count_window_step(0, 1)
    with pytest.raises(ValueError):
        count_window_firings(frame(spark, []), 4, slide=0)


def test_steps_back(spark):
    times = [5, 7, 7, 6, 9, 8, 8, 10, 1]
    df = frame(spark, [(t, i % 2, 0, 0, 0, 0, 52, 0) for i, t in enumerate(times)])
    for policy in (SPLIT_ALL, carried.DEFAULT_SKEW):
        operator = carried.Carried(spark, folder(), carried.backward_step(policy), carried.BACKWARD_CARRY, carried.BACKWARD_OUT)
        run(spark, operator, df, [0, 4, 5, 5, 9])
        assert [tuple(r) for r in operator.results().orderBy("batch").collect()] == [(1, 4, 0), (0, 1, 1), (0, 0, 2), (3, 4, 3)]


def test_quarantine_on_a_stream(spark):
    base = folder()
    lines = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)] + [(99, None)], "seq long, value string")
    quarantine = Quarantine(spark, f"{base}/out")
    for part in ("seq < 5", "seq >= 5"):
        lines.where(part).write.mode("append").parquet(f"{base}/in")
        stream_quarantine(spark.readStream.schema(lines.schema).parquet(f"{base}/in"), quarantine, f"{base}/ckpt").awaitTermination()
    batch = lines.select("seq", "value")
    assert collect(quarantine.good()) == collect(lines_to_reports(batch, on_error="quarantine")) != []
    assert sorted(r.line or "" for r in quarantine.bad().collect()) == sorted(r.value or "" for r in bad_lines(batch).collect())
    quarantine(lines.where("seq >= 5"), 1)  # again
    assert quarantine.lines().count() == lines.count()


def test_failed_output_leaves_nothing_behind(spark):
    prefix = os.path.join(folder(), "out")
    good = lambda: spark.range(3)
    bad = lambda: spark.range(3).selectExpr("CAST(raise_error('no') AS INT) AS x")
    with pytest.raises(Exception, match="no"):
        write_all(spark, {"a.csv": good, "b.csv": bad}, prefix)
    assert os.listdir(prefix) == []
    out = write_all(spark, {"a.csv": good, "b.csv": good}, prefix)
    assert sorted(os.listdir(prefix)) == ["a.csv", "b.csv"]
    assert collect(spark.read.csv(out["b.csv"])) == [("0",), ("1",), ("2",)]
    with pytest.raises(FileExistsError):
        write_all(spark, {"b.csv": good}, prefix)


def test_interrupted_commit_is_completed(spark):
    prefix = os.path.join(folder(), "out")
    for name in ("a", "b"):
        spark.range(2).write.csv(f"{prefix}/_staging-x/{name}.csv")
    os.rename(f"{prefix}/_staging-x/a.csv", f"{prefix}/a.csv")  # the first move was done
    moves = [(f"{prefix}/_staging-x/{n}.csv", f"{prefix}/{n}.csv") for n in ("a", "b")]
    spark.createDataFrame(moves, "source string, target string").write.json(f"{prefix}/{MANIFEST}")
    assert finish_commit(spark, prefix)
    assert spark.read.csv(f"{prefix}/b.csv").count() == 2
    assert not finish_commit(spark, prefix)
