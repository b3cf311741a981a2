"""Late reports are judged by the session they join (TIM-3): hand-worked batches, reruns, random batches against a model."""

import random
import tempfile

import pytest

from roadlens import Params
from roadlens.config import SkewPolicy
from roadlens.streaming.late import LateSpeedControl
from tests import model
from tests.util import NO_SPLIT, SPLIT_ALL, collect, frame

SECONDS = Params(time_unit="s")  # gap 31 s


def operator(spark, policy=NO_SPLIT):
    return LateSpeedControl(spark, tempfile.mkdtemp(prefix="roadlens-test-late-"), SECONDS, policy)


def report(time, vid, seg, pos, direction=0):
    return (time, vid, 70, 1, 1, direction, seg, pos)


def test_extends_joins_and_misses(spark):
    batches = [
        # vehicles 1, 2 and 3 enter; vehicle 9 moves the clock to 100
        [report(70, 1, 52, 0), report(80, 1, 53, 5000), report(60, 2, 52, 0), report(75, 2, 53, 5000), report(20, 3, 52, 0), report(100, 9, 52, 0)],
        # 1: 95 is behind the clock but extends 80; 2: 50 joins nothing new, 90 extends; 3: its session closed at 51
        [report(95, 1, 56, 20000), report(45, 2, 52, -10), report(100, 2, 56, 21000), report(40, 3, 56, 20000), report(105, 9, 52, 0)],
        # 1: 130 opens a session of its own, 110 joins it to the open one; 3: 5 misses all
        [report(140, 1, 55, 27000), report(110, 1, 56, 25000), report(5, 3, 52, 0)],
        [report(400, 9, 53, 9000)],
    ]
    op = operator(spark)
    for i, rows in enumerate(batches):
        op(frame(spark, rows), i)
    op.finish()
    dropped = sorted((r.vid, r.time, r.arrived) for r in op.late().collect())
    assert dropped == [(3, 5, 2), (3, 40, 1)]
    got = {r.vid: (r.time1, r.time2, r.avg_speed) for r in op.crossings().collect()}
    speed = lambda metres, n: metres / ((n - 1) * 30.0) * 2.23694
    # vehicle 1: five reports of one session, entry at 70, exit at 110 (140 is on segment 55)
    assert got == {1: (70, 110, pytest.approx(speed(25000, 5))), 2: (45, 100, pytest.approx(speed(21010, 4)))}


def brute(batches, gap=31):
    """Batch by batch over plain rows: merge, judge, fold in order of arrival."""
    clock, held, out, dropped = None, [], [], []

    def close(session):
        first, last = model.fold(sorted(session, key=lambda r: (r["arrived"], r["seq"])))
        if {first["seg"], last["seg"]} == {52, 56}:
            avg = (abs(first["pos"] - last["pos"]) / ((len(session) - 1) * 30.0)) * 2.23694
            if avg > 60:
                out.append((first["time"], last["time"], first["vid"], first["xway"], first["dir"], avg))

    for i, batch in enumerate(batches):
        rows = held + [{**r, "arrived": i} for r in batch if 52 <= r["seg"] <= 56]
        before, held = clock, []
        clock = max([r["time"] for r in rows] + ([clock] if clock is not None else []), default=None)
        for _, session in model.sessions(rows, gap):
            end = session[-1]["time"] + gap
            if before is not None and end <= before:
                dropped += [(r["vid"], r["time"], r["seq"], r["arrived"]) for r in session]
            elif end <= clock:
                close(session)
            else:
                held += session
    for _, session in model.sessions(held, gap) if held else ():
        close(session)
    return sorted(out), sorted(dropped)


@pytest.mark.parametrize("policy", [NO_SPLIT, SPLIT_ALL], ids=["plain", "split"])
@pytest.mark.parametrize("seed", [1, 2])
def test_random_batches_with_a_rerun(spark, seed, policy):
    rnd = random.Random(seed)
    rows = []
    for vid in range(3):
        t = 0
        for _ in range(60):
            t += rnd.choice([5, 20, 31, 32, 60, 60])
            rows.append(report(t, vid, rnd.choice([51, 52, 52, 54, 56, 56]), rnd.randint(0, 40000), rnd.choice([0, 0, 0, 1])))
    rows.sort()
    names = ("time", "vid", "speed", "xway", "lane", "dir", "seg", "pos")
    seen = [{"seq": i, **dict(zip(names, r))} for i, r in enumerate(rows)]
    batches = [[], [], [], []]
    for r in seen:
        batches[min(3, r["time"] // 500 + (rnd.random() < 0.3))].append(r)
    want, dropped = brute(batches)
    assert want and dropped
    op = operator(spark, policy)
    for i, batch in enumerate(batches):
        df = spark.createDataFrame([tuple(r[c] for c in ("seq", *names)) for r in batch], frame(spark, rows[:1]).schema)
        op(df, i)
        if i == 2:
            op(df, i)  # a batch run again after a failure
    op.finish()
    assert collect(op.crossings()) == want
    assert collect(op.late().select("vid", "time", "seq", "arrived")) == dropped


def test_empty(spark):
    op = operator(spark, SkewPolicy())
    op.finish()
    assert op.crossings().count() == 0 and op.late().count() == 0
    op(frame(spark, [report(1, 1, 50, 0)]).where("false"), 0)
    op.finish()
    assert op.crossings().count() == 0 and op.late().count() == 0
