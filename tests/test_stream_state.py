"""The stateful streaming speed control, driven directly over random micro-batch splits."""

import random

import pandas as pd
import pytest

from roadlens.config import Params
from roadlens.streaming.speed_control import FIELDS, _step_factory
from tests import model
from tests.property_data import random_reports


class FakeState:
    """The GroupState calls the step function uses."""

    def __init__(self):
        self.value, self.timed_out, self.timeout, self.watermark = None, False, None, -1

    exists = property(lambda self: self.value is not None)
    get = property(lambda self: self.value)
    hasTimedOut = property(lambda self: self.timed_out)

    def update(self, v):
        self.value = tuple(v)

    def remove(self):
        self.value = None

    def setTimeoutTimestamp(self, ms):
        assert ms > self.watermark
        self.timeout = ms

    def getCurrentWatermarkMs(self):
        return self.watermark


def run_stream(rows, params, batches, seed):
    """Feed each vehicle's reports in ``batches`` arrival-ordered chunks, then time out."""
    step = _step_factory(params)
    rnd = random.Random(seed)
    out = []
    for vid in sorted({r["vid"] for r in rows}):
        mine = sorted((r for r in rows if r["vid"] == vid and 52 <= r["seg"] <= 56), key=lambda r: (r["time"], r["seq"]))
        if not mine:
            continue
        cuts = sorted(rnd.sample(range(1, len(mine)), min(batches - 1, len(mine) - 1))) if len(mine) > 1 else []
        state = FakeState()
        for a, b in zip([0, *cuts], [*cuts, len(mine)]):
            pdf = pd.DataFrame([{c: r[c] for c in FIELDS} for r in mine[a:b]])
            for res in step((vid,), iter([pdf]), state):
                out += [tuple(x) for x in res.itertuples(index=False)]
        if state.exists:
            state.timed_out = True
            for res in step((vid,), iter([]), state):
                out += [tuple(x) for x in res.itertuples(index=False)]
    return sorted(out)


@pytest.mark.parametrize("seed", [3, 17, 2024, 99])
@pytest.mark.parametrize("batches", [1, 3, 7])
def test_stateful_fold_equals_model(seed, batches):
    rows = [dict(zip(("seq", "time", "vid", "speed", "xway", "lane", "dir", "seg", "pos"), (i, *t)))
            for i, t in enumerate(random_reports(seed))]
    got = run_stream(rows, Params(time_unit="s"), batches, seed)
    want = model.stretch_crossings(rows, gap=31, limit=60)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert all(abs(g[5] - w[5]) < 1e-9 for g, w in zip(got, want))
