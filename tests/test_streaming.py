"""Stream = batch: the streaming twins over 3 micro-batches give the batch results."""

import pytest
from pyspark.sql import functions as F

from roadlens.config import Params
from roadlens.operators.speed_control import average_speed_control
from roadlens.operators.sessions import sessions
from roadlens.operators.speed_radar import speed_radar
from roadlens.operators.stopped import accident_reporter, stopped_sliding
from roadlens.functions.predicates import in_stretch
from roadlens.sources.events_view import load_reports, mixed_reports
from roadlens.streaming import runners
from roadlens.streaming.operators import (
    stream_accident_reporter,
    stream_average_speed_control,
    stream_speed_radar,
)
from tests.util import collect


def _run(spark, smoke_dir, transform, flush_seg=None, view=lambda r: r, clock="event"):
    reports = view(load_reports(spark, smoke_dir, clock=clock))
    return runners.replay(spark, reports, transform, "test", flush_seg), reports


@pytest.fixture
def many_files(spark):
    """Every chunk is several files."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, before)


def test_stream_speed_radar(spark, smoke_dir):
    out, reports = _run(spark, smoke_dir, stream_speed_radar)
    assert collect(out) == collect(speed_radar(reports))


def test_stream_accident_reporter(spark, smoke_dir, many_files):
    out, reports = _run(spark, smoke_dir, stream_accident_reporter)
    assert collect(out) == collect(accident_reporter(reports))


def test_stream_speed_control_with_flush(spark, smoke_dir, many_files):
    out, reports = _run(spark, smoke_dir, stream_average_speed_control, flush_seg=52)
    got = collect(out)
    assert got == collect(average_speed_control(reports, Params()))
    assert len(got) == 6


def test_stream_speed_control_mixed_sessions(spark, smoke_dir, many_files):
    out, reports = _run(spark, smoke_dir, stream_average_speed_control, flush_seg=52, view=mixed_reports)
    got = collect(out)
    assert got and got == collect(average_speed_control(reports, Params()))


def test_stream_speed_control_without_flush_emits_the_closed_sessions(spark, smoke_dir):
    out, reports = _run(spark, smoke_dir, stream_average_speed_control)
    params = Params()
    spans = sessions(in_stretch(reports), params).collect()
    newest = max(s["session_end"] for s in spans)
    still_open = {s["vid"]: s["session_start"] for s in spans if s["session_end"] + params.gap_units >= newest}
    batch = collect(average_speed_control(reports, params))
    closed = [r for r in batch if r[0] < still_open.get(r[2], newest + 1)]
    assert collect(out) == closed


def test_a_vehicle_numbered_like_the_flush_report(spark, smoke_dir):
    def view(reports):
        fast = average_speed_control(reports, Params()).first()["vid"]
        return reports.withColumn("vid", F.col("vid") - (fast + 1))

    out, reports = _run(spark, smoke_dir, stream_average_speed_control, flush_seg=52, view=view)
    got = collect(out)
    assert got == collect(average_speed_control(reports, Params()))
    assert any(r[2] == -1 for r in got)


def test_stream_sliding_window(spark, smoke_dir, many_files):
    out, reports = _run(
        spark, smoke_dir, lambda s: stopped_sliding(s, time_unit="s", watermark="0 seconds"),
        flush_seg=52, clock="cadence",
    )
    got = collect(out)
    assert got == collect(stopped_sliding(reports, time_unit="s"))
    assert len(got) == 93


def test_stream_speed_control_fast_path(spark, smoke_dir):
    out, reports = _run(
        spark, smoke_dir, lambda s: stream_average_speed_control(s, exact=False), flush_seg=52
    )
    assert collect(out) == collect(average_speed_control(reports, Params(), exact=False))
