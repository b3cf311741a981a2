"""The one-run jobs: text reports in, three CSV outputs out (batch and streaming)."""

import os
import tempfile

import pytest

from roadlens.config import Params
from roadlens.operators.speed_control import average_speed_control
from roadlens.operators.speed_radar import speed_radar
from roadlens.operators.stopped import accident_reporter
from roadlens.plans.job_queries import CSV_SCHEMAS
from roadlens.plans.jobs import run_all, stream_all
from roadlens.sources.events_view import load_reports
from roadlens.sources.reports import reports_to_lines
from tests.util import collect

def _text_input(spark, smoke_dir):
    reports = load_reports(spark, smoke_dir)
    folder = os.path.join(tempfile.mkdtemp(prefix="roadlens-test-"), "in")
    reports_to_lines(reports).orderBy("seq").coalesce(1).select("value").write.text(folder)
    return reports, folder


def _read(spark, path, name):
    return collect(spark.read.schema(CSV_SCHEMAS[name]).csv(path))


def test_run_all(spark, smoke_dir):
    reports, folder = _text_input(spark, smoke_dir)
    out = run_all(spark, folder, os.path.join(tempfile.mkdtemp(prefix="roadlens-test-"), "out"))
    assert _read(spark, out["SpeedRadar.csv"], "SpeedRadar.csv") == collect(speed_radar(reports))
    assert _read(spark, out["AccidentReporter.csv"], "AccidentReporter.csv") == collect(
        accident_reporter(reports)
    )
    got = _read(spark, out["AverageSpeedControl.csv"], "AverageSpeedControl.csv")
    assert got == collect(average_speed_control(reports, Params()))


def _same_as_batch(spark, prefix, reports):
    assert _read(spark, f"{prefix}/SpeedRadar.csv", "SpeedRadar.csv") == collect(speed_radar(reports))
    assert _read(spark, f"{prefix}/AccidentReporter.csv", "AccidentReporter.csv") == collect(
        accident_reporter(reports)
    )
    crossings = _read(spark, f"{prefix}/AverageSpeedControl.csv", "AverageSpeedControl.csv")
    assert crossings and crossings == collect(average_speed_control(reports, Params()))


def _stream(spark, folder, prefix, **options):
    for q in stream_all(spark, folder, prefix, **options):
        q.awaitTermination()


def test_stream_all(spark, smoke_dir):
    reports, folder = _text_input(spark, smoke_dir)
    prefix = os.path.join(tempfile.mkdtemp(prefix="roadlens-test-"), "out")
    _stream(spark, folder, prefix, end_of_input=True)
    _same_as_batch(spark, prefix, reports)


def test_stream_all_resumes(spark, smoke_dir):
    base = tempfile.mkdtemp(prefix="roadlens-test-")
    load_reports(spark, smoke_dir).write.parquet(f"{base}/view")  # a cached view would change other tests' plans
    reports = spark.read.parquet(f"{base}/view")
    half = int(reports.approxQuantile("time", [0.5], 0.0)[0])
    for part, options in ((f"time < {half}", {}), (f"time >= {half}", {"end_of_input": True})):
        lines = reports_to_lines(reports.where(part)).orderBy("seq").coalesce(1).select("value")
        lines.write.mode("append").text(f"{base}/in")
        _stream(spark, f"{base}/in", f"{base}/out", **options)
    _same_as_batch(spark, f"{base}/out", reports)
    with pytest.raises(RuntimeError):  # ended: nothing may come after the flush
        stream_all(spark, f"{base}/in", f"{base}/out")


def test_run_all_parquet_input(spark, smoke_dir):
    reports = load_reports(spark, smoke_dir)
    folder = os.path.join(tempfile.mkdtemp(prefix="roadlens-test-"), "reports.parquet")
    reports.write.parquet(folder)
    out = run_all(spark, folder, os.path.join(tempfile.mkdtemp(prefix="roadlens-test-"), "out"), parser="parquet")
    assert _read(spark, out["SpeedRadar.csv"], "SpeedRadar.csv") == collect(speed_radar(reports))
    assert _read(spark, out["AccidentReporter.csv"], "AccidentReporter.csv") == collect(accident_reporter(reports))
    got = _read(spark, out["AverageSpeedControl.csv"], "AverageSpeedControl.csv")
    assert got == collect(average_speed_control(reports, Params()))
