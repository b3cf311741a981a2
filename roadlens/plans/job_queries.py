"""The whole job as registered queries: text written from ``events``, run, CSV read back."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from roadlens.plans.jobs import run_all, stream_all
from roadlens.session import checkpoint_root
from roadlens.sources.events_view import load_reports
from roadlens.sources.reports import reports_to_lines

# columns of the header-less outputs
CSV_SCHEMAS = {
    "SpeedRadar.csv": "time INT, vid BIGINT, xway INT, seg INT, dir INT, max_speed INT",
    "AverageSpeedControl.csv": "time1 INT, time2 INT, vid BIGINT, xway INT, dir INT, avg_speed DOUBLE",
    "AccidentReporter.csv": "time1 INT, time2 INT, vid BIGINT, xway INT, seg INT, dir INT, pos INT",
}


def _text(spark: SparkSession, sf_dir: str) -> str:
    """The reports of view A as text files in arrival order; returns the run's folder."""
    base = f"{checkpoint_root(spark)}/roadlens-job/{uuid.uuid4().hex}"
    lines = reports_to_lines(load_reports(spark, sf_dir)).orderBy("seq").select("value")
    lines.write.text(f"{base}/in")
    return base


def job_query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    """The batch job's output ``name``."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        base = _text(spark, sf_dir)
        out = run_all(spark, f"{base}/in", f"{base}/out", outputs=(name,))
        return spark.read.schema(CSV_SCHEMAS[name]).csv(out[name])

    return query


def stream_job_query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    """The streaming job's output ``name`` once its input has ended. The files were written in
    parallel and did not arrive in time order, so they are one micro-batch."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        base = _text(spark, sf_dir)
        for q in stream_all(spark, f"{base}/in", f"{base}/out", files_per_trigger=None, end_of_input=True):
            q.awaitTermination()
        return spark.read.schema(CSV_SCHEMAS[name]).csv(f"{base}/out/{name}")

    return query
