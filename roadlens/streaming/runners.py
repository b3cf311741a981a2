"""Run the streaming twins over a bounded, replayable file source.

The reports (derived by Spark from the given tables) are staged once as parquet under the
session's checkpoint folder (``spark.checkpoint.dir``). They are then replayed in time-ordered
chunks: the files of one chunk are appended to the source folder and the stream drains them
with ``trigger(availableNow=True)`` and no file limit, so a chunk is one micro-batch however
many files it has. All drains share one checkpoint; state and watermark carry over from chunk
to chunk as they do over a restart. Everything lives in a fresh sub-folder per run, so a
rerun never reads a previous run's files.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.config import DEFAULT_SKEW, Params, SkewPolicy
from roadlens.operators.stopped import stopped_sliding
from roadlens.session import checkpoint_root
from roadlens.sources.events_view import load_reports, mixed_reports, spoiled_lines
from roadlens.sources.reports import without_nulls
from roadlens.streaming import carried
from roadlens.streaming.late import LateSpeedControl, stream_late_speed_control
from roadlens.streaming.operators import (
    stream_accident_reporter,
    stream_average_speed_control,
    stream_speed_radar,
)
from roadlens.streaming.quarantine import Quarantine, stream_quarantine

REPORT_COLS = ("seq", "time", "vid", "speed", "xway", "lane", "dir", "seg", "pos")
INT_MAX = 2**31 - 1


def run_folder(spark: SparkSession, tag: str) -> str:
    return f"{checkpoint_root(spark)}/roadlens-stream/{tag}-{uuid.uuid4().hex}"


def stage_view(spark: SparkSession, reports: DataFrame, folder: str) -> DataFrame:
    """``reports`` written once, so that the chunks do not derive them again."""
    reports.select(*REPORT_COLS).write.parquet(folder)
    return spark.read.parquet(folder)


def time_chunks(reports: DataFrame, chunks: int) -> list[DataFrame]:
    """``reports`` cut at approximate quantiles of ``time`` (a handful of numbers reach the
    driver); reports of one ``time`` stay together, those without one are in the first chunk."""
    cuts = reports.approxQuantile("time", [i / chunks for i in range(1, chunks)], 0.001) if chunks > 1 else []
    bounds = [None, *sorted({int(c) for c in cuts}), None]
    time = F.col("time")
    out = []
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        above = time >= F.lit(lo) if lo is not None else F.lit(True)
        below = time < F.lit(hi) if hi is not None else F.lit(True)
        out.append(reports.where(above & below if lo is not None else time.isNull() | below))
    return out


def flush_report(spark: SparkSession, seg: int) -> DataFrame:
    """One far-future report on the stretch: it moves the watermark past every session.

    It adds no output: its own session and windows end after the watermark that it sets, so
    they stay open whatever its vehicle.
    """
    return spark.range(1).select(
        F.lit(INT_MAX).cast("bigint").alias("seq"),
        F.lit(INT_MAX).cast("int").alias("time"),
        F.lit(-1).cast("bigint").alias("vid"),
        *[F.lit(0).cast("int").alias(c) for c in ("speed", "xway", "lane", "dir")],
        F.lit(seg).cast("int").alias("seg"),
        F.lit(0).cast("int").alias("pos"),
    )


def drain(
    spark: SparkSession, source_folder: str, schema, transform: Callable[[DataFrame], DataFrame], out_folder: str
) -> None:
    """One run over the new files of ``source_folder``, all of them in one micro-batch."""
    stream = spark.readStream.schema(schema).parquet(source_folder)
    query = (
        transform(stream)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", f"{out_folder}/_checkpoint")
        .trigger(availableNow=True)
        .start(f"{out_folder}/data")
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def replay(
    spark: SparkSession,
    reports: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    tag: str,
    flush_seg: int | None = None,
    chunks: int = 3,
) -> DataFrame:
    """The output of ``transform`` over ``reports`` replayed as ``chunks`` micro-batches, and
    then the flush report if ``flush_seg`` is given."""
    base = run_folder(spark, tag)
    staged = stage_view(spark, reports, f"{base}/view")
    parts = time_chunks(staged, chunks)
    if flush_seg is not None:
        parts.append(flush_report(spark, flush_seg))
    for part in parts:
        part.write.mode("append").parquet(f"{base}/source")
        drain(spark, f"{base}/source", staged.schema, transform, f"{base}/out")
    return spark.read.parquet(f"{base}/out/data")


def stream_speed_radar_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay(spark, load_reports(spark, sf_dir), stream_speed_radar, "speed-radar")


def stream_accident_reporter_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay(spark, load_reports(spark, sf_dir), stream_accident_reporter, "accident")


def _speed_control(spark: SparkSession, reports: DataFrame, tag: str) -> DataFrame:
    params = Params()
    return replay(
        spark, reports, lambda s: stream_average_speed_control(s, params), tag, flush_seg=params.lo_seg
    )


def stream_average_speed_control_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _speed_control(spark, load_reports(spark, sf_dir), "speed-control")


def stream_average_speed_control_mixed_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """View C: sessions that only the row-by-row fold decides."""
    return _speed_control(spark, mixed_reports(load_reports(spark, sf_dir)), "speed-control-mixed")


def stream_accident_reporter_sliding_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-3 on a stream (view B, seconds): chained windowed aggregations, append mode."""
    return replay(
        spark,
        load_reports(spark, sf_dir, clock="cadence"),
        lambda s: stopped_sliding(s, time_unit="s", watermark="0 seconds"),
        "sliding",
        flush_seg=52,
    )


LATE_CHUNKS = 8


def arrival_chunk(chunks: int = LATE_CHUNKS) -> str:
    """SQL: the chunk in which a report of view B arrives -- one in 600 s of ``time``, and some reports one or two later."""
    return f"least({chunks - 1}, CAST(floor(time / 600) AS INT) + CASE WHEN seq % 8 = 3 THEN 1 WHEN seq % 16 = 5 THEN 2 ELSE 0 END)"


def late_run(spark: SparkSession, sf_dir: str) -> LateSpeedControl:
    """View B in chunks of arrival, of which some reports come late; each chunk is one micro-batch."""
    base = run_folder(spark, "late")
    staged = stage_view(spark, load_reports(spark, sf_dir, clock="cadence"), f"{base}/view")
    operator = LateSpeedControl(spark, f"{base}/state", Params(time_unit="s"))
    for chunk in range(LATE_CHUNKS):
        part = staged.where(f"{arrival_chunk()} = {chunk}")
        part.write.mode("append").parquet(f"{base}/source")
        query = stream_late_speed_control(spark.readStream.schema(staged.schema).parquet(f"{base}/source"), operator, f"{base}/checkpoint")
        query.awaitTermination()
    operator.finish()
    return operator


def stream_late_reports_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return late_run(spark, sf_dir).crossings()


def stream_late_dropped_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return late_run(spark, sf_dir).late().select("vid", "time", "seq", "arrived")


def carried_run(spark: SparkSession, staged: DataFrame, parts: list[DataFrame], step, carry: str, output: str, base: str) -> DataFrame:
    """The results of a carried operator over ``parts`` of ``staged``; each part is one micro-batch."""
    operator = carried.Carried(spark, f"{base}/state", step, carry, output)
    for part in parts:
        part.write.mode("append").parquet(f"{base}/source")
        stream = spark.readStream.schema(staged.schema).parquet(f"{base}/source")
        carried.stream_carried(stream, operator, f"{base}/checkpoint").awaitTermination()
    return operator.results()


def _in_time(step, carry: str, output: str) -> Callable[[SparkSession, str], DataFrame]:
    """View A in chunks of ``time`` through a carried operator."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        base = run_folder(spark, "carried")
        staged = stage_view(spark, load_reports(spark, sf_dir), f"{base}/view")
        return carried_run(spark, staged, time_chunks(staged, 3), step, carry, output, base).drop("batch")

    return query


def carried_radar_query(policy: SkewPolicy):
    return _in_time(carried.radar_step(policy=policy), carried.RADAR_CARRY, carried.RADAR_OUT)


def carried_accident_query(policy: SkewPolicy):
    return _in_time(carried.accident_step(policy=policy), carried.COUNT_CARRY, carried.ACCIDENT_OUT)


def carried_count_window_query(size: int, slide: int, policy: SkewPolicy = DEFAULT_SKEW):
    return _in_time(carried.count_window_step(size, slide, policy), carried.COUNT_CARRY, carried.FIRING_OUT)


def stream_steps_back_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """View B in chunks of arrival: per micro-batch, the reports behind an earlier one."""
    base = run_folder(spark, "steps-back")
    staged = stage_view(spark, load_reports(spark, sf_dir, clock="cadence"), f"{base}/view")
    parts = [staged.where(f"{arrival_chunk()} = {chunk}") for chunk in range(LATE_CHUNKS)]
    step = carried.backward_step()
    rows = carried_run(spark, staged, parts, step, carried.BACKWARD_CARRY, carried.BACKWARD_OUT, base)
    return rows.where("reports > 0")


def stream_parse_quarantine_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of view A, two thirds of them changed, in three micro-batches by arrival."""
    base = run_folder(spark, "quarantine")
    spoiled_lines(load_reports(spark, sf_dir)).write.parquet(f"{base}/view")
    staged = spark.read.parquet(f"{base}/view")
    quarantine = Quarantine(spark, f"{base}/out")
    for chunk in range(3):
        staged.where(f"seq % 3 = {chunk}").write.mode("append").parquet(f"{base}/source")
        stream = spark.readStream.schema(staged.schema).parquet(f"{base}/source")
        stream_quarantine(stream, quarantine, f"{base}/checkpoint").awaitTermination()
    return without_nulls(quarantine.lines())
