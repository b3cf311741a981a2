"""The one-run job: read position reports once, write the three CSV outputs (§3).

``run_all`` is the batch form. The text input is parsed once and staged as parquet under
the session's checkpoint folder (``spark.checkpoint.dir``); each query then scans only the
columns it needs, and the staged table cuts the lineage (a lost executor recomputes from
the staged files, not from the text). ``stream_all`` is the Structured Streaming form: one
file stream of text reports, three streaming queries, CSV sinks with checkpoints.

Command line (SRC-2)::

    python -m roadlens.cli <input path> <output prefix> [--stream] [--seconds]
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.config import DEFAULT_SKEW, Params, SkewPolicy
from roadlens.operators.speed_control import average_speed_control
from roadlens.plans.blocks import checked_policy
from roadlens.operators.speed_radar import speed_radar
from roadlens.operators.stopped import accident_reporter
from roadlens.schema import ORDER, REPORT_FIELDS
from roadlens.session import checkpoint_root
from roadlens.sources.folders import delete
from roadlens.sources.reports import lines_to_reports, read_reports
from roadlens.sources.sinks import write_all

OUTPUTS = ("SpeedRadar.csv", "AverageSpeedControl.csv", "AccidentReporter.csv")


def stage_reports(spark: SparkSession, reports: DataFrame, folder: str | None = None) -> DataFrame:
    """Write parsed reports as parquet in ``folder`` (a fresh one of the checkpoint dir); read back."""
    folder = folder or f"{checkpoint_root(spark)}/roadlens-staged/{uuid.uuid4().hex}"
    reports.select("seq", *REPORT_FIELDS).write.parquet(folder)
    return spark.read.parquet(folder)


def run_all(
    spark: SparkSession,
    in_path: str,
    out_prefix: str,
    params: Params = Params(),
    parser: str = "strict",
    stage: bool = True,
    policy: SkewPolicy = DEFAULT_SKEW,
    outputs: tuple[str, ...] = OUTPUTS,
    order: tuple[str, ...] = ORDER,
) -> dict[str, str]:
    """Batch job: the three queries (or those of ``outputs``) over the reports at ``in_path``;
    returns output paths. ``order=ARRIVAL`` makes the speed radar and the accident reporter take
    reports as they arrived; sessions are by ``time`` in any case. The outputs are one commit
    (``sinks.write_all``): a failure leaves none of them behind. The staged copy is removed at the end."""
    reports = read_reports(spark, in_path, parser=parser)
    staged = f"{checkpoint_root(spark)}/roadlens-staged/{uuid.uuid4().hex}"
    try:
        if stage and parser != "parquet":  # a parquet input is already a columnar table
            reports = stage_reports(spark, reports, staged)
        return _write_outputs(spark, reports, out_prefix, params, policy, outputs, order)
    finally:
        delete(spark, staged)


def _write_outputs(spark, reports, out_prefix, params, policy, outputs, order) -> dict[str, str]:
    policy = checked_policy(reports, ["vid"], "time", policy)  # one check for all three queries
    plans = {
        "SpeedRadar.csv": lambda: speed_radar(reports, params.speed_limit, policy=policy, order=order),
        "AverageSpeedControl.csv": lambda: average_speed_control(reports, params, policy=policy),
        "AccidentReporter.csv": lambda: accident_reporter(reports, params.stop_reports, policy=policy, order=order),
    }
    return write_all(spark, {name: plans[name] for name in outputs}, out_prefix)


END_TIME = 2**31 - 1  # largest `time` a report can have


def stream_all(
    spark: SparkSession,
    in_dir: str,
    out_prefix: str,
    params: Params = Params(),
    files_per_trigger: int | None = 1,
    available_now: bool = True,
    end_of_input: bool = False,
    checkpoint: str | None = None,
):
    """Streaming job over a folder of text report files; returns the three started queries.

    Files should arrive in time order: one file's reports make the earlier ones of the next
    late. ``files_per_trigger=None`` takes all that have arrived as one micro-batch.

    The checkpoints lie beside the sinks (``checkpoint``, by default a folder under
    ``out_prefix``): a further call with the same prefix resumes, reads new files only and keeps
    the open sessions. ``end_of_input`` (with ``available_now``) says that the input is complete:
    after the drain the open sessions of the speed control are closed too, as at the end of a
    bounded input. A report of the largest ``time``, in a private second source, moves the
    watermark past them; it stays in an open session itself. Reports after that would be
    late, so a call on an ended prefix is refused.

    Streams refuse ``monotonically_increasing_id()``, so ``seq`` is the arrival time of the
    report's file (its modification time, in microseconds): reports of equal ``time`` are
    ordered by file arrival, and inside one file they keep their order in the micro-batch.
    """
    from roadlens.streaming.operators import (
        stream_accident_reporter,
        stream_average_speed_control,
        stream_speed_radar,
    )

    if end_of_input and not available_now:
        raise ValueError("end_of_input needs available_now")
    prefix = out_prefix.rstrip("/")
    ckpt = (checkpoint or f"{prefix}/_checkpoints").rstrip("/")
    ending = f"{ckpt}/end-of-input"
    # a text source needs its folder: an empty file until the input ends
    spark.range(0).selectExpr("'' AS value").write.mode("ignore").text(ending)
    if not spark.read.text(ending).isEmpty():
        raise RuntimeError(f"the input of {prefix} was ended; start a new output prefix")

    def lines(folder: str) -> DataFrame:
        source = spark.readStream.schema("value string")
        if files_per_trigger is not None:
            source = source.option("maxFilesPerTrigger", files_per_trigger)
        seq = F.unix_micros(F.col("_metadata.file_modification_time")).alias("seq")
        return source.text(folder).select(seq, "value")

    def start(name: str):
        if name == "SpeedRadar.csv":
            df = stream_speed_radar(lines_to_reports(lines(in_dir)), params.speed_limit)
        elif name == "AverageSpeedControl.csv":
            both = lines(in_dir).unionByName(lines(ending))
            df = stream_average_speed_control(lines_to_reports(both), params)
        else:
            df = stream_accident_reporter(lines_to_reports(lines(in_dir)), params.stop_reports)
        writer = (
            df.writeStream.format("csv")
            .option("header", False)
            .outputMode("append")
            .option("checkpointLocation", f"{ckpt}/{name}")
        )
        writer = writer.trigger(availableNow=True) if available_now else writer
        return writer.start(f"{prefix}/{name}")

    queries = {name: start(name) for name in OUTPUTS}
    if end_of_input:
        for query in queries.values():
            query.awaitTermination()
        last = f"{END_TIME},-1,0,0,0,0,{params.lo_seg},0"
        spark.range(1).select(F.lit(last).alias("value")).write.mode("append").text(ending)
        queries["AverageSpeedControl.csv"] = start("AverageSpeedControl.csv")
    return list(queries.values())


__all__ = ["OUTPUTS", "run_all", "stage_reports", "stream_all"]
