"""Streaming operators whose micro-batches run the batch plans, with a carry from batch to batch.

A vehicle may hold a third of all rows of a micro-batch. A stateful function would get them as one group
in one task; here ``foreachBatch`` hands the micro-batch over, the rows that earlier ones left for each
vehicle (the *carry*: O(1) rows a vehicle) are put before its new reports, and the batch operators run
over both, with their split of hot vehicles into blocks. The operators:

* ``radar_step``         -- Q1; carry: the first speeding report with the largest speed so far
* ``count_window_step``  -- count windows (``size``, ``slide``); carry: the last ``size - 1`` reports and the
  number of reports so far, so the ordinal at which a window fires goes on
* ``accident_step``      -- Q3 as the count window (4, 1) whose reports share one position
* ``backward_step``      -- reports whose ``time`` steps back behind an earlier one; carry: the largest ``time``

Reports of a micro-batch are ordered by (time, seq) (``backward_step``: by ``seq``), micro-batches by arrival.

Every batch writes its output and then its carry to folders named by its id. Ids are consecutive, so a
batch that is run again after a failure reads the carry of the one before it and overwrites what it had
left. A carry is removed when the next but one is being written: nothing can read it any more.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.config import DEFAULT_SKEW, SPEED_LIMIT, STOP_REPORTS, SkewPolicy
from roadlens.functions.predicates import speeding
from roadlens.operators.stopped import FIRING, stops
from roadlens.plans.blocks import running, trailing
from roadlens.schema import ACCIDENT_COLS, SPEED_RADAR_COLS
from roadlens.sources.folders import delete

EARLIER = -(2**40)  # `_at` of carried rows: before every `time`
PLACED = ("_at", "_place")  # their order: carried rows, then new ones by (time, seq)
NEW = f"_at > {EARLIER}"

# (new reports, carry) -> (output, next carry)
Step = Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame]]


class Carried:
    """Call it with each micro-batch (``foreachBatch``); carries and results lie in ``folder``."""

    def __init__(self, spark: SparkSession, folder: str, step: Step, carry: str, output: str):
        self.spark, self.folder, self.step = spark, folder.rstrip("/"), step
        self.carry_schema, self.output_schema = carry, output

    def _carry(self, batch: int) -> DataFrame:
        if batch < 0:
            return self.spark.createDataFrame([], self.carry_schema)
        return self.spark.read.schema(self.carry_schema).parquet(f"{self.folder}/carry/{batch}")

    def __call__(self, reports: DataFrame, batch: int) -> None:
        rows = reports.persist()  # read by the check for hot vehicles, the output and the carry
        try:
            output, carry = self.step(rows, self._carry(batch - 1))
            output.write.mode("overwrite").parquet(f"{self.folder}/output/batch={batch}")
            carry.write.mode("overwrite").parquet(f"{self.folder}/carry/{batch}")
        finally:
            rows.unpersist()
        if batch > 1:
            delete(self.spark, f"{self.folder}/carry/{batch - 2}")

    def results(self) -> DataFrame:
        """All output so far, with the micro-batch (``batch``) that it came from."""
        return self.spark.read.schema(f"{self.output_schema}, batch int").parquet(f"{self.folder}/output")


def stream_carried(reports: DataFrame, operator: Carried, checkpoint: str):
    """A started query that hands the files of the streaming ``reports`` to ``operator`` and ends."""
    writer = reports.writeStream.foreachBatch(operator).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


RADAR_CARRY = "vid long, time int, speed int, xway int, seg int, dir int"
RADAR_OUT = "time int, vid long, xway int, seg int, dir int, max_speed int"


def radar_step(limit: int = SPEED_LIMIT, policy: SkewPolicy = DEFAULT_SKEW) -> Step:
    frozen = "struct(time, xway, seg, dir)"

    def step(reports: DataFrame, carry: DataFrame) -> tuple[DataFrame, DataFrame]:
        cols = ("vid", "time", "speed", "xway", "seg", "dir")
        new = speeding(reports, limit).selectExpr(*cols, "CAST(time AS BIGINT) AS _at", "seq AS _place")
        both = new.unionByName(carry.selectExpr(*cols, f"{EARLIER}L AS _at", "0L AS _place"))
        aggs = {"max_speed": ("max", "speed"), "_first": ("first", frozen)}
        rolled = running(both, ["vid"], PLACED, aggs, policy=policy).where(NEW)
        output = rolled.selectExpr("vid", "_first.*", "max_speed").select(*SPEED_RADAR_COLS)
        ends = both.groupBy("vid").agg(
            F.expr(f"min_by({frozen}, struct(_at, _place)) AS _first"), F.expr("max(speed) AS speed")
        )
        return output, ends.selectExpr("vid", "_first.time", "speed", "_first.xway", "_first.seg", "_first.dir")

    return step


_HELD = ("time", "xway", "seg", "dir", "pos")
COUNT_CARRY = "vid long, seen long, held array<struct<time int, xway int, seg int, dir int, pos int>>"
FIRING_OUT = "vid long, time1 int, time2 int, n long, pos1 int, pos2 int"
ACCIDENT_OUT = "time1 int, time2 int, vid long, xway int, seg int, dir int, pos int"


def _count_windows(size: int, slide: int, policy: SkewPolicy) -> Step:
    """The windows that fire, with the columns of ``count_window``, and the carry."""
    if size < 1 or slide < 1:
        raise ValueError("size and slide must be >= 1")
    hold = max(1, size - 1)  # one row at least: it brings the number of reports so far

    def step(reports: DataFrame, carry: DataFrame) -> tuple[DataFrame, DataFrame]:
        new = reports.selectExpr("vid", *_HELD, "CAST(time AS BIGINT) AS _at", "seq AS _place", "1L AS _weight")
        old = carry.selectExpr("vid", "seen - size(held) AS _before", "posexplode(held) AS (_i, _r)").selectExpr(
            "vid", "_r.*", f"{EARLIER}L AS _at", "CAST(_i AS BIGINT) AS _place",
            "CASE WHEN _i = 0 THEN _before + 1 ELSE 1L END AS _weight",
        )
        row = f"struct({', '.join(_HELD)})"
        exprs = {
            "_n": "count(1)",
            "_first": f"first({row})",
            "_min_pos": "min(pos)",
            "_max_pos": "max(pos)",
            "_rows": f"collect_list({row})",  # at most `size` of them
        }
        framed = trailing(new.unionByName(old), ["vid"], PLACED, size - 1, exprs, policy=policy)
        counted = running(framed, ["vid"], PLACED, {"_seen": ("sum", "_weight")}, policy=policy)
        fired = counted.where(f"{NEW} AND _seen % {slide} = 0")
        last = counted.groupBy("vid").agg(
            F.expr("max(_seen) AS seen"),
            F.expr(f"max_by(slice(_rows, -least({hold}, size(_rows)), {hold}), _seen) AS held"),
        )
        return fired, last

    return step


def count_window_step(size: int = STOP_REPORTS, slide: int = 1, policy: SkewPolicy = DEFAULT_SKEW) -> Step:
    windows = _count_windows(size, slide, policy)

    def step(reports: DataFrame, carry: DataFrame) -> tuple[DataFrame, DataFrame]:
        fired, last = windows(reports, carry)
        return fired.selectExpr(*FIRING), last

    return step


def accident_step(size: int = STOP_REPORTS, policy: SkewPolicy = DEFAULT_SKEW) -> Step:
    windows = _count_windows(size, 1, policy)

    def step(reports: DataFrame, carry: DataFrame) -> tuple[DataFrame, DataFrame]:
        fired, last = windows(reports, carry)
        return stops(fired, size).select(*ACCIDENT_COLS), last

    return step


BACKWARD_CARRY = "time int"
BACKWARD_OUT = "steps_back long, reports long"


def backward_step(policy: SkewPolicy = DEFAULT_SKEW) -> Step:
    """One row per micro-batch: the reports in it, and those whose ``time`` lies before that of an earlier one
    (by ``seq``, or in an earlier micro-batch), which an ascending clock would report.

    All reports are one ordered sequence, so they are one key, which the policy's split cuts into
    blocks like a hot vehicle; with ``policy`` switched off one task would hold the micro-batch.
    """

    def step(reports: DataFrame, carry: DataFrame) -> tuple[DataFrame, DataFrame]:
        new = reports.selectExpr("0 AS _all", "time", "seq")
        so_far = running(new, ["_all"], ["seq"], {"_latest": ("max", "time")}, policy=policy)
        before = F.lit(carry.agg(F.max("time")).first()[0]).cast("int")  # one number
        judged = so_far.select((F.col("time") < F.greatest("_latest", before)).alias("_back"))
        output = judged.selectExpr("count_if(_back) AS steps_back", "count(1) AS reports")
        return output, new.select("time").union(carry.select("time")).selectExpr("max(time) AS time")

    return step
