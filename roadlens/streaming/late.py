"""Q2 on a stream whose late reports are judged by the session they join (TIM-3).

A report behind the watermark is not late by itself: it first joins the open sessions that it
touches (at most a gap away), and only if the merged session still ends behind the watermark it is
dropped. So a late report can extend an open session, or join two of them to one. Spark's own
watermark drops rows one by one before any operator sees them, so it stays out of the way
here: ``foreachBatch`` hands over whole micro-batches, and the operator keeps its own clock, the
largest ``time`` on the stretch so far.

A micro-batch is merged as a whole, with the reports of open sessions that earlier ones left. Then
sessions are ``late`` (ending behind the clock before this batch: all of their reports are new and
are kept as dropped rows), ``closed`` (ending behind the clock now: folded and written) or ``open``. The
merge is the batch sessioniser, so a hot vehicle is split over tasks; a session's reports are folded in
order of arrival (micro-batch, then ``seq``), as a window hands them over.

Every batch writes its own folders, named by its id, and its clock last; a batch that is run again after a
failure overwrites what it had left, and reads the last clock before it. Folders of open sessions that
no later batch needs are not read again. ``finish`` closes what is open at the end of the input.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.config import DEFAULT_SKEW, Params, SkewPolicy
from roadlens.functions.predicates import in_stretch
from roadlens.operators.sessions import sessionize_split
from roadlens.operators.speed_control import crossings, endpoints_split
from roadlens.schema import SPEED_CONTROL_COLS

ROW = "vid long, time int, seq long, xway int, dir int, seg int, pos int, arrived long"
OUT = "time1 int, time2 int, vid long, xway int, dir int, avg_speed double"
COLS = tuple(c.split()[0] for c in ROW.split(", "))
END = 2**31 - 1  # the batch number of what ``finish`` writes


class LateSpeedControl:
    """Call it with each micro-batch of reports (``foreachBatch``); state and results lie in ``folder``."""

    def __init__(self, spark: SparkSession, folder: str, params: Params = Params(), policy: SkewPolicy = DEFAULT_SKEW):
        self.spark, self.folder, self.params, self.policy = spark, folder.rstrip("/"), params, policy
        self._write(spark.createDataFrame([(None,)], "time int"), "clock", -1, "ignore")

    def _write(self, df: DataFrame, what: str, batch: int, mode: str = "overwrite", *by: str) -> None:
        df.write.mode(mode).partitionBy(*by).parquet(f"{self.folder}/{what}/batch={batch}")

    def _clock(self, batch: int) -> tuple[int, int | None]:
        """The last batch before ``batch`` that was done, and the clock after it."""
        clocks = self.spark.read.schema("time int, batch int").parquet(f"{self.folder}/clock")
        last = clocks.where(F.col("batch") < batch).orderBy(F.desc("batch")).first()
        return last["batch"], last["time"]

    def _sessions(self, batch: int, status: str) -> DataFrame:
        rows = self.spark.read.schema(f"{ROW}, session_start int, status string").parquet(f"{self.folder}/sessions/batch={batch}")
        return rows.where(F.col("status") == status).drop("status")

    def _close(self, rows: DataFrame, batch: int, policy: SkewPolicy) -> None:
        p = self.params
        ends = endpoints_split(rows, p.lo_seg, p.hi_seg, policy=policy, order=("arrived", "seq"))
        fast = crossings(ends, p).where(F.col("avg_speed") > float(p.avg_limit))
        self._write(fast.select(*SPEED_CONTROL_COLS), "crossings", batch)

    def __call__(self, reports: DataFrame, batch: int) -> None:
        done, before = self._clock(batch)
        new = in_stretch(reports, self.params.lo_seg, self.params.hi_seg)
        new = new.withColumn("arrived", F.lit(batch).cast("long")).select(*COLS).persist()
        try:
            now = new.agg(F.max("time")).first()[0]
            now = max((t for t in (before, now) if t is not None), default=None)
            rows = new if done < 0 else new.unionByName(self._sessions(done, "open").select(*COLS))
            gap = self.params.gap_units
            merged, split = sessionize_split(rows, gap, ["vid"], policy=self.policy)
            ends = merged.groupBy("vid", "session_start").agg((F.max("time").cast("long") + gap).alias("_end"))
            behind = lambda t: F.col("_end") <= F.lit(t).cast("long")
            status = F.when(behind(before), "late").when(behind(now), "closed").otherwise("open")
            marked = merged.join(ends, ["vid", "session_start"]).withColumn("status", status).drop("_end")
            self._write(marked, "sessions", batch, "overwrite", "status")
        finally:
            new.unpersist()
        self._close(self._sessions(batch, "closed"), batch, self.policy if split else replace(self.policy, enabled=False))
        self._write(self.spark.createDataFrame([(now,)], "time int"), "clock", batch)

    def finish(self) -> None:
        """The end of the input: all open sessions close."""
        done, _ = self._clock(END)
        if done >= 0:
            self._close(self._sessions(done, "open"), END, self.policy)

    def crossings(self) -> DataFrame:
        """All results so far."""
        return self._all("crossings", OUT, ())

    def late(self) -> DataFrame:
        """The reports that were dropped, with the micro-batch (``arrived``) they came in."""
        return self._all("sessions", f"{ROW}, status string", ("late",)).drop("status")

    def _all(self, what: str, schema: str, status: tuple[str, ...]) -> DataFrame:
        done, _ = self._clock(END)
        if done < 0:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(f"{schema}, batch int").parquet(f"{self.folder}/{what}").drop("batch")
        return rows.where(F.col("status").isin(*status)) if status else rows


def stream_late_speed_control(reports: DataFrame, operator: LateSpeedControl, checkpoint: str):
    """A started query that hands the files of the streaming ``reports`` to ``operator`` and ends."""
    writer = reports.writeStream.foreachBatch(operator).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
