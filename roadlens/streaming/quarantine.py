"""The quarantine of bad lines on a stream (PARSE-1): one pass over the text, two sides.

Each micro-batch is parsed once and written once, partitioned by ``good``, to a folder named by its id, so a
batch that is run again overwrites what it had left. ``good()`` and ``bad()`` read the two sides back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roadlens.schema import REPORT_FIELDS, REPORT_SCHEMA
from roadlens.sources.reports import marked_lines

_FIELDS = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in REPORT_SCHEMA.fields)


class Quarantine:
    """Call it with each micro-batch of lines ``seq, value`` (``foreachBatch``)."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __call__(self, lines: DataFrame, batch: int) -> None:
        marked = marked_lines(lines.select("seq", "value"))
        marked.write.mode("overwrite").partitionBy("good").parquet(f"{self.folder}/batch={batch}")

    def lines(self) -> DataFrame:
        """Every line so far, with its report if it is good."""
        schema = f"seq long, line string, {_FIELDS}, batch int, good boolean"
        return self.spark.read.schema(schema).parquet(self.folder).drop("batch")

    def good(self) -> DataFrame:
        return self.lines().where("good").select("seq", *REPORT_FIELDS)

    def bad(self) -> DataFrame:
        return self.lines().where("NOT good").select("seq", "line")


def stream_quarantine(lines: DataFrame, quarantine: Quarantine, checkpoint: str):
    """A started query that hands the streaming ``lines`` to ``quarantine`` and ends."""
    writer = lines.writeStream.foreachBatch(quarantine).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
