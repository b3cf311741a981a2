"""Schemas of the position report and of the three outputs."""

from __future__ import annotations

from pyspark.sql import types as T

# Input field order of a position report line (fixed: the reference's tuple order).
REPORT_FIELDS = ("time", "vid", "speed", "xway", "lane", "dir", "seg", "pos")

REPORT_SCHEMA = T.StructType(
    [
        T.StructField("time", T.IntegerType(), False),
        T.StructField("vid", T.LongType(), False),
        T.StructField("speed", T.IntegerType(), False),
        T.StructField("xway", T.IntegerType(), False),
        T.StructField("lane", T.IntegerType(), False),
        T.StructField("dir", T.IntegerType(), False),
        T.StructField("seg", T.IntegerType(), False),
        T.StructField("pos", T.IntegerType(), False),
    ]
)

# `seq` (arrival order, BIGINT) is added by every reader; it breaks ties of `time` and never
# appears in an output.
SEQ = "seq"
ORDER = ("time", SEQ)
ARRIVAL = (SEQ,)  # strict arrival order

SPEED_RADAR_COLS = ("time", "vid", "xway", "seg", "dir", "max_speed")
SPEED_CONTROL_COLS = ("time1", "time2", "vid", "xway", "dir", "avg_speed")
ACCIDENT_COLS = ("time1", "time2", "vid", "xway", "seg", "dir", "pos")
