from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from roadlens.config import SkewPolicy

ROW_SCHEMA = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("time", T.IntegerType()),
        T.StructField("vid", T.LongType()),
        T.StructField("speed", T.IntegerType()),
        T.StructField("xway", T.IntegerType()),
        T.StructField("lane", T.IntegerType()),
        T.StructField("dir", T.IntegerType()),
        T.StructField("seg", T.IntegerType()),
        T.StructField("pos", T.IntegerType()),
    ]
)
FIELDS = ("time", "vid", "speed", "xway", "lane", "dir", "seg", "pos")

# forces every vehicle with more than one report through the split (hot-key) plan
SPLIT_ALL = SkewPolicy(hot_rows=1, block_rows=2, max_blocks=64, max_hot_keys=10_000)
NO_SPLIT = SkewPolicy(enabled=False)
# hot keys found on a 25% sample; block layout from the sample, clamped
SAMPLED = SkewPolicy(hot_rows=40, block_rows=7, max_blocks=64, max_hot_keys=10_000, sample_rows=10)
POLICIES = {"default": SkewPolicy(), "split": SPLIT_ALL, "off": NO_SPLIT, "sampled": SAMPLED}


def frame(spark: SparkSession, tuples) -> DataFrame:
    """Reports from (time, vid, speed, xway, lane, dir, seg, pos) tuples; seq = list order."""
    rows = [(i, *t) for i, t in enumerate(tuples)]
    return spark.createDataFrame(rows, ROW_SCHEMA)


def dicts(tuples):
    return [dict(zip(("seq", *FIELDS), (i, *t))) for i, t in enumerate(tuples)]


def collect(df: DataFrame):
    return sorted(tuple(r) for r in df.collect())


def P(seg: int) -> int:
    return seg * 5280
