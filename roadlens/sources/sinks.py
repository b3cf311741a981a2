"""CSV sinks (SNK-1..3): comma separated, no header, refuse an existing target."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from roadlens.sources.folders import delete, exists, rename

MANIFEST = "_commit"


def write_csv(df: DataFrame, path: str, mode: str = "error") -> None:
    """Write ``df`` as header-less CSV part files under the folder ``path``.

    ``mode="error"`` refuses an existing target like the reference's sink. Numbers are
    written unquoted; doubles use Spark's shortest round-trip text.
    """
    df.write.mode(mode).option("header", False).option("quoteAll", False).csv(path)


def finish_commit(spark: SparkSession, prefix: str) -> bool:
    """Complete a commit that was interrupted after its manifest stood; True if there was one.

    The manifest lists ``staged folder, target`` pairs. A pair whose staged folder is gone was
    moved before the interruption.
    """
    manifest = f"{prefix}/{MANIFEST}"
    if not exists(spark, manifest):
        return False
    moves = sorted((r.source, r.target) for r in spark.read.json(manifest, "source string, target string").collect())
    for source, target in moves:
        if exists(spark, source):
            rename(spark, source, target)
    delete(spark, manifest)
    return True


def write_all(spark: SparkSession, plans: dict[str, Callable[[], DataFrame]], prefix: str) -> dict[str, str]:
    """Write the outputs ``plans`` (name -> plan) under ``prefix`` as one commit; returns their paths.

    Every output is written to a staging folder beside the targets first. Only when all of them
    stand, a manifest names the moves, and the folders are renamed. So a failure in any plan leaves no
    target behind (a rerun is not refused), and one between the renames is completed by the next call
    (``finish_commit``), which then refuses its own targets like any existing ones.
    """
    prefix = prefix.rstrip("/")
    finish_commit(spark, prefix)
    out = {name: f"{prefix}/{name}" for name in plans}
    for path in out.values():
        if exists(spark, path):
            raise FileExistsError(path)
    staging = f"{prefix}/_staging-{uuid.uuid4().hex}"
    try:
        for name, plan in plans.items():
            write_csv(plan(), f"{staging}/{name}")
        moves = [(f"{staging}/{name}", path) for name, path in out.items()]
        spark.createDataFrame(moves, "source string, target string").coalesce(1).write.json(f"{staging}/{MANIFEST}")
        rename(spark, f"{staging}/{MANIFEST}", f"{prefix}/{MANIFEST}")  # from here on the commit stands
    except BaseException:
        if not exists(spark, f"{prefix}/{MANIFEST}"):
            delete(spark, staging)
        raise
    finish_commit(spark, prefix)
    delete(spark, staging)
    return out
