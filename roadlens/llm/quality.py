"""Quality classifier: histogram gradient-boosted trees over statistics of the whole text.

Statistics (``stats.NAMES``) are computed in Arrow batches. Trees are fitted on a bounded sample
of labelled rows (``SAMPLE`` rows of as many doc_ids at most, those with the smallest hashes),
which the driver holds as ``SAMPLE`` x statistics numbers; scoring streams all documents.

Labels are learned only from rows whose crc32(doc_id as text) mod 3 is not 1; labels, language,
source and doc_id are no inputs. Edge cases: null and empty texts have all statistics 0 and get
the score the trees give to those; null labels and labels of unknown documents teach nothing;
without labels, or with one label alone, all scores are one constant; rows equal in doc_id and
text teach once and are scored each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlens.llm.boosting import Trees, fit
from roadlens.llm.common import trimmed
from roadlens.llm.stats import NAMES, text_stats

SAMPLE = 20_000
LIMIT = 0.5
FOLDS, HELD = 3, 1


def held_out(doc_id: Column, folds: int, held: int) -> Column:
    """Whether a row is kept from learning (false for a null doc_id)."""
    return F.coalesce(F.pmod(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")), F.lit(folds)) == held, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame, label: str, folds: int, held: int, sample: int) -> DataFrame:
    """``text, y, row`` of labelled rows outside the held-out fold, of at most ``sample`` doc_ids, the same in every run.

    ``row`` is a hash of doc_id and text; a doc_id may have any number of rows, so whoever collects them bounds them by it.
    """
    known = labels.where(F.col(label).isin(0, 1) & ~held_out(labels["doc_id"], folds, held))
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.select(docs["doc_id"].alias("_id"), "text")
    rows = F.broadcast(chosen).join(texts, F.col("doc_id") == F.col("_id"))
    return rows.select("text", "y", F.xxhash64("doc_id", F.coalesce("text", F.lit(""))).alias("row"))


def _stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = list(text_stats(batch.column(0)))
        if x:
            flat = np.concatenate(x)
            offsets = pa.array(np.arange(len(flat) + 1, dtype=np.int32) * len(NAMES))
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(offsets, pa.array(flat.reshape(-1))), *batch.columns[1:]], names=["x", "y", "row"])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Trees:
    rows = labelled(docs, labels, "quality", FOLDS, HELD, sample).mapInArrow(trimmed(_stats), "x array<double>, y int, row long")
    rows = rows.dropDuplicates(["row"]).orderBy("row").limit(sample).toArrow()
    x = rows["x"].combine_chunks().flatten().to_numpy().reshape(-1, len(NAMES)) if len(rows) else np.zeros((0, len(NAMES)))
    y = rows["y"].to_numpy().astype(float)
    order = np.lexsort((*x.T, y))  # the order in which rows arrive must not matter
    return fit(x[order], y[order])


def _scorer(shared, limit: float | None):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = [shared.value.probability(x) for x in text_stats(batch.column(1))]
            if p:
                p = np.concatenate(p)
                out = [batch.column(0), pa.array(p), *([batch.column(1)] if limit is not None else [])]
                out = pa.RecordBatch.from_arrays(out, names=["_doc", "score", "_text"][: len(out)])
                yield out if limit is None else out.filter(pa.array(p >= limit))

    return score


def score(docs: DataFrame, model: Trees, keep: list[str], limit: float | None = None) -> DataFrame:
    """Columns ``keep`` of ``docs`` as a struct ``_doc``, and ``score``; with a limit only rows from it on, and their ``_text``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.struct(*[docs[c] for c in keep]).alias("_doc"), docs["text"].alias("_text"))
    schema = T.StructType([rows.schema["_doc"]]).add("score", "double")
    return rows.mapInArrow(trimmed(_scorer(shared, limit)), schema if limit is None else schema.add(rows.schema["_text"]))


def filter_quality(docs: DataFrame, labels: DataFrame, limit: float = LIMIT) -> DataFrame:
    """The rows of ``docs`` that score at least ``limit``; a text passes through the worker once."""
    others = [c for c in docs.columns if c != "text"]
    good = score(docs, train(docs, labels), others, limit)
    return good.select(*[F.col("_text").alias("text") if c == "text" else F.col("_doc")[c].alias(c) for c in docs.columns])


def op9_quality_classifier(docs: DataFrame, labels: DataFrame) -> DataFrame:
    out = score(docs, train(docs, labels), ["doc_id"]).select("_doc.doc_id", "score")
    return out.select("doc_id", held_out(F.col("doc_id"), FOLDS, HELD).alias("held_out"), "score", (F.col("score") >= LIMIT).cast("int").alias("predicted"))
