"""Substring dedup: words covered by a window of words that also occurs earlier are removed.

Every run of ``WINDOW`` words inside a document has a Rabin-Karp hash (64 bits). Spark counts
equal windows and takes the earliest place of each, ``(doc_id, start)``; all other places are
repeats, and a document's repeated windows merge into maximal intervals of words to remove.

Windows that cannot repeat are left out of the count by an exact argument: a window's anchor
is its smallest ``GRAM``-word hash, so equal windows have equal anchors, at different places.
Anchors (about one word in seven) are counted first; the repeated ones are set in a bit table
of fixed size, which is broadcast. A window is counted when its anchor's bit is set. A full or
colliding table only lets more windows through: results never depend on it.

Window rows are shuffled once, by window, and ordered by place; all but the first are repeats.
A window whose anchor is among the most frequent ones is dealt into ``SALT`` parts first, and
the parts' first places meet again, so a passage that a third of all documents share does not
land in one task. The most frequent anchors are those with more than a ``HOT``-th of all
anchors, so at most ``HOT`` of them.

Edge cases: null and empty texts have no words; texts shorter than a window keep all; a null
doc_id counts as the smallest; equal rows are one document (both keep or lose the same words);
different texts under one doc_id are told apart by a hash of the text, and the smaller start,
then the smaller hash, comes first. Other columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql import types as T

from roadlens.llm.common import settle, text_blocks
from roadlens.llm.words import U, find_words, windows, word_hashes

WINDOW = 20
GRAM = 8
TABLE_BITS = 27  # 16 MB
SEGMENTS = 256
HOT = 100_000
SALT = 64
ANCHOR_BYTES = 40  # of text per anchor, about


def _sliding(values: np.ndarray, n: int, best: np.ufunc) -> np.ndarray:
    """``best`` over every ``n`` consecutive values."""
    out = values[: len(values) - n + 1].copy()
    for i in range(1, n):
        best(out, values[i : len(values) - n + 1 + i], out=out)
    return out


def _hashed(col: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    for first, end, data, offsets in text_blocks(col):
        s, e, bounds = find_words(data, offsets)
        yield first, end, word_hashes(data, s, e), bounds


def _anchored(hashes: np.ndarray, bounds: np.ndarray, size: int, gram: int):
    """Per window its start, hash, anchor; and the anchors of all places that are one."""
    whole, start = windows(hashes, bounds, size)
    grams, at = windows(hashes, bounds, gram)
    if not len(whole):
        return start, whole, whole, whole
    # a gram of another text would spoil a minimum: grams by word, missing ones as large as can be
    by_word = np.full(len(hashes), np.iinfo(np.uint64).max, U)
    by_word[at] = grams
    span = size - gram + 1
    low = _sliding(by_word, span, np.minimum)[start]
    # a place is an anchor if it is the minimum of some window over it
    best = np.zeros(len(hashes) + span - 1, U)
    best[start + span - 1] = low
    chosen = _sliding(best, span, np.maximum) == by_word
    chosen &= by_word != np.iinfo(np.uint64).max
    return start, whole, low, by_word[chosen]


def _anchors(size: int, gram: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, hashes, bounds in _hashed(batch.column(0)):
                chosen = _anchored(hashes, bounds, size, gram)[3]
                yield pa.RecordBatch.from_arrays([pa.array(chosen.view(np.int64))], names=["anchor"])

    return find


def _bit(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> U(64 - bits)).astype(np.int64)


def _segments(bits: int, segments: int, hot: float):
    """Bit rows of the table's segments, and anchors above ``hot``, from ``segment, anchor, n`` dealt by segment."""
    width = (1 << bits) // segments

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, np.ndarray] = {}
        often = []
        for batch in batches:
            anchors = batch.column(1).to_numpy().view(U)
            often.append(anchors[batch.column(2).to_numpy() > hot])
            at = _bit(anchors, bits)
            for segment in np.unique(at // width).tolist():
                part = parts.setdefault(segment, np.zeros(width // 8, np.uint8))
                here = at[at // width == segment] % width
                np.bitwise_or.at(part, here >> 3, (1 << (here & 7)).astype(np.uint8))
        if parts:
            rows = [*parts.items(), (-1, np.concatenate(often))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in rows], pa.int32()), pa.array([v.tobytes() for _, v in rows], pa.binary())], names=["segment", "part"]
            )

    return fill


def repeated_anchors(docs: DataFrame, size: int = WINDOW, gram: int = GRAM, bits: int = TABLE_BITS, most: int = HOT) -> tuple[np.ndarray, np.ndarray]:
    """The bit table of repeated anchors (``2**bits`` bits, whatever the input) and the most frequent ones, sorted."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    anchors = docs.select("text").mapInArrow(_anchors(size, gram), "anchor long")
    repeated = anchors.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1")
    # the table's leading bits name the segment, as _bit does
    segment = F.shiftrightunsigned("anchor", 64 - (SEGMENTS.bit_length() - 1)).cast("int")
    parts = repeated.select(segment.alias("segment"), "anchor", "n").repartition("segment")
    fill = _segments(bits, SEGMENTS, total / ANCHOR_BYTES / most)
    table = np.zeros((1 << bits) // 8, np.uint8).reshape(SEGMENTS, -1)
    hot = [np.zeros(0, U)]
    for row in parts.mapInArrow(fill, "segment int, part binary").collect():  # SEGMENTS rows of fixed size, and the few hot anchors
        if row["segment"] < 0:
            hot.append(np.frombuffer(row["part"], U))
        else:
            table[row["segment"]] |= np.frombuffer(row["part"], np.uint8)
    return table.reshape(-1), np.sort(np.concatenate(hot))


def _windows(size: int, gram: int, bits: int, shared, often: bool):
    """Rows ``h, doc_id, tag, at`` of the windows whose anchor's bit is set, of frequent anchors or of others."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, hot = shared.value
        for batch in batches:
            for first, end, hashes, bounds in _hashed(batch.column(2)):
                start, whole, low, _ = _anchored(hashes, bounds, size, gram)
                place = _bit(low, bits)
                some = (table[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
                some &= np.isin(low, hot) == often
                start, whole = start[some], whole[some]
                text = np.searchsorted(bounds, start, "right") - 1
                row = pa.array(first + text)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(whole.view(np.int64)),
                        batch.column(0).take(row),
                        batch.column(1).take(row),
                        pa.array((start - bounds[text]).astype(np.int32)),
                    ],
                    names=["h", "doc_id", "tag", "at"],
                )

    return find


def _tagged(docs: DataFrame) -> tuple[DataFrame, bool]:
    """``doc_id, tag, text``, and whether tags are needed: they tell texts of one doc_id apart (else all are 0)."""
    text = F.xxhash64(F.coalesce("text", F.lit("")))
    ids = docs.groupBy("doc_id").agg(F.min(text).alias("_a"), F.max(text).alias("_b"))
    tagged = not ids.where("_a <> _b").isEmpty()
    return docs.select("doc_id", (text if tagged else F.lit(0).cast("long")).alias("tag"), "text"), tagged


def repeated_windows(
    docs: DataFrame, tagged: bool, size: int = WINDOW, gram: int = GRAM, bits: int = TABLE_BITS, most: int = HOT
) -> DataFrame:
    """``doc_id, tag, starts`` (unsorted) of the documents that have windows starting earlier elsewhere.

    ``docs`` and ``tagged`` come from ``_tagged``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(repeated_anchors(docs, size, gram, bits, most))
    of = docs.schema["doc_id"].dataType.simpleString()

    def emitted(often: bool) -> DataFrame:
        rows = docs.mapInArrow(_windows(size, gram, bits, shared, often), f"h long, doc_id {of}, tag long, at int")
        # without shared ids the tag is 0 throughout, and need not be shuffled
        return rows if tagged else rows.select("h", "doc_id", "at")

    place = ["doc_id", "at", *["tag"] * tagged]
    later = F.struct(*place) != F.col("first")

    def first(*by: str):
        return F.first(F.struct(*place)).over(W.partitionBy(*by).orderBy(*place))

    found = emitted(False).withColumn("first", first("h")).where(later).select(*place)
    if len(shared.value[1]):
        parts = emitted(True).withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALT)).cast("int"))
        parts = settle(parts.withColumn("first", first("h", "salt")).select("h", *place, later.alias("later")))
        # a part's first place is a repeat if another part has an earlier one
        heads = parts.where("not later").select("h", *place).distinct().withColumn("first", first("h"))
        found = found.unionByName(parts.where("later").select(*place)).unionByName(heads.where(later).select(*place))
    tag = F.col("tag") if tagged else F.lit(0).cast("long").alias("tag")
    return found.select("doc_id", "at", tag).groupBy("doc_id", "tag").agg(F.collect_list("at").alias("starts"))


def _covered(starts, n: int, size: int) -> np.ndarray:
    """Which of ``n`` words lie in a window that starts at one of ``starts``."""
    edges = np.zeros(n + 1, np.int64)
    starts = np.unique(np.asarray(starts, np.int64))
    edges[starts] += 1
    edges[starts + size] -= 1
    return np.cumsum(edges[:n]) > 0


def _remover(size: int, digest: bool):
    """From ``_doc, text, starts`` to the document with its counts and its kept words (or their digest)."""

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, removed, kept = [], [], []
            for text, starts in zip(batch.column(1), batch.column(2)):
                words = (text.as_py() or "").encode().split()
                counts.append(len(words))
                gone = 0
                if starts.is_valid:
                    covered = _covered(starts.values.to_numpy(), len(words), size)
                    gone = int(covered.sum())
                    words = compress(words, ~covered)
                removed.append(gone)
                left = b" ".join(words)
                kept.append(hashlib.sha256(left).hexdigest() if digest else left.decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                names=["_doc", "n_words", "n_removed", "kept"],
            )

    return remove


def remove_repeats(docs: DataFrame, size: int = WINDOW, digest: bool = False) -> DataFrame:
    """``doc_id, n_words, n_removed, kept``: the words that stay, joined by one space (or their SHA-256)."""
    docs, tagged = _tagged(docs)
    runs = repeated_windows(docs, tagged, size).select(F.col("doc_id").alias("_id"), F.col("tag").alias("_tag"), "starts")
    rows = docs.join(runs, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("tag") == F.col("_tag")), "left")
    schema = T.StructType([T.StructField("_doc", docs.schema["doc_id"].dataType)]).add("n_words", "long").add("n_removed", "long").add("kept", "string")
    out = rows.select(F.col("doc_id").alias("_doc"), "text", "starts").mapInArrow(_remover(size, digest), schema)
    return out.withColumnRenamed("_doc", "doc_id")


def op3_substring_dedup(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs, digest=True).withColumnRenamed("kept", "kept_sha256")


SQL = r"""
WITH texts AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
    SELECT doc_id, i, array_to_string(w[i : i + 19], ' ') AS body
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM texts)
), numbered AS (
    SELECT doc_id, i, row_number() OVER (PARTITION BY body ORDER BY doc_id, i) AS n FROM windows
), covered AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS place FROM numbered WHERE n > 1
), places AS (
    SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM texts
), kept AS (
    SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY place) AS body
    FROM places ANTI JOIN covered USING (doc_id, place) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(body, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (doc_id)
"""
