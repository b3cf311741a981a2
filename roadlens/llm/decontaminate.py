"""Benchmark decontamination: documents streamed through a suffix automaton of the test items.

Text is normalised (A-Z lowered; words are runs of letters, digits and anything past ASCII).
The items' words build a generalised suffix automaton; each document is read once, word by
word, following the longest run of words that also occurs in an item. Where that run holds a
window (``window`` consecutive words of an item, or a whole shorter item), the window's words
are hit. ``decontaminate`` cuts hit runs out of the texts, and drops a document whose hit words
exceed a share of all its words.

Items are taken in blocks of at most ``BLOCK_WORDS`` words; a block's words are broadcast
(bounded by that size) and every worker builds its automaton once. With several blocks the
documents are streamed once per block, each pass adding its hits to the row (and settling, so
one automaton at a time is in memory).

Edge cases: null and empty texts have no words; null, empty or word-less items match nothing;
repeated documents and items count each; an item id may repeat, its texts are then searched
alike; null item ids are skipped in ``items``; without items nothing is hit.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlens.llm.automaton import SuffixAutomaton
from roadlens.llm.common import settle, trimmed

WINDOW = 10
MAX_COVERAGE = 0.5
BLOCK_WORDS = 250_000  # of one automaton: at most twice as many states, about 150 MB per worker
ITEM_WORDS = 100_000  # a longer item is taken in pieces that overlap by a window

KEEP = bytes(c | 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
FOUND = T.StructType().add("_n", T.LongType()).add("_runs", T.ArrayType(T.LongType())).add("_items", T.ArrayType(T.StringType()))


def normalised(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(KEEP).split()


@lru_cache(maxsize=1)
def _automaton(block: int, shared, window: int) -> SuffixAutomaton:
    return SuffixAutomaton(shared.value, window)


def item_blocks(benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> Iterator[list]:
    """Items as ``(item_id, words)``, in lists of at most ``block_words`` words, one list at a time."""
    block: list = []
    size = 0
    longest = min(ITEM_WORDS, block_words)
    for row in benchmark.select("item_id", "text").where(F.col("text").isNotNull()).toLocalIterator():
        words = normalised(row["text"])
        for at in range(0, max(1, len(words) - window + 1), longest - window + 1):
            part = words[at : at + longest]
            if block and size + len(part) > block_words:
                yield block
                block, size = [], 0
            block.append((row["item_id"], part))
            size += len(part)
    if block:
        yield block


def _united(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for x, y in sorted(a + b):
        if out and x <= out[-1][1]:
            out[-1] = (out[-1][0], max(y, out[-1][1]))
        else:
            out.append((x, y))
    return out


def _pairs(flat: list[int]) -> list[tuple[int, int]]:
    return list(zip(flat[::2], flat[1::2]))


def _searcher(block: int, shared, window: int, first: bool, keep_text: bool):
    """Streams ``_doc, _text[, _n, _runs, _items]`` through one block's automaton."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(block, shared, window)
        for batch in batches:
            counts, runs, items = [], [], []
            for row, text in enumerate(batch.column(1)):
                words = normalised(text.as_py())
                found, of = automaton.search(words)
                named = {str(i) for i in of if i is not None}
                if not first:
                    found = _united(found, _pairs(batch.column(3)[row].as_py()))
                    named.update(batch.column(4)[row].as_py())
                counts.append(len(words))
                runs.append([x for run in found for x in run])
                items.append(sorted(named))
            columns = [batch.column(0)] + [batch.column(1)] * keep_text
            columns += [pa.array(counts, pa.int64()), pa.array(runs, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, names=["_doc", *["_text"] * keep_text, "_n", "_runs", "_items"])

    return search


def search(
    rows: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
    keep_text: bool = True,
    *,
    then=None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Rows ``_doc, _text`` with ``_n`` words, ``_runs`` of hit words (first, end, first, end, ...) and ``_items`` found.

    ``then`` maps those batches to ``schema`` in the same worker, so a task needs no second one.
    """
    context = rows.sparkSession.sparkContext
    both = T.StructType([rows.schema["_doc"], rows.schema["_text"]])
    last = schema if then else T.StructType(both.fields[: 1 + keep_text] + FOUND.fields)
    out, waiting = rows, None
    for i, block in enumerate(item_blocks(benchmark, window, block_words)):
        if waiting:
            out = settle(out.mapInArrow(trimmed(_searcher(*waiting, window, i == 1, True)), T.StructType(both.fields + FOUND.fields)))
        waiting = i, context.broadcast(block)
    i, shared = waiting or (0, context.broadcast([]))
    find = _searcher(i, shared, window, i == 0, keep_text)
    return out.mapInArrow(trimmed((lambda batches: then(find(batches))) if then else find), last)


def _cutter(max_coverage: float):
    """Cuts ``_runs`` out of ``_text``; a row whose runs cover more than ``max_coverage`` of its words goes."""
    word = re.compile(rb"[^ ]+")

    def cut(text: str, runs: list[tuple[int, int]]) -> str:
        raw = text.encode()
        where = [m.span() for m in word.finditer(raw.translate(KEEP))]
        out, last = [], 0
        for a, b in runs:
            out.append(raw[last : where[a][0]])
            last = where[b - 1][1]
        return b"".join([*out, raw[last:]]).decode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, keep = [], []
            for text, n, flat in zip(batch.column(1), batch.column(2), batch.column(3)):
                runs = _pairs(flat.as_py())
                keep.append(sum(b - a for a, b in runs) <= max_coverage * n.as_py())
                texts.append(cut(text.as_py(), runs) if runs and keep[-1] else text.as_py())
            changed = pa.array([len(f.as_py()) > 0 for f in batch.column(3)])
            out = [batch.column(0), pa.array(texts, batch.schema.field(1).type), changed]
            yield pa.RecordBatch.from_arrays(out, names=["_doc", "_text", "_cut"]).filter(pa.array(keep))

    return run


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_coverage: float = MAX_COVERAGE) -> DataFrame:
    """``docs`` without the item passages; documents covered beyond ``max_coverage`` are dropped.

    Columns are those of ``docs``; ``n_chars``, if there, is counted anew for cut texts.
    """
    others = [c for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*[docs[c] for c in others]).alias("_doc"), docs["text"].alias("_text"))
    schema = T.StructType([*rows.schema.fields, T.StructField("_cut", T.BooleanType())])
    out = search(rows, benchmark, window, then=_cutter(max_coverage), schema=schema)
    of = {c: F.col("_doc")[c].alias(c) for c in others} | {"text": F.col("_text").alias("text")}
    if "n_chars" in others:
        counted = F.length("_text").cast(docs.schema["n_chars"].dataType)
        of["n_chars"] = F.when(F.col("_cut"), counted).otherwise(F.col("_doc")["n_chars"]).alias("n_chars")
    return out.select(*[of[c] for c in docs.columns])


def op7_benchmark_decontamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    found = search(docs.select(docs["doc_id"].alias("_doc"), docs["text"].alias("_text")), benchmark, keep_text=False)
    hit = F.aggregate(
        F.sequence(F.lit(0), F.size("_runs") - 2, F.lit(2)),
        F.lit(0).cast("long"),
        lambda n, i: n + F.get("_runs", i + 1) - F.get("_runs", i),
    )
    hit = F.when(F.size("_runs") > 0, hit).otherwise(F.lit(0).cast("long"))
    return found.select(
        F.col("_doc").alias("doc_id"),
        F.col("_n").alias("n_words"),
        hit.alias("n_hit"),
        F.size("_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("_items", ","), 256).alias("items_sha256"),
        (F.size("_runs") > 0).alias("contaminated"),
    )


# one window size per item: ten words, or all of a shorter item
SQL = r"""
WITH texts AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), items AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), grams AS (
    SELECT DISTINCT item_id, size, array_to_string(w[i : i + size - 1], ' ') AS body
    FROM (
        SELECT item_id, w, least(10, len(w)) AS size, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
        FROM items WHERE len(w) > 0
    )
), places AS (
    SELECT doc_id, i, size, array_to_string(w[i : i + size - 1], ' ') AS body
    FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM texts, (SELECT DISTINCT size FROM grams))
), found AS (
    SELECT DISTINCT doc_id, i, size, item_id FROM places JOIN grams USING (size, body)
), hits AS (
    SELECT doc_id, count(DISTINCT place) AS n
    FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM found) GROUP BY doc_id
), named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS name FROM found WHERE item_id IS NOT NULL) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(names, '')) AS items_sha256, coalesce(n, 0) > 0 AS contaminated
FROM texts LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)
"""
