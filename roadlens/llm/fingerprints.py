"""Document fingerprints: bottom-k sketches of word shingles. Native: DataFrame functions only.

A sketch is the ascending array of the ``K`` smallest distinct 32-bit hashes of a text's shingles
(``SHINGLE`` words, white space apart; a shorter text is one shingle), all of them if there are
fewer. Sketches of parts merge into the sketch of the whole (``merged``), and two sketches
estimate resemblance, containment and, alone, the number of distinct shingles.

Edge cases: null and empty texts have the empty sketch, printed as ""; two empty sketches are
alike (1.0), an empty and a full one are not (0.0); repeated rows are rows of their own, in
doc_id order they follow each other by text; a null doc_id sorts below all; an empty table
gives no rows. Other columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

K = 128
SHINGLE = 5
HASH_BITS = 32
CUTS = 4096
CUT_ROWS = 64
WHITE = r"[\x20\x09-\x0D]+"


def shingle_hashes(text: Column, k: int = SHINGLE) -> Column:
    """Hashes of all shingles of a text (bigint, in 0..2^32-1; with repeats)."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), WHITE), lambda w: w != "")
    hashed = F.transform(words, lambda w: F.xxhash64(w))

    def rolled(h: Column) -> Column:
        runs = F.transform(
            F.sequence(F.lit(0), F.greatest(F.size(h) - k, F.lit(0))),
            lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(k)]).bitwiseAND(F.lit((1 << HASH_BITS) - 1)),
        )
        return F.when(F.size(h) > 0, runs).otherwise(F.array().cast("array<bigint>"))

    return _let(hashed, rolled)


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once per row."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def sketch(text: Column, k: int = K, shingle: int = SHINGLE) -> Column:
    return F.slice(F.sort_array(F.array_distinct(shingle_hashes(text, shingle))), 1, k)


def merged(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of two parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Share of the union's smallest hashes that both texts have: estimates the Jaccard similarity."""

    def share(m: Column) -> Column:
        both = F.size(F.array_intersect(F.array_intersect(m, a), b))
        return F.when(F.size(m) > 0, both / F.size(m)).otherwise(F.lit(1.0))

    return _let(merged(a, b, k), share)


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles: exact below k, else (k - 1) over the k-th smallest hash."""
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / ((F.get(a, F.lit(k - 1)) + 1) / float(1 << HASH_BITS)))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of ``a``'s shingles that ``b`` has: from resemblance and the three sizes."""
    union = distinct_shingles(merged(a, b, k), k)
    share = F.least(F.lit(1.0), resemblance(a, b, k) * union / distinct_shingles(a, k))
    return F.when(F.size(a) > 0, share).otherwise(F.lit(1.0))


def printed(a: Column) -> Column:
    """A sketch as text: 8 hex digits a hash."""
    return F.lower(F.array_join(F.transform(a, lambda h: F.lpad(F.hex(h), 8, "0")), ""))


def _piece(cuts: list[int]) -> Column:
    """How many of the sorted cuts lie below the doc_id, by binary search; null ids are in piece 0."""
    if not cuts:
        return F.lit(0)
    table = F.expr("array(" + ",".join(f"{c}L" for c in cuts) + ")")
    bits = F.sequence(F.lit(len(cuts).bit_length() - 1), F.lit(0), F.lit(-1))

    def step(at: Column, bit: Column) -> Column:
        to = at + F.call_function("shiftleft", F.lit(1), bit)
        return F.when((to <= len(cuts)) & (F.get(table, to - 1) < F.col("doc_id")), to).otherwise(at)

    return F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(F.aggregate(bits, F.lit(0), step))


def with_next(docs: DataFrame) -> DataFrame:
    """``doc_id, text, next``: the text that follows in descending doc_id (after the last: the first).

    Ids are dealt into ranges at approximate quantiles (at most ``CUTS``), and each range is a
    window of its own, so texts are shuffled once. A range's last row takes the first text of
    the next lower range that has rows; those are one document per range.
    """
    ids = docs.select("doc_id")
    pieces = max(1, min(CUTS, ids.count() // CUT_ROWS))
    cuts = ids.agg(F.percentile_approx("doc_id", [i / pieces for i in range(1, pieces)], 10 * CUTS)).first()[0] if pieces > 1 else None
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("_piece", _piece(sorted(set(cuts or []))))
    ring = W.orderBy(F.desc("_piece"))
    heads = rows.groupBy("_piece").agg(F.max("doc_id").alias("_top")).select(  # at most CUTS rows
        "_top",
        F.col("_piece").alias("_of"),
        F.coalesce(F.lag("_piece").over(ring), F.min("_piece").over(W.partitionBy(F.lit(0)))).alias("_after"),
    )
    heads = rows.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"), F.col("_piece").alias("_in")).join(
        F.broadcast(heads), (F.col("_in") == F.col("_of")) & F.col("_id").eqNullSafe(F.col("_top"))
    )
    heads = heads.groupBy("_after").agg(F.min("_text").alias("_head"))
    order = W.partitionBy("_piece").orderBy(F.col("doc_id").desc_nulls_last(), "text")
    rows = rows.withColumn("next", F.lead("text").over(order))
    rows = rows.join(heads, (F.col("_piece") == F.col("_after")) & F.col("next").isNull(), "left")
    return rows.select("doc_id", "text", F.coalesce("next", "_head").alias("next"))


def op8_fingerprints(docs: DataFrame, k: int = K) -> DataFrame:
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - third), F.substring("next", F.lit(1), third))
    rows = with_next(docs).withColumn("edited", edited)
    rows = rows.select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        sketch(F.col("text"), k).alias("a"),
        sketch(F.col("edited"), k).alias("b"),
        sketch(F.col("next"), k).alias("c"),
    )
    return rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        printed(F.col("a")).alias("fingerprint"),
        printed(F.col("b")).alias("edited_fingerprint"),
        resemblance(F.col("a"), F.col("b"), k).alias("near_edited"),
        resemblance(F.col("a"), F.col("c"), k).alias("near_next"),
    )
