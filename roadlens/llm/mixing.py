"""Mixing sources to target weights: repetition rates per source, one hash-seeded draw per document.

Sizes are words. Tokens are summed per source; sources in code-point order (null last) weigh
5, 2, 1, repeating, and share ``budget`` times all words. A target stops at ``cap`` times its
source's words and the excess is shared again by weight; the resulting fixed point is found in
closed form: with ``t`` words per unit of weight, a source takes ``min(weight * t, cap * words)``.
Sources ordered by the ``t`` at which they saturate give every candidate ``t`` from running sums.

A document is emitted ``floor(rate)`` times, and once more when its hash, as a number in [0, 1),
is below the rate's fraction (``rate = target / source words``, at most ``cap``): an independent
Bernoulli draw that only depends on the seed, the doc_id and the rate, so reruns agree.

Edge cases: null text has no words; null sources are one source, the last; a source without
words has target 0 and is not taken; rows with a null doc_id share the draw of the text "null";
repeated rows draw alike; an empty table gives no rows. ``mix`` keeps the columns of its input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from roadlens.llm.common import settle, sized

WEIGHTS = (5, 2, 1)
BUDGET = 1.5
CAP = 2
SEED = "mix-1"
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, cap: int = CAP) -> DataFrame:
    """``source, source_size, target`` from rows ``(source, size)``; a settled table, a row per source."""
    per = settle(sizes.groupBy("source").agg(F.sum("size").alias("source_size")))
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.get(F.array(*[F.lit(w) for w in weights]), F.pmod(place, F.lit(len(weights))).cast("int"))
    ordered = per.withColumn("_place", place).withColumn("_w", weight.cast("double"))
    full = F.col("source_size") * F.lit(float(cap))
    ordered = ordered.withColumn("_full", full).withColumn("_at", F.col("_full") / F.col("_w"))
    before = W.orderBy("_at", "_place").rowsBetween(W.unboundedPreceding, -1)
    after = W.orderBy("_at", "_place").rowsBetween(W.currentRow, W.unboundedFollowing)
    whole = W.partitionBy(F.lit(0)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    total = F.sum("source_size").over(whole) * F.lit(float(budget))
    # what a unit of weight gets if all sources before this one are full and the rest share
    ordered = ordered.withColumn("_t", (total - F.coalesce(F.sum("_full").over(before), F.lit(0.0))) / F.sum("_w").over(after))
    # the first source that this leaves unsaturated fixes the share
    share = F.min(F.when(F.col("_t") <= F.col("_at"), F.struct("_at", "_place", "_t"))).over(whole)["_t"]
    target = F.least(F.col("_full"), F.col("_w") * F.coalesce(share, F.lit(float("inf"))))
    return settle(ordered.withColumn("target", target).select("source", "source_size", "target"))


def draw(doc_id: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) from the hash of seed and doc_id (52 bits)."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def copies(doc_id: Column, source_size: Column, target: Column, seed: str = SEED) -> Column:
    rate = F.when(source_size > 0, target / source_size).otherwise(F.lit(0.0))
    whole = F.floor(rate)
    return (whole + F.when(draw(doc_id, seed) < rate - whole, 1).otherwise(0)).cast("long")


def plan_mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, cap: int = CAP, seed: str = SEED) -> DataFrame:
    """One thin row per document: ``doc_id, size, source_size, target, copies``."""
    thin = settle(docs.select("doc_id", docs["source"].alias("_source"), n_words(docs["text"]).alias("size")))
    targets = source_targets(thin.select(F.col("_source").alias("source"), "size"), weights, budget, cap)
    out = thin.join(sized(targets), F.col("_source").eqNullSafe(targets["source"]))
    return out.select("doc_id", "size", "source_size", "target", copies(F.col("doc_id"), F.col("source_size"), F.col("target"), seed).alias("copies"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, cap: int = CAP, seed: str = SEED) -> DataFrame:
    """The mixture: every row of ``docs`` repeated as often as it is taken, with its own columns."""
    targets = source_targets(docs.select("source", n_words(docs["text"]).alias("size")), weights, budget, cap)
    targets = targets.select(F.col("source").alias("_source"), "source_size", "target")
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_doc"), docs["source"].alias("_of"))
    rows = rows.join(sized(targets), F.col("_of").eqNullSafe(F.col("_source")))
    taken = copies(F.col("_doc")["doc_id"], F.col("source_size"), F.col("target"), seed).cast("int")
    rows = rows.withColumn("_taken", taken).where("_taken > 0")
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_taken")))).select("_doc.*")


def op2_source_mixing(docs: DataFrame) -> DataFrame:
    plan = plan_mix(docs)
    return plan.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


# DuckDB SQL of op2_source_mixing over the view documents
SQL = r"""WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
p AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
o AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM p),
w AS (SELECT *, CAST([5, 2, 1][1 + place % 3] AS DOUBLE) AS wt, source_size * 2.0::DOUBLE AS full_words FROM o),
a AS (SELECT *, full_words / wt AS sat FROM w),
t AS (SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) * 1.5::DOUBLE
             - coalesce(sum(full_words) OVER (ORDER BY sat, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / sum(wt) OVER (ORDER BY sat, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share FROM a),
s AS (SELECT arg_min(share, (sat, place)) AS share FROM t WHERE share <= sat),
g AS (SELECT source, source_size, least(full_words, wt * coalesce((SELECT share FROM s), 'Infinity'::DOUBLE)) AS target FROM t),
r AS (SELECT d.doc_id, d.size, g.source_size, g.target,
             CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0 END AS rate,
             CAST(('0x' || substr(md5('mix-1:' || coalesce(CAST(d.doc_id AS VARCHAR), 'null')), 1, 13)) AS BIGINT) / 4503599627370496.0::DOUBLE AS u
      FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM r"""
