"""Hard negatives by exact scores: residue-number-system products, then windowed selection.

Components become whole numbers, ``floor(scale * x)``. The score of a row for an anchor (a query
row) is their inner product, exact: matrices of residues modulo a few small primes are multiplied
in float32 and put together by Chinese remaindering (``residues``); the number of primes
follows from the largest norms (Cauchy-Schwarz over all rows). Two passes over anchors x rows:

1. an anchor's positives are its first other rows of the same label;
2. for each positive, the first rows of other labels whose score lies in the window
   ``low % .. high %`` of the positive's score.

Higher scores come first, equal ones by smaller id. Rows are dealt into groups of at most about
``CELLS`` components, anchors go to every group (a stated query set against all rows,
in blocks). A task holds one group, streams the anchors past it and sends on only the best few of
every anchor and group, which windows rank. No score matrix is kept: the second pass multiplies again.

Edge cases: rows with a null label, a null vector or a null or non-finite component take no part;
vectors of unequal lengths are compared as if the shorter had zeros behind it; every row is
a row of its own, so a repeated row is another row for its copy; rows with a null id are no anchors
and come last among equal scores; a positive without rows in its window gives no rows; an empty
table gives no rows. Scores that could exceed 64 bits are refused with an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlens.llm.common import settle
from roadlens.llm.residues import primes_for, product, residues

CELLS = 1 << 22  # components of the rows that one task holds at a time
ROWS = 1024  # rows of a group at least, so that few groups send on their best
SCORES = 1 << 21  # scores of a batch of anchors held at a time

BEST = "query long, anchor_id long, slot int, positive_id long, positive_score long, row long, id long, score long"


def _matrix(col: pa.Array, scale: float) -> np.ndarray:
    """A list column as whole numbers, rows x longest length."""
    size = np.diff(col.offsets.to_numpy())
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    whole = np.floor(flat * scale)
    out = np.zeros((len(size), int(size.max(initial=0))))
    out[np.arange(out.shape[1]) < size[:, None]] = whole
    return out


def _wide(x: np.ndarray, d: int) -> np.ndarray:
    return x if x.shape[1] == d else np.pad(x, ((0, 0), (0, d - x.shape[1])))


def _first(values: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` largest values, larger ones and then earlier ones first."""
    n = len(values)
    if n > 8 * k:
        least = np.partition(values, n - k)[n - k]
        above = np.flatnonzero(values > least)
        at = np.concatenate([above, np.flatnonzero(values == least)[: k - len(above)]])
    else:
        at = np.arange(n)
    return at[np.lexsort((at, -values[at]))[:k]]


class _Group:
    """The rows of one group, sorted by id, against which anchors are scored."""

    def __init__(self, parts: list[pa.RecordBatch], scale: float, primes: tuple[int, ...]):
        rows = pa.Table.from_batches(parts).combine_chunks()
        self.scale, self.primes = scale, primes
        self.row = rows["row"].to_numpy()
        self.id = rows["id"].combine_chunks()
        self.label = rows["label"].to_numpy()
        self.matrix = _matrix(rows["vec"].combine_chunks(), scale)
        self.residues = residues(self.matrix, primes)

    def scores(self, anchors: pa.RecordBatch) -> np.ndarray:
        asked = _matrix(anchors.column("vec"), self.scale)
        d = max(asked.shape[1], self.matrix.shape[1])
        if d > self.matrix.shape[1]:
            self.matrix = _wide(self.matrix, d)
            self.residues = residues(self.matrix, self.primes)
        return product(residues(_wide(asked, d), self.primes), self.residues, self.primes)

    def answer(self, anchors: pa.RecordBatch, pick) -> pa.RecordBatch:
        found = []
        label, row, ids = anchors.column("label").to_numpy(), anchors.column("row").to_numpy(), anchors.column("id").to_pylist()
        given = anchors.column("positives").to_pylist()
        for i, scores in enumerate(self.scores(anchors)):
            same = self.label == label[i]
            for slot, positive, limit, at in pick(scores, same, self.row != row[i], given[i]):
                found.append((row[i], ids[i], slot, positive, limit, at, scores[at]))
        n = [len(f[5]) for f in found]
        at = np.concatenate([f[5] for f in found]) if found else np.zeros(0, np.int64)
        spread = lambda j, kind: pa.array([f[j] for f in found], kind).take(pa.array(np.repeat(np.arange(len(found)), n)))
        score = np.concatenate([f[6] for f in found]) if found else np.zeros(0, np.int64)
        columns = [spread(0, pa.int64()), spread(1, pa.int64()), spread(2, pa.int32()), spread(3, pa.int64()), spread(4, pa.int64())]
        columns += [pa.array(self.row[at]), self.id.take(pa.array(at)), pa.array(score, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in BEST.split(", ")])


def _positives(scores, same, other, _, k: int):
    at = np.flatnonzero(same & other)
    yield 0, None, None, at[_first(scores[at], k)]


def _negatives(scores, same, _, positives, k: int, low: int, high: int):
    at = np.flatnonzero(~same)
    values = scores[at]
    for p in positives or ():
        score = p["score"]
        inside = np.flatnonzero((values >= -(-low * score // 100)) & (values <= high * score // 100))
        yield p["slot"], p["id"], score, at[inside[_first(values[inside], k)]]


def _scan(scale: float, primes: tuple[int, ...], pick):
    """Over rows sorted by group, the group's rows first and then the anchors: the picked rows."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held, block = None, [], None
        for batch in batches:
            part, kind = batch.column("part").to_numpy(), batch.column("kind").to_numpy()
            cuts = np.flatnonzero((np.diff(part) != 0) | (np.diff(kind) != 0)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(part)]):
                if a == b:
                    continue
                if part[a] != group:
                    group, held, block = part[a], [], None
                piece = batch.slice(a, b - a)
                if kind[a] == 0:
                    held.append(piece)
                    continue
                if not held:
                    continue
                block = block or _Group(held, scale, primes)
                step = max(1, SCORES // len(block.row))
                for c in range(0, b - a, step):
                    yield block.answer(piece.slice(c, step), pick)

    return scan


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = "OVER (PARTITION BY query, slot ORDER BY score DESC, id ASC NULLS LAST, row)"
    return found.selectExpr("*", f"row_number() {order} AS rank").where(F.col("rank") <= k)


def hard_negatives(
    rows: DataFrame,
    anchors: str = "id % 100 = 0",
    scale: float = 256.0,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
) -> DataFrame:
    """Hard negatives of the rows for which the SQL text ``anchors`` holds; ``rows``: ``id, label, vec``."""
    finite = "forall(vec, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"
    norm = f"sqrt(aggregate(vec, 0D, (s, x) -> s + power(abs(double(x)) * {scale!r}D + 1, 2)))"
    kept = rows.selectExpr("CAST(id AS BIGINT) AS id", "CAST(label AS BIGINT) AS label", "vec").where(f"label IS NOT NULL AND vec IS NOT NULL AND {finite}")
    kept = settle(kept.withColumn("row", F.monotonically_increasing_id()).selectExpr("*", f"coalesce({anchors}, FALSE) AS asked"))
    large = kept.agg(F.expr(f"max({norm}) AS all"), F.expr(f"max({norm}) FILTER (WHERE asked) AS asked"), F.expr("sum(size(vec)) AS cells"), F.expr("count(*) AS n")).first()
    bound = (large["all"] or 0.0) * (large["asked"] or 0.0) * (1 + 1e-9)
    if not bound < 1 << 62:
        raise ValueError(f"scores of up to {bound:.3g} do not fit into 64 bits")
    primes = primes_for(bound)
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups = max(1, min(tasks, large["n"] // ROWS), -(-(large["cells"] or 0) // CELLS))
    part = F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int")
    none = F.lit(None).cast("array<struct<slot:int,id:long,score:long>>")
    held = kept.select(part.alias("part"), F.lit(0).alias("kind"), "row", "id", "label", "vec", none.alias("positives"))

    def scanned(asked: DataFrame, pick) -> DataFrame:
        every = F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("part")
        sent = asked.select(every, F.lit(1).alias("kind"), "row", "id", "label", "vec", "positives")
        dealt = held.unionByName(sent).repartitionById(groups, F.col("part"))
        dealt = dealt.sortWithinPartitions("part", "kind", F.asc_nulls_last("id"), "row")
        return dealt.mapInArrow(_scan(scale, primes, pick), BEST)

    queries = kept.where("asked")
    best = _ranked(scanned(queries.withColumn("positives", none), partial(_positives, k=positives)), positives)
    given = best.groupBy("query").agg(F.sort_array(F.collect_list(F.struct(F.col("rank").alias("slot"), "id", "score"))).alias("positives"))
    given = settle(given.withColumnRenamed("query", "row"))
    found = _ranked(scanned(queries.join(given, "row"), partial(_negatives, k=negatives, low=low, high=high)), negatives)
    return found.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def op12_hard_negatives(embeddings: DataFrame) -> DataFrame:
    label = "CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label"
    return hard_negatives(embeddings.selectExpr("vec_id AS id", label, "embedding AS vec"))


SQL = """WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS l,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (SELECT a.r AS ar, a.vec_id AS anchor_id, b.r AS br, b.vec_id AS id, a.l = b.l AS same, list_dot_product(a.e, b.e)::BIGINT AS score
  FROM v a JOIN v b ON a.r <> b.r WHERE a.vec_id % 100 = 0),
p AS (SELECT ar, anchor_id, br AS pr, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY ar ORDER BY score DESC, id, br) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.ar, pr ORDER BY score DESC, id, br) AS INT) AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON p.ar = s.ar AND NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10"""
