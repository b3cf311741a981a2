"""Hilbert-curve sharding: rows ordered along a space-filling curve over quantised metadata.

Native: DataFrame functions only.

Each row becomes a cell of a grid with ``len(dims)`` axes of ``2**bits`` steps: text dimensions
(``lang``, ``source``) take a hash step, numeric ones an equi-depth step at approximate
quantiles. The cell's place on the Hilbert curve orders the rows, so a run of rows covers a
compact box of the grid and a filter on any of the dimensions touches few shards.

The order is cut into runs of equal row count (law ``rows``: counts at most one apart). Ranks
need no global sort: a cell's offset comes from the cell counts (at most ``2**(bits*dims)``
rows), and a cell with many rows is first dealt into pieces by the leading bits of a row hash,
so no task ever holds a hot cell whole.

Edge cases: null text counts as empty; null in a dimension is a step of its own hash (numeric:
step 0); repeated rows are rows of their own; an empty table gives no rows. ``shard_rows`` keeps
the input's columns, except that ones named ``shard`` or ``slot`` are replaced by its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from roadlens.llm.common import settle, sized

SHARDS = 40
BITS = 4
FRAME_BYTES = 16  # counted per row besides its text
PIECE_ROWS = 1_000_000  # a piece of a cell holds about this many rows at most
PIECES = 1024  # and about this share of all rows


def _trailing_ones(x: int) -> int:
    return ((~x & (x + 1)).bit_length() - 1) if x else 0


def _rotate_left(x: Column, by: Column, n: int) -> Column:
    # ``by`` is in 0..n-1; n steps are few, so each is its own branch
    out = x
    for k in range(1, n):
        out = F.when(by == k, F.shiftleft(x, k).bitwiseOR(F.shiftright(x, n - k)).bitwiseAND(F.lit((1 << n) - 1))).otherwise(out)
    return out


def hilbert_index(steps: list[Column], bits: int = BITS) -> Column:
    """Place of a grid cell on the Hilbert curve (one bit of every axis per level, Hamilton's form).

    Every level reads the cell's corner ``l``, turns it into the curve's own frame (entry point
    ``e``, direction ``d``), and its Gray-code rank ``w`` is the next digit of the index.
    """
    n = len(steps)
    gray = [w ^ (w >> 1) for w in range(1 << n)]
    rank = [gray.index(c) for c in range(1 << n)]
    entry = [0 if w == 0 else gray[2 * ((w - 1) // 2)] for w in range(1 << n)]
    turn = [0 if w == 0 else _trailing_ones(w - 1 if w % 2 == 0 else w) % n for w in range(1 << n)]

    def pick(values: list[int], at: Column) -> Column:
        return F.get(F.array(*[F.lit(v) for v in values]), at)

    corner = F.array(
        *[
            sum((F.shiftleft(F.shiftright(s.cast("int"), b).bitwiseAND(F.lit(1)), j) for j, s in enumerate(steps)), F.lit(0))
            for b in reversed(range(bits))
        ]
    )

    def level(at: Column, l: Column) -> Column:
        by = F.pmod(F.lit(n) - (at["d"] + 1), F.lit(n))  # rotate right by d + 1
        return F.transform(
            F.array(pick(rank, _rotate_left(l.bitwiseXOR(at["e"]), by, n))),
            lambda w: F.struct(
                (F.shiftleft(at["h"], n) + w.cast("long")).alias("h"),
                at["e"].bitwiseXOR(_rotate_left(pick(entry, w), F.pmod(at["d"] + 1, F.lit(n)), n)).alias("e"),
                F.pmod(at["d"] + pick(turn, w) + 1, F.lit(n)).alias("d"),
            ),
        )[0]

    start = F.struct(F.lit(0).cast("long").alias("h"), F.lit(0).alias("e"), F.lit(0).alias("d"))
    return F.aggregate(corner, start, level, lambda at: at["h"])


def curve_order(rows: DataFrame, text_dims: tuple[str, ...], number_dim: str, bits: int = BITS) -> Column:
    """The Hilbert index over hash steps of ``text_dims`` and equi-depth steps of ``number_dim``.

    Runs one aggregate for the quantiles (``2**bits - 1`` numbers reach the driver).
    """
    side = 1 << bits
    cuts = rows.agg(F.percentile_approx(number_dim, [i / side for i in range(1, side)], 1000)).first()[0] or []
    number = sum((F.when(F.col(number_dim) > c, 1).otherwise(0) for c in cuts), F.lit(0))
    texts = [F.pmod(F.xxhash64(F.lit(c), F.col(c)), F.lit(side)).cast("int") for c in text_dims]
    return hilbert_index([*texts, number], bits)


def ranked(rows: DataFrame) -> DataFrame:
    """``rows`` with ``_rank`` (0, 1, ...) in the order (``_cell``, ``_spread``, ``_tie``) and ``_total``.

    No global sort: ``_cell`` takes a bounded number of values (grid cells), and a cell with many
    rows is dealt into pieces by the leading bits of ``_spread``, a 64-bit row hash.
    """
    above = W.orderBy("_cell").rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(F.lit(0)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    size = F.greatest(F.lit(1.0), F.least(F.lit(float(PIECE_ROWS)), F.col("_total") / PIECES))
    cells = settle(
        rows.groupBy("_cell")
        .agg(F.count("*").alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(above), F.lit(0)))
        .withColumn("_total", F.sum("_n").over(whole))
        .withColumn("_bits", F.least(F.lit(40), F.ceil(F.log2(F.greatest(F.lit(1.0), F.col("_n") / size)))).cast("int"))
        .select("_cell", "_before", "_total", "_bits")
    )
    dealt = rows.join(F.broadcast(cells), "_cell").withColumn(  # at most one row per grid cell
        "_piece", F.expr("if(_bits = 0, 0, shiftrightunsigned(_spread, 64 - greatest(_bits, 1)))")
    )
    earlier = W.partitionBy("_cell").orderBy("_piece").rowsBetween(W.unboundedPreceding, -1)
    pieces = settle(
        dealt.groupBy("_cell", "_piece")
        .agg(F.count("*").alias("_n"))
        .select("_cell", "_piece", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_inside"))
    )
    row = F.row_number().over(W.partitionBy("_cell", "_piece").orderBy("_spread", "_tie")) - 1
    return (
        dealt.withColumn("_row", row)
        .join(sized(pieces), ["_cell", "_piece"])
        .withColumn("_rank", F.col("_before") + F.col("_inside") + F.col("_row"))
    )


def _cut(shards: int) -> list[Column]:
    """Shard and place in it: shard s holds the ranks from ceil(s * total / shards)."""
    shard = f"((_rank * {int(shards)}) div _total)"
    return [
        F.expr(f"cast({shard} as int)").alias("shard"),
        F.expr(f"_rank - ({shard} * _total + {int(shards) - 1}) div {int(shards)}").cast("long").alias("slot"),
    ]


def _sized(docs: DataFrame) -> list[Column]:
    text = F.coalesce(docs["text"], F.lit(""))
    return [
        docs["doc_id"],
        docs["lang"],
        docs["source"],
        (F.octet_length(text) + FRAME_BYTES).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).cast("long").alias("text_crc32"),
    ]


def _placed(rows: DataFrame, cell: Column) -> DataFrame:
    """Adds what ``ranked`` needs; the row hash takes the doc_id too, so copies of one text spread."""
    return rows.withColumns(
        {
            "_cell": cell,
            "_spread": F.xxhash64("text_crc32", "size", "doc_id"),
            "_tie": F.struct("doc_id", "text_crc32", "lang", "source"),
        }
    )


def plan_shards(docs: DataFrame, shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """One thin row per document: ``doc_id, size, text_crc32, curve, shard, slot``."""
    thin = settle(docs.select(*_sized(docs)))
    out = ranked(_placed(thin, curve_order(thin, ("lang", "source"), "size", bits)))
    return out.select("doc_id", "size", "text_crc32", F.col("_cell").alias("curve"), *_cut(shards))


def shard_rows(docs: DataFrame, shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """All columns of ``docs`` with ``shard`` and ``slot``; texts are shuffled once, by piece."""
    thin = docs.select(*_sized(docs))
    cell = curve_order(thin, ("lang", "source"), "size", bits)
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_doc"), *_sized(docs))
    out = ranked(_placed(rows, cell))
    kept = [F.col("_doc")[c].alias(c) for c in docs.columns if c.lower() not in ("shard", "slot")]
    return out.select(*kept, *_cut(shards))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, rows in slot order, one file each: readers skip shards by column ranges."""
    sharded.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op5_hilbert_sharding(docs: DataFrame) -> DataFrame:
    return plan_shards(docs).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "curve"
    )
