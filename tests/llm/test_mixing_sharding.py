"""Mixing against DuckDB, the share fixed point by iteration; sharding laws and the curve."""

import itertools
import random

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from roadlens.llm import mixing as M
from roadlens.llm import sharding as S

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(n=400, seed=1):
    r = random.Random(seed)
    source = lambda: r.choice([None, "hot", "hot", "hot", "é", "Z", "a", "b", "\U0001f600", "￿", "empty"])
    rows = []
    for i in range(n):
        s = source()
        t = None if r.random() < 0.05 else "" if s == "empty" else " ".join("w" for _ in range(r.choice([0, 1, 5, 50, 500])))
        rows.append((i if i % 50 else None, t, r.choice(["en", None]), s, 1))
    return rows + rows[:3]


def test_query_equals_duckdb(spark):
    rows = corpus()
    got = M.op2_source_mixing(spark.createDataFrame(rows, DOCS).withColumn("size", F.lit("clash"))).toPandas()
    documents = pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source", "n_chars"]).astype({"doc_id": "Int64"})  # noqa: F841
    want = duckdb.connect().execute(M.SQL.replace("FROM documents", "FROM documents")).df()
    key = lambda d: sorted(map(str, d.astype({"doc_id": "Int64"})[["doc_id", "size", "source_size", "target", "taken"]].itertuples(index=False, name=None)))
    assert key(got) == key(want)
    assert (got["taken"] <= 2 * got["size"]).all()


def test_targets_equal_repeated_sharing(spark):
    r = random.Random(3)
    for n in (1, 2, 7, 20):
        sizes = {f"s{i:02d}": r.choice([0, 1, 10, 1000, 100000]) for i in range(n)}
        total, target = 1.5 * sum(sizes.values()), dict.fromkeys(sizes, 0.0)
        weight = {s: M.WEIGHTS[i % 3] for i, s in enumerate(sorted(sizes))}
        open_ = set(sizes)
        while open_:
            left = total - sum(2 * sizes[s] for s in sizes if s not in open_)
            share = left / sum(weight[s] for s in open_)
            full = {s for s in open_ if weight[s] * share > 2 * sizes[s]}
            if not full:
                target.update({s: weight[s] * share for s in open_})
                break
            target.update({s: 2.0 * sizes[s] for s in full})
            open_ -= full
        got = {x["source"]: x["target"] for x in M.source_targets(spark.createDataFrame(list(sizes.items()), "source string, size long")).collect()}
        assert got == pytest.approx(target)


def test_mix_repeats_rows_and_reruns_agree(spark):
    frame = spark.createDataFrame(corpus(), DOCS).withColumn("target", F.lit("mine"))
    first, again = (sorted(map(str, M.mix(frame).collect())) for _ in range(2))
    assert first == again and frame.columns == M.mix(frame).columns
    plan = M.plan_mix(frame).agg(F.sum("copies")).first()[0]
    assert plan == len(first)
    assert M.op2_source_mixing(frame.limit(0)).count() == 0 and M.mix(frame.limit(0)).count() == 0


def check_law(rows, shards):
    counts = {}
    for r in rows:
        counts.setdefault(r["shard"], []).append(r["slot"])
    sizes = [len(counts.get(s, [])) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and set(counts) <= set(range(shards))
    assert all(sorted(v) == list(range(len(v))) for v in counts.values())


@pytest.mark.parametrize("n", [0, 7, 403])
def test_shards_are_even_and_gapless(spark, n):
    import zlib

    frame = spark.createDataFrame(corpus()[:n], DOCS).withColumn("curve", F.lit("clash"))
    rows = S.op5_hilbert_sharding(frame).collect()
    assert len(rows) == n
    check_law(rows, 40)
    texts = sorted((str(r[0]), len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in corpus()[:n])
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in rows) == texts
    whole = S.shard_rows(frame, 7).collect()
    check_law(whole, 7)
    assert sorted(str(r[:6]) for r in whole) == sorted(str(tuple(r)) for r in frame.collect())


def test_hot_cell_is_dealt_into_pieces(spark):
    frame = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("same").alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"))
    rows = S.op5_hilbert_sharding(frame).collect()
    check_law(rows, 40)
    assert len({(r["shard"], r["slot"]) for r in rows}) == 5000


@pytest.mark.parametrize("dims,bits", [(2, 3), (3, 2), (3, 3)])
def test_curve_visits_every_cell_by_single_steps(spark, dims, bits):
    cells = list(itertools.product(range(1 << bits), repeat=dims))
    names = [f"c{i}" for i in range(dims)]
    frame = spark.createDataFrame(cells, ", ".join(f"{n} int" for n in names))
    rows = sorted(frame.select(S.hilbert_index([F.col(n) for n in names], bits).alias("h"), *names).collect())
    assert [r["h"] for r in rows] == list(range(len(cells)))
    for a, b in zip(rows, rows[1:]):
        assert sum(abs(x - y) for x, y in zip(a[1:], b[1:])) == 1


def test_written_shards_prune_by_metadata(spark, tmp_path):
    rows = [(i, "w " * (i % 97), ["en", "de", "fr", "es"][i % 4], f"s{i % 10}", i) for i in range(4000)]
    S.write_shards(S.shard_rows(spark.createDataFrame(rows, DOCS), 40), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 4000
    touched = lambda cond: back.where(cond).select("shard").distinct().count()
    assert touched("lang = 'de' and source = 's1'") <= 16 and touched("n_chars < 0") == 0
