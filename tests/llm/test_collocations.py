"""Collocations against a plain count of all phrases, with many small shards and both counting paths."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from roadlens.llm import collocations as C

SCHEMA = "doc_id long, text string, lang string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, support=100, longest=5, top=2000, percent=100):
    count, total = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    count[lang, tuple(words[i : i + k])] += 1
    often = {p: a for p, a in count.items() if a >= support}
    out = []
    for (lang, words), a in often.items():
        k = len(words)
        if k == 1:
            continue
        around = [b for (other, w), b in often.items() if other == lang and len(w) > k and any(w[i : i + k] == words for i in range(len(w) - k + 1))]
        if any(100 * b >= percent * a for b in around):
            continue
        cuts = []
        for c in range(1, k):
            left, right = often[lang, words[:c]], often[lang, words[c:]]
            cuts.append((1000 * a * total[lang] // (left * right), c, left, right))
        score, _, left, right = min(cuts)
        out.append((lang, " ".join(words), a, left, right, total[lang], score))
    ranked = []
    for lang in {o[0] for o in out}:
        own = sorted((o for o in out if o[0] == lang), key=lambda o: (-o[6], -o[2], o[1].encode()))
        ranked += [(o[0], i + 1, *o[1:]) for i, o in enumerate(own[:top])]
    return sorted(ranked)


def run(spark, rows, partitions=3, **kw):
    df = spark.createDataFrame(rows, SCHEMA).repartition(partitions)
    return sorted(tuple(r) for r in C.collocations(df, **kw).collect())


def random_docs(seed, docs=250, words=60, kinds=1):
    rnd = random.Random(seed)
    vocabulary = ["the", "Of", "é", "ÀB", "a.b", "x\u00a0y", "re-use", "q\x1cr"] + [f"w{i}" for i in range(kinds)]
    out = []
    for i in range(docs):
        text = ""
        for _ in range(rnd.randrange(words)):
            text += rnd.choice(["fixed phrase of five words", *vocabulary * 2]) + rnd.choice([" "] * 8 + ["  ", "\t", ". ", ",", "\n", "\x0b", "; "])
        out.append((i, text, rnd.choice(["en", "en", "en", "fr", None, "und"])))
    return out + [(None, None, "en"), (7, "", "fr"), (7, " \t.,", None), (8, "\n", "xx"), out[0], out[0]]


@pytest.mark.parametrize("shards,table,flush", [(8, C.TABLE, C.FLUSH), (1, C.TABLE, 50), (3, 1 << 16, 50), (40, 64, 1)])
def test_equals_brute_force(spark, monkeypatch, shards, table, flush):
    """Whatever the number of shards, and with a table so full that it lets everything through."""
    monkeypatch.setattr(C, "FLUSH", flush)
    rows = random_docs(shards)
    want = brute(rows, support=12)
    assert len(want) > 30 and run(spark, rows, partitions=7, support=12, shards=shards, table=table) == want


def test_other_bounds(spark):
    rows = random_docs(5)
    for kw in ({"support": 9, "longest": 3}, {"support": 12, "percent": 60}, {"support": 10, "top": 4}, {"support": 10**6}):
        assert run(spark, rows, **kw) == brute(rows, **kw)


def test_frequent_in_one_shard_only(spark):
    """All occurrences in one text: that text's shard finds it, whatever the others hold."""
    rows = [(0, "rare pair . " * 100, "en")] + [(i, "a b c d e f g " * 20, "en") for i in range(1, 40)]
    assert run(spark, rows, partitions=9) == brute(rows)


def test_spread_over_all_shards(spark):
    """As many occurrences in each shard as the lowered support asks, in one more than in the others."""
    rows = [(i, "rare pair . " * (13 if i < 4 else 12), "en") for i in range(8)]
    assert run(spark, rows, partitions=8) == brute(rows) != []


def test_query_on_table(spark, smoke_dir):
    docs = spark.read.parquet(f"{smoke_dir}/documents.parquet").select("doc_id", "text", "lang")
    docs = docs.unionByName(docs).unionByName(docs)
    want = brute([tuple(r) for r in docs.collect()])
    assert want and sorted(tuple(r) for r in C.op13_phrase_collocations(docs).collect()) == want


def test_long_text_and_large_products(spark):
    rows = [(0, "one two three " * 40_000 + "x" * 200_000, "en"), (1, "one two. " * 30_000, "en")]
    assert run(spark, rows) == brute(rows)


def test_empty_and_clashing(spark):
    assert C.op13_phrase_collocations(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(0, "p q r " * 120, "en"), (1, "p q " * 120, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    df = df.withColumns({c: F.lit("x") for c in ("phrase", "key", "a", "n", "words", "size", "_hash", "rank", "score", "shard")})
    assert sorted(tuple(r) for r in C.op13_phrase_collocations(df).collect()) == brute(rows)
