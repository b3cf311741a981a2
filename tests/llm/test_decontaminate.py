"""Benchmark decontamination against a brute-force window search."""

import hashlib
import random
import re

import pytest

from roadlens.llm import decontaminate as D
from roadlens.llm.automaton import SuffixAutomaton

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ITEMS = "item_id long, text string"


def brute(texts, items, k=10):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = {}
    for i, t in items:
        w = words(t)
        n = min(k, len(w))
        for a in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[a : a + n]), set()).add(i)
    out = []
    for d, t in texts:
        w, hit, of = words(t), set(), set()
        for n in {len(x) for x in windows}:
            for a in range(len(w) - n + 1):
                if (found := windows.get(tuple(w[a : a + n]))) is not None:
                    hit.update(range(a, a + n))
                    of |= found
        ids = sorted(str(i) for i in of if i is not None)
        out.append((d, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def random_case(seed, n_docs=60, n_items=12, alphabet=3):
    r = random.Random(seed)
    say = lambda n: r.choice(["", " "]) + " ".join(r.choice(["a", "B", "é", "x1", "of"][:alphabet]) + r.choice(["", ",", "\n", "."]) for _ in range(n))
    items = [(i, say(r.choice([1, 2, 5, 9, 10, 11, 14, 25]))) for i in range(n_items)]
    docs = []
    for i in range(n_docs):
        t = say(r.randint(0, 40))
        if r.random() < 0.5:
            t += " zz " + r.choice(items)[1] + " zz " + say(r.randint(0, 8))
        docs.append((i, t))
    return docs, items


@pytest.mark.parametrize("seed", range(4))
def test_automaton_equals_window_search(seed):
    docs, items = random_case(seed, alphabet=2 + seed % 3)
    words = lambda t: D.normalised(t)
    for k in (2, 3, 10):
        auto = SuffixAutomaton([(i, words(t)) for i, t in items], k)
        for (_, t), (_, n, hit, n_items, _, bad) in zip(docs, sorted(brute(docs, items, k), key=lambda x: x[0])):
            runs, of = auto.search(words(t))
            assert (sum(b - a for a, b in runs), len(of), bool(runs)) == (hit, n_items, bad)


@pytest.mark.parametrize("block_words", [D.BLOCK_WORDS, 40])
def test_query_equals_brute_force(spark, block_words, monkeypatch):
    docs, items = random_case(9, alphabet=5)
    docs += [(100, None), (101, ""), (102, "... --"), (103, items[0][1]), (103, items[0][1]), (None, items[3][1])]
    items += [(50, None), (51, ""), (52, "!!"), (3, items[3][1])]
    monkeypatch.setattr(D.item_blocks, "__defaults__", (10, block_words))
    monkeypatch.setattr(D.search, "__defaults__", (10, block_words, True))
    frame = spark.createDataFrame([(i, t, "en", None, None) for i, t in docs], DOCS).withColumn("_n", __import__("pyspark.sql.functions", fromlist=["lit"]).lit("clash"))
    got = D.op7_benchmark_decontamination(frame, spark.createDataFrame(items, ITEMS))
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b", "en", "s", 3)], DOCS)
    none = spark.createDataFrame([], ITEMS)
    assert D.op7_benchmark_decontamination(docs, none).collect()[0]["contaminated"] is False
    assert D.op7_benchmark_decontamination(docs.limit(0), spark.createDataFrame([(1, "a b")], ITEMS)).count() == 0
    assert D.decontaminate(docs, none).collect() == docs.collect()


def test_decontaminate_cuts_runs_and_drops_covered_documents(spark):
    item = " ".join(f"w{i}" for i in range(12))
    fill = " ".join(f"f{i}" for i in range(30))
    docs = [(1, f"{fill}, {item.upper()}! end é"), (2, item), (3, fill), (4, None), (5, "")]
    frame = spark.createDataFrame([(i, t, "en", "s", 9) for i, t in docs], DOCS)
    got = {r["doc_id"]: r for r in D.decontaminate(frame, spark.createDataFrame([(7, item)], ITEMS)).collect()}
    assert set(got) == {1, 3, 4, 5}
    assert got[1]["text"] == f"{fill}, ! end é" and got[1]["n_chars"] == len(got[1]["text"])
    assert got[3] == frame.where("doc_id = 3").first() and got[4]["text"] is None
