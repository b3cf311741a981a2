"""Fingerprints against plain Python sets and neighbours."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from roadlens.llm import fingerprints as P

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def shingles(t, k=5):
    w = (t or "").encode().split()
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def corpus(n=300, seed=2):
    r = random.Random(seed)
    say = lambda m: " ".join(r.choice("abcdefghij") + r.choice("klé\U0001f600") for _ in range(m))
    docs = [(r.randrange(-50, 50) * 1000 + i, say(r.choice([0, 1, 3, 6, 60, 300]))) for i, _ in enumerate(range(n))]
    return docs + [(docs[0][0], docs[0][1]), (None, "x y z"), (10**9, None)]


def brute(docs):
    key = lambda d: (d[0] is None, -(d[0] or 0), d[1] or "")
    order = sorted(docs, key=key)
    out = []
    for i, (d, t) in enumerate(order):
        t, nxt = t or "", order[(i + 1) % len(order)][1] or ""
        m = len(t) // 3
        edited = t[: len(t) - m] + nxt[:m]
        jac = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
        a = shingles(t)
        out.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), jac(a, shingles(edited)), jac(a, shingles(nxt)), len(a), t))
    return out


def test_query_equals_brute_force_up_to_the_estimate(spark):
    docs = corpus()
    frame = spark.createDataFrame([(i, t, "en", None, None) for i, t in docs], DOCS).withColumn("next", F.lit("clash"))
    rows = P.op8_fingerprints(frame).collect()
    want = brute(docs)
    got = sorted(rows, key=lambda r: (str(r["doc_id"]), r["n_chars"], r["edited_sha256"]))
    want.sort(key=lambda r: (str(r[0]), r[1], r[2]))
    assert [(r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got] == [w[:3] for w in want]
    for r, w in zip(got, want):
        exact = w[5] <= 60  # both sets fit in the sketch
        assert abs(r["near_edited"] - w[3]) <= (1e-9 if exact and w[5] else 0.2)
        assert abs(r["near_next"] - w[4]) <= 0.2
        assert len(r["fingerprint"]) == 8 * min(P.K, w[5])


def test_equal_texts_merge_and_estimates(spark):
    r = random.Random(1)
    words = [str(r.random()) for _ in range(4000)]
    a, b = " ".join(words[:2500]), " ".join(words[1500:])
    row = spark.createDataFrame([(a, b, " ".join(words))], "a string, b string, u string")
    s = {c: P.sketch(F.col(c)) for c in "abu"}
    got = row.select(
        P.resemblance(s["a"], s["b"]).alias("j"),
        P.containment(s["a"], s["u"]).alias("c"),
        P.distinct_shingles(s["u"]).alias("n"),
        (P.merged(s["a"], s["u"]) == s["u"]).alias("m"),
    ).first()
    assert abs(got["j"] - 0.25) < 0.13 and got["c"] > 0.85 and abs(got["n"] / 3996 - 1) < 0.3 and got["m"]


@pytest.mark.parametrize("rows", [[], [(5, "a b c d e f")], [(None, None)]])
def test_tiny_tables(spark, rows):
    got = P.op8_fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [(g["doc_id"], g["near_next"]) for g in got] == [(d, 1.0) for d, _ in rows]
