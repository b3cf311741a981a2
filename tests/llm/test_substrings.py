"""Substring dedup against a dictionary of all windows."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadlens.llm import substrings as S
from roadlens.llm.words import find_words, word_hashes, windows

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def brute(docs, k=20):
    first = {}
    words = [(d, (t or "").encode().split()) for d, t in docs]
    for d, w in words:
        for a in range(len(w) - k + 1):
            key = (d is not None, d or 0, a)
            first[tuple(w[a : a + k])] = min(first.get(tuple(w[a : a + k]), key), key)
    out = []
    for d, w in words:
        gone = set()
        for a in range(len(w) - k + 1):
            if first[tuple(w[a : a + k])] != (d is not None, d or 0, a):
                gone.update(range(a, a + k))
        left = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(left).hexdigest()))
    return sorted(out, key=str)


def corpus(seed, n=80):
    r = random.Random(seed)
    word = lambda: r.choice(["a", "b", "é", "Of", "x1", "\xa0y"]) + r.choice("0123456789")
    passages = [" ".join(word() for _ in range(m)) for m in (19, 20, 21, 50)]
    docs = []
    for i in range(n):
        parts = [r.choice([" ", "\n"]).join(word() for _ in range(r.choice([0, 1, 10, 40])))]
        for _ in range(r.choice([0, 0, 1, 3])):
            parts += [r.choice(passages), " ".join(word() for _ in range(r.choice([0, 1, 5])))]
        if r.random() < 0.1:
            parts = [r.choice(docs)[1] if docs else ""]
        docs.append((i * 37 % 1009, "\t".join(parts)))
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_query_equals_brute_force(spark, seed):
    docs = corpus(seed) + [(2000, None), (2001, ""), (2002, "w " * 70), (2003, "w v " * 30), (None, "w " * 25), (2004, " \n")]
    docs += [docs[5], docs[5]]  # equal rows
    frame = spark.createDataFrame([(i, t, "en", None, None) for i, t in docs], DOCS).withColumn("tag", F.lit("clash")).withColumn("h", F.lit(1))
    assert sorted(map(tuple, S.op3_substring_dedup(frame).collect()), key=str) == brute(docs)


def test_texts_that_share_an_id(spark):
    a, b = " ".join(f"a{i}" for i in range(25)), " ".join(f"b{i}" for i in range(25))
    frame = spark.createDataFrame([(1, a), (1, b), (2, b + " " + a)], "doc_id long, text string")
    got = sorted((r["doc_id"], r["n_removed"]) for r in S.op3_substring_dedup(frame).collect())
    assert got == [(1, 0), (1, 0), (2, 50)]


def test_a_full_bit_table_changes_nothing(spark):
    docs = corpus(3)
    frame, tagged = S._tagged(spark.createDataFrame(docs, "doc_id long, text string"))
    few = lambda bits: {r["doc_id"]: sorted(r["starts"]) for r in S.repeated_windows(frame, tagged, bits=bits).collect()}
    assert few(11) == few(27) != {}


def test_salted_hot_windows_change_nothing(spark):
    frame, tagged = S._tagged(spark.createDataFrame(corpus(4), "doc_id long, text string"))
    few = lambda most: {r["doc_id"]: sorted(r["starts"]) for r in S.repeated_windows(frame, tagged, most=most).collect()}
    assert len(S.repeated_anchors(frame, most=1000)[1]) > 5 and len(S.repeated_anchors(frame, most=1)[1]) == 0
    assert few(1000) == few(1) != {}


def test_empty_table(spark):
    assert S.op3_substring_dedup(spark.createDataFrame([], DOCS)).count() == 0


def test_word_and_window_hashes_follow_the_words():
    r = random.Random(5)
    texts = ["".join(r.choice(["a", "b", " ", "\n", "é", "\x0b", "\x85"]) for _ in range(r.randint(0, 300))).encode() for _ in range(50)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.cumsum([0] + [len(t) for t in texts])
    s, e, bounds = find_words(data, offsets)
    words = [t.split() for t in texts]
    flat = [w for ws in words for w in ws]
    assert [data[a:b].tobytes() for a, b in zip(s, e)] == flat
    assert np.diff(bounds).tolist() == [len(w) for w in words]
    h = word_hashes(data, s, e)
    assert len(set(zip(flat, h.tolist()))) == len(set(flat)) == len(set(h.tolist()))
    got, first = windows(h, bounds, 3)
    want = [tuple(ws[i : i + 3]) for ws in words for i in range(len(ws) - 2)]
    assert len(want) == len(got) and len(set(zip(want, got.tolist()))) == len(set(want)) == len(set(got.tolist()))
