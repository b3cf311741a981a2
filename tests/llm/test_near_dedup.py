"""Near-duplicates against all pairs of full shingle sets."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadlens.llm import near_dedup as N
from roadlens.llm.components import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def sets(t, k):
    w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in re.findall(r"[^\x20\x09-\x0D]+", t or "")]
    return {tuple(w)} if 0 < len(w) < k else {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()


def brute(docs, k, percent=80):
    full = [sets(t, k) for _, t in docs]
    parent = list(range(len(docs)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            if full[i] and full[j] and 100 * len(full[i] & full[j]) >= percent * len(full[i] | full[j]):
                parent[root(i)] = root(j)
    lowest = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            lowest[root(i)] = min(d, lowest.get(root(i), d))
    return sorted(((d, len(full[i]), lowest.get(root(i)), d == lowest.get(root(i))) for i, (d, _) in enumerate(docs)), key=str)


def corpus(seed, n=120):
    r = random.Random(seed)
    word = lambda: r.choice("abcdefghij") + r.choice("klmnop") + r.choice(["", "é", "X", "."])
    docs = []
    for i in range(n):
        kind = r.random()
        if docs and kind < 0.6:
            w = re.split(r"(\s+)", r.choice(docs)[1] or "")
            for _ in range(r.choice([0, 1, 1, 2, 4])):
                if w:
                    w[r.randrange(len(w))] = word()
            text = "".join(w)
            text = text.upper() if r.random() < 0.1 else text
        else:
            text = r.choice([" ", ""]) + r.choice([" ", "\n", "\t "]).join(word() for _ in range(r.choice([1, 2, 4, 30, 60, 120])))
        docs.append((i * 7 % 1000, text))
    return docs + [(5000, None), (5001, ""), (5002, " \n"), (5003, None), docs[3], (docs[4][0], docs[9][1])]


@pytest.mark.parametrize("rows,bands", [(6, 45), (5, 5), (2, 1)])
def test_bands_take_minima_and_the_same_functions_maxima(rows, bands):
    found = np.sort(np.random.default_rng(3).integers(0, 1 << 63, 40, dtype=np.uint64))
    bounds, half = np.array([0, 15, 40]), (rows * bands + 1) // 2
    keys, _ = N._signatures(found, bounds, rows, bands)
    seeds = N.mix(np.arange(1, half + 1, dtype=N.U) * N.U(0xD1342543DE82EF95))
    for n, (x, y) in enumerate(zip(bounds, bounds[1:])):
        hashed = (found[x:y] ^ seeds[:, None]) * (seeds[:, None] | N.U(1))
        hashed ^= hashed >> N.U(32)
        values = np.concatenate([hashed.min(1), hashed.max(1)])[: rows * bands].reshape(bands, rows)
        for b in range(bands):
            h = np.array([b + 1], N.U)
            for v in values[b]:
                h = N.mix(h * N.U(0x9E3779B97F4A7C15) + v)
            assert keys[n, b] == h[0]


@pytest.mark.parametrize("k", [2, 5])
def test_components_equal_brute_force(spark, k):
    docs = corpus(k)
    frame = spark.createDataFrame([(i, t, "en", None, None) for i, t in docs], DOCS).withColumn("node", F.lit("clash"))
    got = sorted(map(tuple, N.near_duplicates(frame, k).collect()), key=str)
    want = brute(docs, k)
    assert [(d, n) for d, n, _, _ in got] == [(d, n) for d, n, _, _ in want]
    assert got == want


def test_null_ids_and_empty_table(spark):
    frame = spark.createDataFrame([(None, "a b c"), (4, "A b  c"), (None, "x y z"), (None, None)], "doc_id long, text string")
    got = sorted(map(tuple, N.near_duplicates(frame, 2).collect()), key=str)
    assert got == sorted([(None, 2, 4, False), (4, 2, 4, True), (None, 2, None, True), (None, 0, None, True)], key=str)
    assert N.near_duplicates(frame.limit(0), 2).count() == 0


def test_deduplicate_keeps_one_of_each_group(spark):
    docs = corpus(7)
    frame = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in docs], DOCS)
    kept = [(r["doc_id"], r["text"]) for r in N.deduplicate(frame, 2).collect()]
    rows = list(zip(docs, [d == c for d, _, c, _ in (next(x for x in brute(docs, 2) if x[0] == i[0] and x[1] == len(sets(i[1], 2))) for i in docs)]))
    want = {r for r, k in rows if k}
    assert sorted(set(kept), key=str) == sorted(want, key=str)
    assert len([x for x in kept if x[0] == docs[3][0]]) == len({x for x in kept if x[0] == docs[3][0]})
    assert [x for x in kept if x[0] in (5000, 5001, 5002, 5003)].__len__() == 4


def test_deduplicate_shared_and_null_ids(spark):
    a, b, c = ("".join(f"{x}{i} " for i in range(40)) for x in "abc")
    rows = [(1, a + "x"), (1, a + "y"), (2, a + "z"), (1, b), (None, c + "x"), (None, c + "y"), (None, c + "y"), (None, None), (None, ""), (5, "q")]
    kept = [(r["doc_id"], r["text"]) for r in N.deduplicate(spark.createDataFrame([(*x, "en", "s", 1) for x in rows], DOCS), 2).collect()]
    assert sorted((i, (t or "")[:2]) for i, t in kept if i is not None) == [(1, "a0"), (1, "b0"), (5, "q")]
    assert sorted((t or "")[:2] for i, t in kept if i is None) == ["", "", "c0"]


def test_components_of_chains_stars_and_cycles(spark):
    r = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(300, 301), (301, 302), (302, 300), (400, 400)]
    names = {n: r.randrange(1, 1 << 60) * r.choice([1, -1]) for e in edges for n in e}
    frame = spark.createDataFrame([(names[a], names[b]) for a, b in edges], "a long, b long")
    got = {r_["node"]: r_["component"] for r_ in components(frame).collect()}
    for group in (range(0, 41), range(100, 130), range(300, 303)):
        assert {got[names[i]] for i in group} == {min(names[i] for i in group)}


def test_parities_bound_the_difference():
    """Sets differ in at least as many shingles as parities, and in about as many while they are few."""
    r = np.random.default_rng(4)
    for size, apart in ((1, 0), (150, 20), (150, 60), (3000, 900)):
        every = np.unique(r.integers(0, 2**63, size + apart, dtype=np.uint64))
        x, y = every[: len(every) - apart // 2], every[apart - apart // 2 :]
        p = N._parities(np.concatenate([x, y]), np.array([0, len(x), len(x) + len(y)]))
        unequal = int(np.bitwise_count(p[0] ^ p[1]).sum())
        assert unequal <= apart and (apart - unequal) % 2 == 0
        assert apart > 100 or unequal >= apart - apart * apart / 256


def test_few_pairs_are_confirmed_in_a_group_just_below_the_limit(spark, monkeypatch):
    """120 texts that share 100 of 115 shingles, each pair with 100 of 130 (0.77): nearly no pair is compared in full."""
    common = " ".join(f"w{i}" for i in range(101))
    docs = [(i, common + "".join(f" d{i}x{j}" for j in range(15))) for i in range(120)]
    docs += [(500, common + "".join(f" d7x{j}" for j in range(14)))]
    tested = []
    confirmed = N.NearDuplicates._confirmed

    def counted(self, pairs):
        tested.append(pairs.count())
        return confirmed(self, pairs)

    monkeypatch.setattr(N.NearDuplicates, "_confirmed", counted)
    got = {r.doc_id: r.component_id for r in N.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), 2).collect()}
    assert got == {**{i: i for i in range(120)}, 500: 7}
    assert tested[-1] < 100
