"""Hard negatives: residue products against whole numbers, the mining against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadlens.llm import hard_negatives as H
from roadlens.llm.residues import CHUNK, PRIMES, primes_for, product, residues

SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("size,d", [(3, 1), (256, 64), (5_000, CHUNK + 1), (10**6, 300), (2**24, 700), (2**28, 17)])
def test_products_are_exact(size, d):
    rnd = np.random.default_rng(d)
    a, b = (rnd.integers(-size, size + 1, (n, d)) for n in (7, 11))
    a[0], b[0], b[1] = size, size, -size  # the largest sums there can be
    bound = float(d) * size * size
    primes = primes_for(bound)
    want = a.astype(object) @ b.astype(object).T
    assert (product(residues(a.astype(float), primes), residues(b.astype(float), primes), primes) == want).all()


def test_few_primes_where_norms_are_small():
    assert len(primes_for(70_000)) == 2 and len(primes_for(2.0**62)) == len(PRIMES)
    with pytest.raises(ValueError):
        primes_for(2.0**80)


def brute(rows, positives=5, negatives=10, low=30, high=90):
    kept = []
    for i, (vec_id, vec, label) in enumerate(rows):
        if label is None or vec is None or any(x is None or not np.isfinite(x) for x in vec):
            continue
        if vec_id is not None and vec_id % 7 == 0:
            label = (label + 1) % 10
        kept.append((i, vec_id, label, [int(np.floor(256 * np.float64(np.float32(x)))) for x in vec]))
    out = []
    for i, vec_id, label, vec in kept:
        if vec_id is None or vec_id % 100:
            continue
        scored = [(-sum(x * y for x, y in zip(vec, v)), n is None, n or 0, j, n, lab) for j, n, lab, v in kept if j != i]
        scored.sort()
        for s, _, _, _, n, _ in [x for x in scored if x[5] == label][:positives]:
            inside = [x for x in scored if x[5] != label and low * -s <= 100 * -x[0] <= high * -s][:negatives]
            out += [(vec_id, n, r + 1, x[4], -s, -x[0]) for r, x in enumerate(inside)]
    return sorted(map(repr, out))


def run(spark, rows, partitions=3, **kw):
    df = spark.createDataFrame(rows, SCHEMA).repartition(partitions)
    return sorted(repr(tuple(r)) for r in H.op12_hard_negatives(df).collect())


def random_rows(seed, n, d, kinds=10):
    rnd = random.Random(seed)
    centre = [[rnd.gauss(0, 0.2) for _ in range(d)] for _ in range(kinds)]
    rows = []
    for i in range(n):
        label = rnd.randrange(kinds)
        rows.append((i * 10 if rnd.random() < 0.5 else i, [c + rnd.gauss(0, 0.15) for c in centre[label]], label))
    return rows


def test_random_rows_with_repeated_ids(spark):
    rows = random_rows(1, 400, 8)
    want = brute(rows)
    assert len(want) > 100 and run(spark, rows) == want


def test_ties_nulls_ragged_and_unusable_rows(spark):
    rows = [(i, [0.5, 0.25], i % 3) for i in range(0, 400, 2)] + [(100, [0.5, 0.25], 1), (100, [0.1, 0.0], 1)]
    rows += [(i, [0.3, 0.2], 4) for i in range(1, 60)]
    rows += [(None, [0.3, 0.2], 1), (None, [0.4, 0.2], 5), (700, None, 1), (800, [0.1, None], 1), (900, [float("nan"), 0.0], 2), (1000, [float("inf")], 2), (1100, [0.3], None)]
    rows += [(1200, [], 1), (1300, [0.0, 0.0], 2), (1400, [-0.5, -0.25], 3), (1500, [0.5], 1), (1600, [0.2, 0.1, 0.7], 1)]
    want = brute(rows)
    assert len(want) > 200 and run(spark, rows) == want


def test_large_components_need_more_primes(spark):
    rnd = random.Random(5)
    rows = [(i * 50, [rnd.uniform(-3e4, 3e4) for _ in range(40)], rnd.randrange(2)) for i in range(120)]
    assert run(spark, rows) == brute(rows)
    with pytest.raises(ValueError):
        run(spark, [(0, [1e30], 1), (1, [1e30], 2)])


def test_small_groups_and_batches(spark, monkeypatch):
    rows = random_rows(2, 300, 5)
    want = brute(rows)
    monkeypatch.setattr(H, "SCORES", 40)
    monkeypatch.setattr(H, "ROWS", 20)
    assert run(spark, rows) == want
    monkeypatch.setattr(H, "CELLS", 60)
    assert run(spark, rows) == want


def test_empty_and_clashing_columns(spark):
    assert H.op12_hard_negatives(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = random_rows(3, 120, 4)
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("id", "vec", "row", "part", "kind", "query", "slot", "score", "rank", "positives", "asked")})
    assert sorted(repr(tuple(r)) for r in H.op12_hard_negatives(df).collect()) == brute(rows)


def test_long_vectors(spark):
    rnd = random.Random(8)
    rows = [(i * 100, [rnd.uniform(-1, 1) for _ in range(5000)], i % 2) for i in range(12)]
    assert run(spark, rows) == brute(rows)
