"""Quality and toxicity: held-out accuracy, folds, edge cases; the CRF against all labellings."""

import itertools
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from roadlens.llm import boosting, crf, quality, stats, toxicity

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def tables(spark, folder=SF):
    return spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")


@pytest.mark.parametrize(
    "run,label,folds,held,limit,least",
    [(quality.op9_quality_classifier, "quality", 3, 1, 0.5, 0.95), (toxicity.op6_toxicity, "toxic", 4, 2, 0.3, 0.9)],
)
def test_held_out_accuracy_and_folds(spark, smoke_dir, run, label, folds, held, limit, least):
    docs, labels = tables(spark)
    rows = run(docs.withColumn("score", F.lit("clash")).withColumn("y", F.lit(1)), labels).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % folds == held)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= limit)
    known = {r["doc_id"]: r[label] for r in labels.collect()}
    judged = [r["predicted"] == known[r["doc_id"]] for r in rows if r["held_out"] and r["doc_id"] in known]
    assert len(judged) > 50 and np.mean(judged) >= least
    # held-out labels play no part
    turned = labels.withColumn(label, F.when(quality.held_out(F.col("doc_id"), folds, held), 1 - F.col(label)).otherwise(F.col(label)))
    again = {r["doc_id"]: r["score"] for r in run(docs, turned).collect()}
    assert all(abs(again[r["doc_id"]] - r["score"]) < 1e-9 for r in rows)


@pytest.mark.parametrize("run", [quality.op9_quality_classifier, toxicity.op6_toxicity])
def test_edge_cases(spark, run):
    docs = [(1, "a b c"), (2, None), (3, ""), (None, "a b"), (1, "a b c"), (4, "w " * 30_000), (5, "\n \t")]
    frame = spark.createDataFrame([(i, t, None, None, None) for i, t in docs], DOCS)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    some = spark.createDataFrame([(1, None, None), (4, 1, 1), (99, 0, 0), (None, 1, 1)], none.schema)
    for labels in (none, some):
        got = run(frame, labels).collect()
        assert sorted(str(g["doc_id"]) for g in got) == sorted(str(i) for i, _ in docs)
        assert all(0 <= g["score"] <= 1 for g in got)
    assert run(frame.limit(0), some).count() == 0


def test_samples_are_bounded_by_rows_and_bytes(spark):
    n = 50_000
    frame = spark.range(n).select(F.lit(1).cast("long").alias("doc_id"), F.concat(F.lit("words of row "), F.col("id") % (n // 2)).alias("text"))
    labels = spark.createDataFrame([(1, 1, 1), (2, 0, 0)], "doc_id long, quality int, toxic int")
    rows = toxicity._sample(frame, labels, 10, 1 << 20).collect()
    assert len(rows) == len({r["text"] for r in rows}) == 10 and {r["y"] for r in rows} == {1}
    assert sorted(rows) == sorted(toxicity._sample(frame.repartition(7), labels, 10, 1 << 20).collect())
    few = toxicity._sample(frame, labels, 10, 40).collect()
    assert 1 <= len(few) <= 3 and sum(len(r["text"]) for r in few) <= 40
    seen = []
    fit, quality.fit = quality.fit, lambda x, y: seen.append(len(y)) or fit(x, y)
    try:
        quality.train(frame, labels, sample=10)
    finally:
        quality.fit = fit
    assert seen == [10]


def test_lexicon_keeps_every_word_above_the_limit(spark):
    words = [f"bad{i:05d}" for i in range(60_000)]
    docs = [(i, " ".join(words) if i < 20 else f"fine {i} day") for i in range(60)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, int(i < 20)) for i, _ in docs], "doc_id long, quality int, toxic int")
    assert len(toxicity.learn(frame, labels).keys) >= len(words)


def test_spans_are_code_points(spark):
    bad = "é\U0001f600 ok vile, ok"
    docs = [(i, bad if i % 3 == 0 else f"fine {i} ok ok") for i in range(300)]
    labels = [(i, 1, int(i % 3 == 0)) for i in range(300)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = toxicity.op6_toxicity(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    for g in got:
        found = {bad[a:b] for a, b in zip(g["spans"][::2], g["spans"][1::2])} if g["doc_id"] % 3 == 0 else set()
        assert g["predicted"] == int(g["doc_id"] % 3 == 0) and ("vile" in found) == (g["doc_id"] % 3 == 0)


def test_crf_marginals_equal_all_labellings():
    r = np.random.default_rng(1)
    field = crf.Field(*(r.normal(size=3) for _ in range(3)), r.normal(size=(2, 2)))
    seq = np.array([[0, 1, 2, 1], [2, 2, -1, -1], [1, -1, -1, -1]])
    p, both, _ = crf.forward_backward(field, seq, True)
    for row, s in enumerate(seq):
        s = [x for x in s if x >= 0]
        score = {}
        for y in itertools.product((0, 1), repeat=len(s)):
            v = sum(y[t] * (field.own[s[t]] + field.before[s[t - 1] if t else 0] + field.after[s[t + 1] if t + 1 < len(s) else 0]) for t in range(len(s)))
            score[y] = np.exp(v + sum(field.turn[y[t], y[t + 1]] for t in range(len(s) - 1)))
        z = sum(score.values())
        for t in range(len(s)):
            assert abs(p[row, t] - sum(v for y, v in score.items() if y[t]) / z) < 1e-9
            if t:
                assert abs(both[row, t, 1, 0] - sum(v for y, v in score.items() if (y[t - 1], y[t]) == (1, 0)) / z) < 1e-9


@pytest.mark.parametrize("run", [1, 4, 64])
def test_marginals_cross_the_rows_of_a_text(run):
    r = np.random.default_rng(4)
    field = crf.Field(*(r.normal(size=3) for _ in range(3)), r.normal(size=(2, 2)))
    sizes = [0, 200, 1, 64, 65, 0, 128, 3, 0]
    bounds = np.append(0, np.cumsum(sizes))
    classes = r.integers(0, 3, bounds[-1]).astype(np.int8)
    p = crf.chain_marginals(field, classes, bounds, run)
    for x, y in zip(bounds, bounds[1:]):
        if y > x:
            assert np.allclose(p[x:y], crf.forward_backward(field, classes[None, x:y].astype(int))[0][0], atol=1e-12)
    assert len(crf.chain_marginals(field, classes[:0], np.array([0, 0]), run)) == 0


def test_marginals_do_not_depend_on_the_place_of_a_passage():
    field = crf.Field(np.array([-3.0, 1, 2]), np.array([-0.5, 0.7, 1]), np.array([-0.5, 0.7, 1]), np.array([[0.5, -1], [-1, 1.5]]))
    model = toxicity.Model(np.zeros(0, np.uint64), np.zeros(0, np.int8), np.zeros(1, bool), field, np.zeros(5))
    texts = [np.array([0] * at + [2, 1, 2, 1] + [0] * (300 - at), np.int8) for at in range(100, 170)]
    p = toxicity._marginals(model, np.concatenate(texts), np.arange(71) * 304)
    found = np.array([p[304 * i + at : 304 * i + at + 4] for i, at in enumerate(range(100, 170))])
    assert np.allclose(found, found[0], atol=1e-9)


def test_flat_trees_learn_an_interaction():
    r = np.random.default_rng(2)
    x = r.uniform(size=(4000, 5))
    y = ((x[:, 0] > 0.5) ^ (x[:, 3] > 0.3)).astype(float)
    model = boosting.fit(x[:3000], y[:3000])
    assert ((model.probability(x[3000:]) > 0.5) == y[3000:]).mean() > 0.97
    assert boosting.fit(x[:0], y[:0]).probability(x[:2]).tolist() == [0.5, 0.5]


def test_statistics_of_blocks_equal_those_of_single_texts():
    texts = ["a b", None, "", "UP up!! #$ |x|\nline\nline\n", "é" * 50 + " 1", "a,\n\nb, c. " * 4000, "\n"]
    whole = np.concatenate(list(stats.text_stats(pa.array(texts))))
    single = np.concatenate([next(stats.text_stats(pa.array([t], pa.string()))) for t in texts])
    assert np.allclose(whole, single) and not whole[[1, 2, 6]].any()
