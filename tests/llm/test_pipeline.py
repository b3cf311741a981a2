"""The pipeline's stages against brute force, each on the rows its predecessor kept."""

import corpus_pipeline as P
import duckdb
import pytest
from pyspark.sql import functions as F

from roadlens.llm import mixing, quality
from tests.llm.test_decontaminate import brute as passages
from tests.llm.test_mixing_sharding import check_law
from tests.llm.test_near_dedup import brute as groups

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, smoke_dir, tmp_path_factory):
    root = tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for i, (name, f) in enumerate(P.STAGES):
        f(spark, docs, SF).write.parquet(str(root / name))
        out.append((docs, new := spark.read.parquet(str(root / name))))
        docs = new
    return out


def test_order_and_columns(stages):
    assert [n for n, _ in P.STAGES] == ["quality", "near_dedup", "decontaminate", "mix", "shard"]
    columns = stages[0][0].columns
    assert [after.columns for _, after in stages] == [columns] * 4 + [columns + ["shard", "slot"]]


def test_quality_keeps_accepted_rows(spark, stages):
    before, after = stages[0]
    accepted = quality.op9_quality_classifier(before, spark.read.parquet(f"{SF}/labels.parquet")).where("predicted = 1")
    assert sorted(after.collect()) == sorted(before.join(accepted.select("doc_id"), "doc_id", "left_semi").collect())


def test_near_duplicates_leave_one_of_each_group(stages):
    before, after = stages[1]
    want = {d for d, _, _, kept in groups([(r["doc_id"], r["text"]) for r in before.collect()], 5) if kept}
    assert {r["doc_id"] for r in after.collect()} == want and after.count() == len(want)


def test_no_benchmark_passage_stays_and_clean_texts_do(spark, stages):
    before, after = stages[2]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    found = {d: (n, hit) for d, n, hit, *_ in passages([(r["doc_id"], r["text"]) for r in before.collect()], items)}
    left = {r["doc_id"]: r for r in after.collect()}
    assert set(left) == {d for d, (n, hit) in found.items() if hit <= 0.5 * n}
    for r in before.collect():
        if r["doc_id"] in left and not found[r["doc_id"]][1]:
            assert left[r["doc_id"]] == r
    assert not any(bad for *_, bad in passages([(d, r["text"]) for d, r in left.items()], items))


def test_mixture_repeats_as_sql_says(stages):
    before, after = stages[3]
    documents = before.toPandas()  # noqa: F841
    want = {d: taken // size for d, size, _, _, taken in duckdb.connect().execute(mixing.SQL).fetchall() if size}
    got = {r["doc_id"]: r["n"] for r in after.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert {d: n for d, n in want.items() if n} == {d: n for d, n in got.items() if d in want}


def test_shards(stages):
    before, after = stages[4]
    check_law(after.collect(), 40)
    assert sorted(after.drop("shard", "slot").collect()) == sorted(before.collect())


def test_run_equals_the_stages(spark, stages):
    assert sorted(P.run(spark, SF).collect()) == sorted(stages[-1][1].collect())
