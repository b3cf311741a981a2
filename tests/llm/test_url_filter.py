"""URL filter: addresses, rules, and the whole query against its DuckDB text on small tables."""

import math
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from roadlens.llm import url_filter as U

SCHEMA = "page_id long, url string"


def addresses(spark, urls):
    host, path = U.address()
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], SCHEMA)
    df = df.withColumns({"host": host, "path": path}).withColumn("rule", U.longest_rule(U.RULES)).orderBy("page_id")
    return [(r.host, r.path, r.rule) for r in df.collect()]


def test_addresses_and_rules(spark):
    got = addresses(
        spark,
        [
            "http://WWW.Example.NET/en/A?x://y#z", "https://example.net/de/1", "http://a.example.com/de/", "https://xexample.com/de/1",
            "http://b.org/fr/x", "http://b.org/fr", "http://org/fr/", "http://c.net", "no scheme", None, "", "://", "x://h#f/en/", "http://éÀ.net/ü?q",
            "a://b://c/d", "http://example.network/", "http://my-example.net/en/9",
        ],
    )
    assert got == [
        ("www.example.net", "/en/A", "example.net/en/"), ("example.net", "/de/1", "net/"), ("a.example.com", "/de/", "example.com/de/"),
        ("xexample.com", "/de/1", None), ("b.org", "/fr/x", "org/fr/"), ("b.org", "/fr", None), ("org", "/fr/", "org/fr/"), ("c.net", "", None),
        ("", "", None), ("", "", None), ("", "", None), ("", "", None), ("h", "", None), ("éÀ.net", "/ü", "net/"),
        ("b:", "//c/d", None), ("example.network", "/", None), ("my-example.net", "/en/9", "net/"),
    ]


def model(lines, order=U.ORDER):
    """Witten-Bell by definition: log probability of a window's last symbol."""
    counts = defaultdict(Counter)
    for line, weight in lines:
        full = "\x02" * order + line + "\x03"
        for i in range(order, len(full)):
            for k in range(order + 1):
                counts[full[i - k : i]][full[i]] += weight

    def p(h, c, k):
        less = 1 / U.SYMBOLS if k == 0 else p(h[1:], c, k - 1)
        seen = counts.get(h)
        return less if not seen else (seen[c] + len(seen) * less) / (sum(seen.values()) + len(seen))

    return lambda w: math.log(p(w[:-1], w[-1], order))


def test_scores_follow_the_definition(spark):
    urls = ["http://a.net/x1", "http://b.net/yy", "http://b.org/fr/a", "http://b.org/fr/bé", "http://z.com/en/ab", None, "", "http://b.net/yy", "q" * 150]
    rows = spark.createDataFrame(list(enumerate(urls)), SCHEMA)
    got = {r.page_id: r for r in U.judge_urls(rows).collect()}
    verdict = {"net/": "block", "org/fr/": "allow"}
    allow = model([(urls[i], 1) for i, r in got.items() if verdict.get(r.rule) == "allow"])
    block = model([(urls[i], 1) for i, r in got.items() if verdict.get(r.rule) == "block"])
    for i, u in enumerate(urls):
        line = "\x02" * U.ORDER + (u or "") + "\x03"
        windows = [line[j : j + U.ORDER + 1] for j in range(len(line) - U.ORDER)]
        want = sum(math.floor((allow(w) - block(w)) * U.UNIT) for w in windows) / (len(windows) * U.UNIT)
        assert got[i].n_symbols == len(windows) and got[i].score == pytest.approx(want, abs=1e-5)
        assert got[i].verdict in ("allow", "block") and (got[i].rule is None or got[i].verdict == verdict[got[i].rule])


def run_sql(pages):
    con = duckdb.connect()
    con.register("p", pages.toArrow())
    con.execute("CREATE VIEW pages AS SELECT page_id, url FROM p")
    return sorted(map(repr, con.execute(f"SELECT page_id, host, path, rule, verdict, score, n_symbols FROM ({U.SQL})").fetchall()))


def test_equals_sql_with_rare_windows_shuffled(spark, smoke_dir, monkeypatch):
    pages = spark.read.parquet(f"{smoke_dir}/pages.parquet").select("page_id", "url")
    pages = pages.unionByName(pages.limit(5)).unionByName(spark.createDataFrame([(None, None), (7, ""), (7, "x" * 3000), (None, "http://q.org/\x02\x03\n")], SCHEMA))
    want = run_sql(pages)
    for common in (U.COMMON, 20, 1):
        monkeypatch.setattr(U, "COMMON", common)
        got = U.op11_url_model_ratio(pages).select("page_id", "host", "path", "rule", "verdict", "score", "n_symbols").collect()
        assert sorted(repr(tuple(r)) for r in got) == want


def test_method_separates_what_rules_do_not_decide(spark):
    """Rules taken away from a part of the hosts: the models still tell their URLs apart."""
    rows = [(i, f"http://shop{i % 40}.net/buy/cheap-pills-{i}") for i in range(200)] + [(200 + i, f"http://news{i % 40}.org/fr/article-{i}") for i in range(200)]
    rows += [(400 + i, f"http://other{i}.com/buy/cheap-pills-{i}") for i in range(50)] + [(450 + i, f"http://other{i}.com/fr/article-{i}") for i in range(50)]
    got = {r.page_id: r.verdict for r in U.judge_urls(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(got[400 + i] == "block" and got[450 + i] == "allow" for i in range(50))


def test_empty_clashing_and_undecided(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert U.op11_url_model_ratio(none).count() == 0
    clash = spark.createDataFrame([(1, "http://x.com/")], SCHEMA)
    clash = clash.withColumns({c: F.lit("x") for c in ("host", "path", "rule", "verdict", "w", "_row", "label", "held", "symbols", "score")})
    (row,) = U.op11_url_model_ratio(clash).collect()
    assert (row.host, row.path, row.rule, row.verdict, row.score) == ("x.com", "/", None, "allow", 0.0)
    assert U.accepted(clash).collect()[0].page_id == 1
    assert "Python" not in U.judge_urls(clash)._jdf.queryExecution().toString()
