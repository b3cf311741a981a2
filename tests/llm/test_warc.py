"""WARC packages: round trips, and the ZIP reader against the standard library's writer."""

import base64
import hashlib
import io
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from roadlens.llm import warc, zipped

PAGES = "page_id long, url string, html string"


class Bytes:
    def __init__(self, raw):
        self.raw, self.size, self.ranges = raw, len(raw), []

    def read(self, offset, length):
        self.ranges.append((offset, length))
        return self.raw[offset : offset + length]


def pages(seed=1, n=60):
    r = random.Random(seed)
    bodies = ["", "<p>é\r\n\r\nWARC/1.1\r\n</p>", "x" * 5000] + ["".join(r.choice("ab<>\n\r\0é") for _ in range(r.randint(0, 300))) for _ in range(20)]
    rows = [(i * 31 % 997, r.choice([None, f"http://h/{i}?\r\nx: y", "http://é/"]), r.choice([None, *bodies])) for i in range(n)]
    return rows + [rows[4], rows[4], (5000, None, None)]


def brute(rows, least=0):
    raw = [(h or "").encode() for _, _, h in rows]
    last, count = {}, {}
    for (i, _, _), p in zip(rows, raw):
        last[p] = max(last.get(p, i), i)
        count[p] = count.get(p, 0) + 1
    out = []
    for (i, _, _), p in zip(rows, raw):
        again = len(p) >= least and i != last[p]
        out.append((i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "revisit" if again else "response", last[p] if again else None))
    return sorted(out, key=str)


def test_query_equals_brute_force(spark):
    rows = pages()
    frame = spark.createDataFrame(rows, PAGES).withColumn("_last", F.lit("clash")).withColumn("path", F.lit(1))
    assert sorted(map(tuple, warc.op4_warc_packages(frame).collect()), key=str) == brute(rows)


@pytest.mark.parametrize("zip64,least", [(False, 0), (True, 1000)])
def test_payloads_come_back_whole(spark, zip64, least):
    rows = pages(2)
    frame = spark.createDataFrame(rows, PAGES).repartition(3)
    root = warc.new_folder(spark)
    manifest = warc.write_packages(frame, root, least, zip64, package_bytes=2000)
    assert manifest.count() > 3
    got = warc.read_packages(manifest, root).collect()
    assert sorted(((g[0], g[1], g[2], g[3], g[4]) for g in got), key=str) == brute(rows, least)
    stored = {g["page_id"]: g["payload"] for g in got if g["record_type"] == "response"}
    payload = lambda g: stored[g["refers_to"]] if g["record_type"] == "revisit" else g["payload"]
    assert sorted((g["page_id"], bytes(payload(g))) for g in got) == sorted((i, (h or "").encode()) for i, _, h in rows)
    clean = lambda u: u and u.replace("\r", "%0D").replace("\n", "%0A")
    assert sorted((g["page_id"], str(g["url"])) for g in got) == sorted((i, str(clean(u))) for i, u, _ in rows)


def test_empty_table_and_null_ids(spark):
    assert warc.op4_warc_packages(spark.createDataFrame([], PAGES)).count() == 0
    got = warc.op4_warc_packages(spark.createDataFrame([(None, "u", "x"), (3, "u", "x")], PAGES)).collect()
    assert sorted((str(g["page_id"]), g["record_type"], g["refers_to"]) for g in got) == [("3", "response", None), ("None", "revisit", 3)]


@pytest.mark.parametrize("wide", [False, True])
def test_reader_follows_the_standard_librarys_archives(wide):
    data = {f"a/{i}é.bin": bytes([i]) * (i * 100) for i in range(5)}
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, body in data.items():
            with z.open(name, "w", force_zip64=wide) as f:
                f.write(body)
        z.comment = b"PK\x05\x06 not the end"
    source = Bytes(out.getvalue())
    assert {m.name: source.raw[m.offset : m.offset + m.size] for m in zipped.members(source)} == data
    mine = io.BytesIO()
    zipped.pack(mine, data.items(), zip64=wide)
    with zipfile.ZipFile(mine) as z:
        assert {n: z.read(n) for n in z.namelist()} == data and z.testzip() is None
    source = Bytes(mine.getvalue())
    assert {m.name: source.raw[m.offset : m.offset + m.size] for m in zipped.members(source)} == data


def test_only_the_asked_ranges_are_read():
    out = io.BytesIO()
    zipped.pack(out, [("big", b"x" * 1_000_000), ("small", b"y" * 10)])
    source = Bytes(out.getvalue())
    zipped.members(source)
    assert sum(n for _, n in source.ranges) < 70_000
    with pytest.raises(zipped.BadArchive):
        zipped.members(Bytes(b"no archive at all"))


def test_packages_are_read_in_as_many_tasks_as_their_bytes_ask_for(spark, monkeypatch):
    frame = spark.createDataFrame(pages(3), PAGES)
    root = warc.new_folder(spark)
    manifest = warc.write_packages(frame, root, package_bytes=2000)
    total = manifest.agg(F.sum("bytes")).first()[0]
    monkeypatch.setattr(warc, "TASK_BYTES", total // 5)
    records = warc.read_packages(manifest, root)
    assert records.rdd.getNumPartitions() >= 5
    assert records.count() == frame.count()
    empty = warc.write_packages(frame.limit(0), warc.new_folder(spark))
    assert warc.read_packages(empty, root).count() == 0
