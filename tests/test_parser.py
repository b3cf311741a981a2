
import os
import tempfile

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from roadlens.operators.speed_radar import speed_radar
from roadlens.operators.stopped import accident_reporter
from roadlens.sources.reports import bad_lines, lines_to_reports, read_reports
from roadlens.sources.sinks import write_csv
from tests.util import FIELDS, NO_SPLIT, collect, frame

GOOD = "1,2,3,4,5,6,7,8"
CASES = [
    (GOOD, (1, 2, 3, 4, 5, 6, 7, 8)),
    ("1,2,3,4,5,6,7,8,9", (1, 2, 3, 4, 5, 6, 7, 8)),
    ("1,2,3,4,5,6,7,8,", (1, 2, 3, 4, 5, 6, 7, 8)),
    ("+1,2,3,4,5,6,7,-8", (1, 2, 3, 4, 5, 6, 7, -8)),
    ("1,2,3,4,5,6,7", None),
    ("", None),
    ("time,vid,speed,xway,lane,dir,seg,pos", None),
    ("1,,3,4,5,6,7,8", None),
    ("1, 2,3,4,5,6,7,8", None),
    ("2147483648,2,3,4,5,6,7,8", None),
    ('"1",2,3,4,5,6,7,8', None),
    ("1,2,3,4,5,6,7,", None),
]


def _lines(spark, text):
    return spark.createDataFrame([(text,)], "value string")


@pytest.mark.parametrize("line,expected", CASES)
def test_strict_parser(spark, line, expected):
    parsed = lines_to_reports(_lines(spark, line))
    if expected is None:
        with pytest.raises(PySparkException):
            parsed.collect()
    else:
        assert [tuple(x) for x in parsed.collect()] == [expected]


@pytest.mark.parametrize("column", range(8))
def test_strict_whichever_columns_are_used(spark, column):
    fields = ["1", "2", "95", "4", "5", "6", "7", "8"]
    fields[column] = "99999999999999999999"
    reports = lines_to_reports(_lines(spark, ",".join(fields)).selectExpr("0L AS seq", "value"))
    for use in (reports.count, speed_radar(reports, policy=NO_SPLIT).collect,
                accident_reporter(reports, policy=NO_SPLIT).collect):
        with pytest.raises(PySparkException):
            use()


def test_quarantine(spark):
    lines = spark.createDataFrame([(c[0],) for c in CASES], "value string")
    good = collect(lines_to_reports(lines, on_error="quarantine"))
    assert good == sorted(c[1] for c in CASES if c[1] is not None)
    assert bad_lines(lines).count() == sum(c[1] is None for c in CASES)


def test_long_vid(spark):
    parsed = lines_to_reports(_lines(spark, "1,9223372036854775807,3,4,5,6,7,8"))
    assert parsed.first()["vid"] == 9223372036854775807


def test_csv_round_trip(spark):
    rows = [(30 * i, i % 3, 90 + i, 0, 1, i % 2, 50 + i, 5280 * i) for i in range(20)]
    df = frame(spark, rows)
    out = os.path.join(tempfile.mkdtemp(prefix="roadlens-test-"), "reports")
    write_csv(df.select(*FIELDS), out)
    with pytest.raises(PySparkException):
        write_csv(df.select(*FIELDS), out)  # refuses an existing target
    back = read_reports(spark, out)
    assert collect(back.drop("seq")) == sorted(rows)
    fast = read_reports(spark, out, parser="csv")
    assert collect(fast.drop("seq")) == sorted(rows)
    assert back.select(F.countDistinct("seq")).first()[0] == len(rows)


def test_arrival_order_over_files(spark):
    """Files by path, lines by place: neither file sizes nor splits matter."""
    folder = tempfile.mkdtemp(prefix="roadlens-test-")
    want = []
    for name, n in (("a.csv", 1), ("b.csv", 200), ("c.csv", 7)):
        lines = [f"5,1,{len(want) + i},0,0,0,52,1" for i in range(n)]
        want += range(len(want), len(want) + n)
        with open(os.path.join(folder, name), "w") as f:
            f.write("".join(x + "\n" for x in lines))
    for size in ("128m", "512b"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            for parser in ("strict", "csv"):
                rows = read_reports(spark, folder, parser=parser).select("seq", "speed").collect()
                assert [r["speed"] for r in sorted(rows)] == want
                assert len({r["seq"] for r in rows}) == len(want)
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_parquet_reports(spark):
    rows = [(30 * i, i % 3, 90 + i, 0, 1, i % 2, 50 + i, 5280 * i) for i in range(20)]
    df = frame(spark, rows)
    out = os.path.join(tempfile.mkdtemp(prefix="roadlens-test-"), "reports.parquet")
    df.write.parquet(out)
    back = read_reports(spark, out, parser="parquet")
    assert collect(back) == collect(df)
    df.drop("seq").write.parquet(out + "2")
    assert collect(read_reports(spark, out + "2", parser="parquet").drop("seq")) == sorted(rows)
