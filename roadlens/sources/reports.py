"""Reading position reports from text (SRC-1, PARSE-1, SCL-1..3).

The reference splits each line on ``,``, takes fields 0-7 and parses them with the strict
Java integer parsers; extra fields are ignored, anything malformed fails the job. The
``strict`` parser reproduces that with column expressions only (``split`` + a regex check +
``cast``), so it stays inside whole-stage codegen:

* each of the first 8 fields must be ``[+-]?[0-9]+`` (no blanks, no quotes) and fit its
  type (one anchored regex per line, then ANSI casts);
* fewer than 8 fields fails, 9 or more are accepted (extras ignored).

``on_error="quarantine"`` keeps going instead: good rows come back, bad lines can be read with
``bad_lines``. ``parser="csv"`` uses Spark's CSV reader (FAILFAST) -- faster, but it rejects
extra fields and skips blank lines.

Every reader adds ``seq``: the arrival order used to break ties of ``time``. It orders files by
path and the reports of a file by their place in it, whatever the file sizes, splits and cores
(see ``_with_arrival``).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.schema import REPORT_FIELDS, REPORT_SCHEMA

# A line is 8 comma-separated integers, optionally followed by more fields (ignored), as the
# reference's split-then-parse accepts; a trailing empty field after the 8th is fine too.
LINE_PATTERN = r"^[+-]?[0-9]+(,[+-]?[0-9]+){7}(,.*)?$"


def _checked(lines: DataFrame, line_col: str) -> tuple[DataFrame, list[str]]:
    """One regex test and one split per line (kept in their own projection)."""
    keep = [f"`{c}`" for c in lines.columns if c != line_col]
    staged = lines.selectExpr(
        *keep,
        f"`{line_col}` AS _line",
        f"coalesce(`{line_col}` RLIKE '{LINE_PATTERN}', FALSE) AS _ok",
        f"split(`{line_col}`, ',') AS _parts",
    )
    return staged, keep


def _field(i: int, type_name: str, cast: str = "CAST") -> str:
    return f"{cast}(try_element_at(_parts, {i + 1}) AS {type_name})"


def lines_to_reports(lines: DataFrame, on_error: str = "fail", line_col: str = "value") -> DataFrame:
    """Parse a DataFrame of text lines into the 8 report columns (other columns are kept).

    ``fail``: a malformed line or an out-of-range number fails the job (ANSI cast), like the
    reference, whichever columns are used. ``quarantine``: such lines are left out (see ``bad_lines``).
    """
    staged, keep = _checked(lines, line_col)
    types = [(f.name, f.dataType.simpleString()) for f in REPORT_SCHEMA.fields]
    if on_error == "fail":
        bad = "raise_error(concat('bad report line: ', coalesce(_line, '<null>')))"
        fields = ", ".join(f"'{n}', {_field(i, t)}" for i, (n, t) in enumerate(types))
        # one generator makes all eight: no column is parsed, and no row counted, without the others
        return staged.selectExpr(*keep, f"inline(CASE WHEN _ok THEN array(named_struct({fields})) ELSE {bad} END)")
    if on_error == "quarantine":
        fits = " AND ".join(f"{_field(i, t, 'TRY_CAST')} IS NOT NULL" for i, (_, t) in enumerate(types))
        return staged.where(f"_ok AND {fits}").selectExpr(
            *keep, *[f"{_field(i, t)} AS {n}" for i, (n, t) in enumerate(types)]
        )
    raise ValueError("on_error must be 'fail' or 'quarantine'")


def bad_lines(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """Lines the strict parser rejects (wrong shape, non-integers, overflow)."""
    staged, _ = _checked(lines, line_col)
    types = [f.dataType.simpleString() for f in REPORT_SCHEMA.fields]
    fits = " AND ".join(f"{_field(i, t, 'TRY_CAST')} IS NOT NULL" for i, t in enumerate(types))
    rejected = staged.where(f"NOT (_ok AND {fits})").select("_line")
    return rejected.withColumnRenamed("_line", line_col)


def marked_lines(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """Every line once: ``good`` (does the strict parser take it), ``line`` and the 8 report columns, which
    are null where ``good`` is false; other columns are kept. One pass for both sides of a quarantine."""
    staged, keep = _checked(lines, line_col)
    types = [(f.name, f.dataType.simpleString()) for f in REPORT_SCHEMA.fields]
    fits = " AND ".join(f"{_field(i, t, 'TRY_CAST')} IS NOT NULL" for i, (_, t) in enumerate(types))
    judged = staged.selectExpr(*keep, "_line", "_parts", f"_ok AND {fits} AS good")
    fields = [f"CASE WHEN good THEN {_field(i, t, 'TRY_CAST')} END AS {n}" for i, (n, t) in enumerate(types)]
    return judged.selectExpr(*keep, "_line AS line", "good", *fields)


def without_nulls(marked: DataFrame) -> DataFrame:
    """``marked_lines`` for a reader that knows no nulls: ``<null>`` for a missing line, 0 for a missing number."""
    return marked.na.fill("<null>", ["line"]).na.fill(0, list(REPORT_FIELDS))


FILE_BITS = 42  # `seq` = number of the file, then 42 bits for the place in it
BROADCAST_FILES = 200_000  # up to so many paths (some 30 MB) the table of files is broadcast


def _with_arrival(spark: SparkSession, df: DataFrame, place: str) -> DataFrame:
    """``df`` with ``seq``: the rank of the row's file by path, then ``place`` within the file."""
    # paths without an authority as `_metadata` writes them: file:/x, not file:///x
    files = sorted(re.sub("^([^:/]+):///+", r"\1:/", f) for f in df.inputFiles())
    if len(files) >= 1 << (63 - FILE_BITS):
        raise ValueError(f"more than {1 << (63 - FILE_BITS)} input files")
    cols = [f"`{c}`" for c in df.columns]
    placed = df.selectExpr(*cols, "_metadata.file_path AS _path", f"CAST({place} AS BIGINT) AS _place")
    if len(files) < 2:
        return placed.selectExpr("_place AS seq", *cols)
    ranks = spark.createDataFrame(list(enumerate(files)), "_rank long, _file string")
    ranks = F.broadcast(ranks) if len(files) <= BROADCAST_FILES else ranks
    lost = "raise_error(concat('unlisted input file ', _path))"
    rank = f"CASE WHEN _rank IS NULL THEN CAST({lost} AS BIGINT) ELSE _rank END"
    joined = placed.join(ranks, placed["_path"] == ranks["_file"], "left")
    return joined.selectExpr(f"shiftleft({rank}, {FILE_BITS}) + _place AS seq", *cols)


# The start of a line's split plus its row number in the task. Only the last split of a file can
# share a task with rows before it, and a split has fewer lines than bytes, so this grows
# along the file.
LINE_PLACE = "_metadata.file_block_start + (monotonically_increasing_id() & 8589934591)"


def read_reports(
    spark: SparkSession,
    path: str,
    parser: str = "strict",
    on_error: str = "fail",
) -> DataFrame:
    """Position reports at ``path``: header-less CSV text (``strict`` or ``csv`` parser) or a
    parquet table with the 8 report columns (``parquet``; its ``seq`` is kept if present)."""
    if parser == "strict":
        lines = _with_arrival(spark, spark.read.text(path), LINE_PLACE)
        return lines_to_reports(lines, on_error=on_error)
    if parser == "csv":
        if on_error != "fail":
            raise ValueError("parser='csv' has no quarantine; use parser='strict'")
        df = spark.read.schema(REPORT_SCHEMA).option("mode", "FAILFAST").csv(path)
        return _with_arrival(spark, df, LINE_PLACE)
    if parser == "parquet":
        # a columnar table of reports: typed columns, filters and pruning reach the scan
        df = spark.read.parquet(path)
        if "seq" not in df.columns:  # a deterministic place: filters still reach the scan
            df = _with_arrival(spark, df, "_metadata.row_index")
        seq = F.col("seq").cast("bigint")
        typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in REPORT_SCHEMA.fields]
        return df.select(seq.alias("seq"), *typed)
    raise ValueError("parser must be 'strict', 'csv' or 'parquet'")


def reports_to_lines(reports: DataFrame) -> DataFrame:
    """The inverse of the parser: one ``value`` text line per report (+ ``seq``)."""
    line = F.concat_ws(",", *[F.col(c).cast("string") for c in REPORT_FIELDS])
    keep = ["seq"] if "seq" in reports.columns else []
    return reports.select(*keep, line.alias("value"))
