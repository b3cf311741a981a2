"""URL filter: listed rules first, else a ratio of two character language models.

A rule is a host and a path prefix, ``example.net/en/``; it fits its host and all subdomains of
it if the URL's path starts with the rule's, and the longest fitting rule decides. The URLs
that rules decide teach the method: one variable-order Markov model of the accepted and one of
the rejected ones, over the code points of the whole URL and an end symbol. A symbol ``c`` after
the context ``h`` of up to ``ORDER`` symbols has the Witten-Bell probability::

    p(c | h) = (count(hc) + kinds(h) * p(c | h without its first symbol)) / (count(h) + kinds(h))

(``p(c | shorter h)`` where ``h`` was never seen; below the empty context all code points are
equally likely), so a symbol is judged by the longest contexts that have evidence. A URL's score is
the sum of the log ratios of its symbols divided by their number; it is allowed from the
threshold on. The threshold is calibrated: of the decided URLs, those whose md5 starts with 0, 1
or 2 are scored by models of the others, and the edge (a multiple of ``1 / BINS``) with the
highest sum of the two rates of right verdicts is taken, of equal ones the one nearest to 0.
Without decided URLs of both kinds among them the threshold is 0.

In Spark: every position gives one window of ``ORDER + 1`` symbols; windows are counted with
map-side combining, and the counts of all shorter contexts are sums over that table. Log ratios
are whole numbers of 2^-20, so sums do not depend on their order. Windows that hold
more than 1 / ``COMMON`` of all positions (hence fewer than ``COMMON``) are broadcast to the URLs;
all others, none of which is hot, are joined by a shuffle. No Python touches a row.

Edge cases: a null URL counts as empty (host and path empty, no rule, only its end symbol is
scored); without any decided URL every score is 0 and the verdict allow; repeated rows and null
or repeated page_ids are rows of their own; an empty table gives no rows. A URL is cut into
pieces of ``PIECE`` symbols, so very long ones cost time in proportion.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlens.llm.common import settle

RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))

ORDER = 4  # longest context
PIECE = 64  # symbols of a URL that are cut into windows at a time
SYMBOLS = 1_112_065  # Unicode scalar values and the end symbol
UNIT = 1 << 20  # log ratios are whole numbers of 1 / UNIT
BINS = 100  # thresholds are whole numbers of 1 / BINS
EDGE = 50 * BINS  # scores beyond +-50 count as 50 for the threshold
COMMON = 10_000  # at most so many windows are broadcast
KINDS = ("allow", "block", "allow_taught", "block_taught")  # all decided URLs; without the calibration's


def address(url: str = "url") -> tuple[Column, Column]:
    """Host (after the first ``://``, A-Z lowered) and path (up to ``?`` or ``#``) of a URL column."""
    rest = F.expr(f"CASE WHEN instr({url}, '://') > 0 THEN substring({url}, instr({url}, '://') + 3) ELSE '' END")
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def longest_rule(rules: Sequence[tuple[str, str]], host: str = "host", path: str = "path") -> Column:
    """The longest rule that fits ``host`` and ``path``, else null."""
    fits = []
    for _, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        at, _, below = rule.partition("/")
        here = (F.col(host) == at) | F.col(host).endswith(f".{at}")
        fits.append(F.when(here & F.col(path).startswith(f"/{below}"), F.lit(rule)))
    return F.coalesce(*fits, F.lit(None).cast("string"))


def _windows(rows: DataFrame, *keep: str) -> DataFrame:
    """One row ``keep, w`` per symbol of each URL and its end: the symbol behind its ``ORDER`` predecessors."""
    pieces = f"regexp_extract_all(concat(coalesce(url, ''), chr(3)), '(?s).{{1,{PIECE}}}', 0)"
    lead = f"transform(_p, (p, i) -> concat(CASE WHEN i = 0 THEN repeat(chr(2), {ORDER}) ELSE right(_p[i - 1], {ORDER}) END, p))"
    cut = f"transform(sequence(1, length(_p) - {ORDER}), i -> substring(_p, i, {ORDER + 1}))"
    pieced = rows.selectExpr(*keep, f"{pieces} AS _p").selectExpr(*keep, f"explode({lead}) AS _p")
    return pieced.selectExpr(*keep, f"explode({cut}) AS w")


def _counted(rows: DataFrame) -> DataFrame:
    """``w, n`` and the counts of ``KINDS`` per window."""
    taught = "CAST(NOT held AS INT)"
    marks = ["_row", "CAST(label = 'allow' AS INT) AS allow", "CAST(label = 'block' AS INT) AS block", f"{taught} AS taught"]
    at = _windows(rows.selectExpr("url", *marks), "allow", "block", "taught")
    sums = ["sum(allow)", "sum(block)", "sum(allow * taught)", "sum(block * taught)"]
    return at.groupBy("w").agg(F.count("*").alias("n"), *[F.expr(f"coalesce({s}, 0L) AS {k}") for s, k in zip(sums, KINDS)])


def _model(counted: DataFrame) -> DataFrame:
    """``w, n, ratio, ratio_taught`` of every window: log ratios in units of 1 / ``UNIT``."""
    lower = None
    for k in range(ORDER + 1):
        name = f"right(w, {k + 1})"
        grams = counted.groupBy(F.expr(name).alias("g")).agg(*[F.sum(c).alias(c) for c in KINDS])
        context = grams.groupBy(F.expr(f"substring(g, 1, {k})").alias("h"))
        context = context.agg(*[F.sum(c).alias(f"n_{c}") for c in KINDS], *[F.expr(f"count_if({c} > 0) AS t_{c}") for c in KINDS])
        full = grams.join(F.broadcast(context) if k == 0 else context, F.expr(f"substring(g, 1, {k}) = h"))
        if lower is None:
            less = {c: f"CAST(1 AS DOUBLE) / {SYMBOLS}" for c in KINDS}
        else:
            full = full.join(lower, F.expr("substring(g, 2) = s"))
            less = {c: f"l_{c}" for c in KINDS}
        p = {c: f"CASE WHEN n_{c} = 0 THEN {less[c]} ELSE ({c} + t_{c} * ({less[c]})) / (n_{c} + t_{c}) END" for c in KINDS}
        lower = full.selectExpr("g AS s", *[f"{p[c]} AS l_{c}" for c in KINDS])
    ratio = lambda a, b: f"CAST(floor((ln({a}) - ln({b})) * {UNIT}) AS BIGINT)"
    ratios = lower.selectExpr("s AS w", f"{ratio('l_allow', 'l_block')} AS ratio", f"{ratio('l_allow_taught', 'l_block_taught')} AS ratio_taught")
    return ratios.join(counted.select("w", "n"), "w")


def _scored(rows: DataFrame) -> DataFrame:
    """``_row, ratio, ratio_taught, symbols`` per row."""
    counted = settle(_counted(rows))
    model = settle(_model(counted))
    total = model.agg(F.sum("n")).first()[0] or 0
    often = F.col("n") * COMMON > total
    common = F.broadcast(model.where(often).drop("n"))
    at = _windows(rows, "_row")
    sums = [F.sum(c).alias(c) for c in ("ratio", "ratio_taught", "symbols")]
    near = at.join(common, "w").withColumn("symbols", F.lit(1)).groupBy("_row").agg(*sums)
    far = at.join(common.select("w"), "w", "left_anti").join(model.where(~often).drop("n"), "w")
    far = far.withColumn("symbols", F.lit(1)).groupBy("_row").agg(*sums)
    return near.unionByName(far).groupBy("_row").agg(*sums)


def _bin(ratio: str) -> str:
    return f"CAST(greatest(-{EDGE}, least({EDGE}, floor(CAST({ratio} AS DOUBLE) * {BINS} / (symbols * CAST({UNIT} AS DOUBLE))))) AS INT)"


def _threshold(judged: DataFrame) -> int:
    """The calibrated threshold, in bins; one row of at most 2 * EDGE + 1 reaches the driver."""
    bins = judged.where("held AND label IS NOT NULL").selectExpr(f"{_bin('ratio_taught')} AS b", "label")
    bins = bins.groupBy("b").agg(F.expr("count_if(label = 'allow') AS x"), F.expr("count_if(label = 'block') AS y"))
    before = "OVER (ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    whole = "OVER (ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
    # all edges behind the bin before and up to a bin's own divide alike
    nearest = f"greatest(coalesce(lag(b) OVER (ORDER BY b), -{EDGE + 1}) + 1, least(b, 0)) AS t"
    bins = bins.selectExpr("x", "y", nearest, f"sum(x) {whole} AS _x", f"sum(y) {whole} AS _y", f"coalesce(sum(x) {before}, 0L) AS _less", f"coalesce(sum(y) {before}, 0L) AS _right")
    big = lambda c: f"CAST({c} AS DECIMAL(19, 0))"
    right = f"{big('_x - _less')} * {big('_y')} + {big('_right')} * {big('_x')}"
    best = bins.where("_x > 0 AND _y > 0").orderBy(F.expr(right).desc(), F.abs("t"), "t").select("t").first()
    return best[0] if best else 0


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict, score, n_symbols, url`` per row of ``pages`` (``page_id``, ``url``)."""
    host, path = address()
    rows = pages.select("page_id", "url", F.monotonically_increasing_id().alias("_row"))
    rows = rows.withColumns({"host": host, "path": path}).withColumn("rule", longest_rule(rules))
    verdicts = F.create_map(*[F.lit(x) for verdict, rule in rules for x in (rule, verdict)]) if rules else F.lit(None).cast("map<string,string>")
    held = F.substring(F.md5("url"), 1, 1).isin("0", "1", "2")
    rows = settle(rows.withColumns({"label": F.try_element_at(verdicts, F.col("rule")), "held": F.coalesce(held, F.lit(False))}))
    judged = settle(rows.join(_scored(rows), "_row"))
    limit = _threshold(judged)
    verdict = f"CASE WHEN label IS NOT NULL THEN label WHEN {_bin('ratio')} >= {limit} THEN 'allow' ELSE 'block' END"
    score = f"CAST(ratio AS DOUBLE) / (symbols * CAST({UNIT} AS DOUBLE))"
    return judged.selectExpr("page_id", "host", "path", "rule", f"{verdict} AS verdict", f"{score} AS score", "symbols AS n_symbols", "url")


def accepted(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """``page_id, url`` of the allowed rows."""
    return judge_urls(pages, rules).where("verdict = 'allow'").select("page_id", "url")


def op11_url_model_ratio(pages: DataFrame) -> DataFrame:
    return judge_urls(pages).drop("url")


def _sql() -> str:
    host = "translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    fits, verdicts = "", ""
    for verdict, rule in sorted(RULES, key=lambda r: (-len(r[1]), r[1])):
        at, _, below = rule.partition("/")
        fits += f" WHEN (host = '{at}' OR ends_with(host, '.{at}')) AND starts_with(path, '/{below}') THEN '{rule}'"
        verdicts += f" WHEN '{rule}' THEN '{verdict}'"
    levels, less = "", {c: f"1::DOUBLE / {SYMBOLS}" for c in KINDS}
    for k in range(ORDER + 1):
        p = ", ".join(f"CASE WHEN n_{c} = 0 THEN {less[c]} ELSE ({c} + t_{c} * ({less[c]})) / (n_{c} + t_{c}) END AS l_{c}" for c in KINDS)
        join = "" if k == 0 else f"JOIN m{k - 1} ON substr(g, 2) = s"
        levels += f"""
g{k} AS MATERIALIZED (SELECT right(w, {k + 1}) g, {", ".join(f"sum({c}) {c}" for c in KINDS)} FROM counted GROUP BY 1),
h{k} AS (SELECT substr(g, 1, {k}) h, {", ".join(f"sum({c}) n_{c}, count(*) FILTER ({c} > 0) t_{c}" for c in KINDS)} FROM g{k} GROUP BY 1),
m{k} AS MATERIALIZED (SELECT g AS s, {p} FROM g{k} JOIN h{k} ON substr(g, 1, {k}) = h {join}),"""
        less = {c: f"l_{c}" for c in KINDS}
    bins = lambda r: f"CAST(greatest(-{EDGE}, least({EDGE}, floor({r}::DOUBLE * {BINS} / (symbols * {UNIT}::DOUBLE)))) AS INT)"
    return f"""WITH a AS (SELECT url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END rest, count(*) rows FROM pages GROUP BY url),
b AS (SELECT url, rows, {host} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM a),
c AS (SELECT *, CASE{fits} END AS rule FROM b),
u AS MATERIALIZED (SELECT *, CASE rule{verdicts} END AS label, coalesce(left(md5(url), 1) IN ('0', '1', '2'), FALSE) AS held,
                          repeat(chr(2), {ORDER}) || coalesce(url, '') || chr(3) AS line FROM c),
spots AS MATERIALIZED (SELECT url, rows, label, held, unnest(list_transform(range(1, length(line) - {ORDER} + 1), lambda i: substr(line, i, {ORDER + 1}))) AS w FROM u),
counted AS MATERIALIZED (SELECT w, coalesce(sum(rows) FILTER (label = 'allow'), 0) allow, coalesce(sum(rows) FILTER (label = 'block'), 0) block,
  coalesce(sum(rows) FILTER (label = 'allow' AND NOT held), 0) allow_taught, coalesce(sum(rows) FILTER (label = 'block' AND NOT held), 0) block_taught FROM spots GROUP BY w),{levels}
model AS (SELECT s AS w, floor((ln(l_allow) - ln(l_block)) * {UNIT}) ratio, floor((ln(l_allow_taught) - ln(l_block_taught)) * {UNIT}) ratio_taught FROM m{ORDER}),
scored AS (SELECT url, sum(ratio)::BIGINT ratio, sum(ratio_taught)::BIGINT ratio_taught, count(*) symbols FROM spots JOIN model USING (w) GROUP BY url),
judged AS MATERIALIZED (SELECT u.*, ratio, ratio_taught, symbols FROM u JOIN scored ON u.url IS NOT DISTINCT FROM scored.url),
hist AS (SELECT {bins("ratio_taught")} b, coalesce(sum(rows) FILTER (label = 'allow'), 0) x, coalesce(sum(rows) FILTER (label = 'block'), 0) y
         FROM judged WHERE held AND label IS NOT NULL GROUP BY 1),
cum AS (SELECT greatest(coalesce(lag(b) OVER (ORDER BY b), -{EDGE + 1}) + 1, least(b, 0)) b, sum(x) OVER () xs, sum(y) OVER () ys, coalesce(sum(x) OVER v, 0) less, coalesce(sum(y) OVER v, 0) rightly FROM hist
        WINDOW v AS (ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
best AS (SELECT coalesce((SELECT b FROM cum WHERE xs > 0 AND ys > 0 ORDER BY (xs - less) * ys + rightly * xs DESC, abs(b), b LIMIT 1), 0) t)
SELECT page_id, host, path, rule, coalesce(label, CASE WHEN {bins("ratio")} >= t THEN 'allow' ELSE 'block' END) AS verdict,
       ratio::DOUBLE / (symbols * {UNIT}::DOUBLE) AS score, symbols AS n_symbols
FROM pages JOIN judged ON pages.url IS NOT DISTINCT FROM judged.url, best"""


SQL = _sql()
