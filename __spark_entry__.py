"""

``entry(spark)`` runs the flagship query (accident reporter) on sf0.001. ``queries()`` holds
derives position reports from ``events`` with ``roadlens.sources.events_view``);

Two report views exist (see FIXTURES.md): view A (``time`` = seconds of ``ts`` since
2024-01-01, queried as written with the 31,000-unit session gap) and view B (``time`` on a
30 s cadence, queried with the 31 s gap and the 120 s / 30 s sliding window).

The ``stream_*`` entries run the Structured Streaming twins to completion over the same
reports, replayed as three time-ordered micro-batches from a fresh folder under
``spark.checkpoint.dir`` (``roadlens.streaming.runners``), and return the sink's contents;
their oracles are the batch queries' SQL. The ``*_mixed`` entries use view C, whose sessions only
the row-by-row fold decides. The ``job_*`` entries write the reports as text, run the whole
batch (``stream_job_*``: streaming) job on it and read its CSV output back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from roadlens.config import Params, SkewPolicy
from roadlens.operators.sessions import sessions
from roadlens.operators.speed_control import average_speed_control, stretch_crossings
from roadlens.operators.speed_radar import speed_radar, speed_radar_final
from roadlens.operators.stopped import accident_reporter, count_window_firings, stopped_sliding
from roadlens.functions.predicates import in_stretch, speeding
from roadlens.schema import ARRIVAL
from roadlens.sources.events_view import load_reports_and_policy, mixed_reports, spoiled_lines, unordered_reports
from roadlens.sources.reports import lines_to_reports, marked_lines, reports_to_lines, without_nulls

try:  # the corpus operators are an optional part: without their folders the rest stands alone
    import roadlens.llm.queries as _corpus
except ModuleNotFoundError as e:
    if not (e.name or "").startswith(("roadlens.llm", "corpus_pipeline")):
        raise
    _corpus = None

SMOKE_DIR = "/root/testdata/sf0.001"

AS_WRITTEN = Params()  # `time` read as milliseconds: gap 31,000 units
SECONDS = Params(time_unit="s")  # the intended reading: gap 31 s
SPLIT = SkewPolicy(hot_rows=40, block_rows=16)  # thresholds that cut even small vehicles into blocks


def entry(spark: SparkSession) -> DataFrame:
    reports, policy = load_reports_and_policy(spark, SMOKE_DIR)
    return accident_reporter(reports, policy=policy)


REPORT_COLS = ("seq", "time", "vid", "speed", "xway", "lane", "dir", "seg", "pos")


def _on(clock: str, build: Callable[[DataFrame, SkewPolicy], DataFrame]):
    """A query over the report view; the view's hot-key check on ``user_id`` (= ``vid``)
    is handed to the vehicle-keyed operators (see ``reports_and_policy``)."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        reports, policy = load_reports_and_policy(spark, sf_dir, clock=clock)
        return build(reports, policy)

    return query


def _parse_roundtrip(reports: DataFrame, _policy: SkewPolicy) -> DataFrame:
    return lines_to_reports(reports_to_lines(reports)).drop("seq")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from roadlens.plans.job_queries import job_query, stream_job_query
    from roadlens.streaming import runners

    A, B = "event", "cadence"
    return {
        "position_reports": _on(A, lambda r, p: r.select(*REPORT_COLS)),
        "position_reports_cadence": _on(B, lambda r, p: r.select(*REPORT_COLS)),
        "parse_reports": _on(A, _parse_roundtrip),
        "speeding_reports": _on(A, lambda r, p: speeding(r).select(*REPORT_COLS)),
        "stretch_reports": _on(A, lambda r, p: in_stretch(r).select(*REPORT_COLS)),
        "count_window_4_1": _on(A, lambda r, p: count_window_firings(r, policy=p)),
        "count_window_4_2": _on(A, lambda r, p: count_window_firings(r, 4, policy=p, slide=2)),
        "count_window_3_5": _on(A, lambda r, p: count_window_firings(r, 3, policy=p, slide=5)),
        "count_window_3_5_split": _on(A, lambda r, p: count_window_firings(r, 3, policy=SPLIT, slide=5)),
        "parse_quarantine": _on(A, lambda r, p: without_nulls(marked_lines(spoiled_lines(r)))),
        "accident_reporter": _on(A, lambda r, p: accident_reporter(r, policy=p)),
        "speed_radar": _on(A, lambda r, p: speed_radar(r, policy=p)),
        "speed_radar_final": _on(A, lambda r, p: speed_radar_final(r, policy=p)),
        "vehicle_sessions": _on(A, lambda r, p: sessions(in_stretch(r), AS_WRITTEN, policy=p)),
        "stretch_crossings": _on(A, lambda r, p: stretch_crossings(r, AS_WRITTEN, policy=p)),
        "average_speed_control": _on(A, lambda r, p: average_speed_control(r, AS_WRITTEN, policy=p)),
        "average_speed_control_fast": _on(
            A, lambda r, p: average_speed_control(r, AS_WRITTEN, exact=False, policy=p)
        ),
        "stretch_crossings_31s": _on(B, lambda r, p: stretch_crossings(r, SECONDS, policy=p)),
        "average_speed_control_31s": _on(B, lambda r, p: average_speed_control(r, SECONDS, policy=p)),
        "stretch_crossings_mixed": _on(A, lambda r, p: stretch_crossings(mixed_reports(r), AS_WRITTEN, policy=p)),
        "average_speed_control_mixed": _on(
            A, lambda r, p: average_speed_control(mixed_reports(r), AS_WRITTEN, policy=p)
        ),
        "average_speed_control_mixed_split": _on(
            A, lambda r, p: average_speed_control(mixed_reports(r), AS_WRITTEN, policy=SPLIT)
        ),
        "speed_radar_arrival": _on(A, lambda r, p: speed_radar(unordered_reports(r), policy=p, order=ARRIVAL)),
        "accident_reporter_arrival": _on(A, lambda r, p: accident_reporter(unordered_reports(r), policy=p, order=ARRIVAL)),
        "accident_reporter_arrival_split": _on(
            A, lambda r, p: accident_reporter(unordered_reports(r), policy=SPLIT, order=ARRIVAL)
        ),
        "job_speed_radar": job_query("SpeedRadar.csv"),
        "job_speed_control": job_query("AverageSpeedControl.csv"),
        "job_accidents": job_query("AccidentReporter.csv"),
        "stream_job_speed_control": stream_job_query("AverageSpeedControl.csv"),
        "accident_reporter_sliding": _on(B, lambda r, p: stopped_sliding(r, time_unit="s")),
        "stream_speed_radar": runners.stream_speed_radar_query,
        "stream_accident_reporter": runners.stream_accident_reporter_query,
        "stream_average_speed_control": runners.stream_average_speed_control_query,
        "stream_average_speed_control_mixed": runners.stream_average_speed_control_mixed_query,
        "stream_accident_reporter_sliding": runners.stream_accident_reporter_sliding_query,
        "stream_late_reports": runners.stream_late_reports_query,
        "stream_late_dropped": runners.stream_late_dropped_query,
        "stream_speed_radar_hot": runners.carried_radar_query(SPLIT),
        "stream_accident_reporter_hot": runners.carried_accident_query(SPLIT),
        "stream_count_window_4_2": runners.carried_count_window_query(4, 2),
        "stream_count_window_3_5_hot": runners.carried_count_window_query(3, 5, SPLIT),
        "stream_steps_back": runners.stream_steps_back_query,
        "stream_parse_quarantine": runners.stream_parse_quarantine_query,
    } | (_corpus.queries() if _corpus else {})


# ------------------------------------------------------------------------------------------
# DuckDB oracles
# ------------------------------------------------------------------------------------------

_TIME_A = "CAST(floor(epoch(ts)) - 1704067200 AS INT)"
_TIME_B = "CAST(30*rn + 300*(rn // 24) AS INT)"


def _pr(time_expr: str) -> str:
    return f"""
b AS (SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS INT) rn
      FROM events),
c AS (SELECT *, CAST(CASE WHEN user_id % 2 = 0 THEN (rn // 6)*3 + greatest(rn % 6 - 3, 0) ELSE rn END AS INT) step
      FROM b),
d AS (SELECT event_id AS seq, {time_expr} AS time, user_id AS vid, CAST(floor(value) AS INT) AS speed,
             CAST(user_id % 3 AS INT) AS xway, CAST(event_id % 5 AS INT) AS lane,
             CAST((user_id // 2) % 2 AS INT) AS dir,
             CAST(CASE WHEN (user_id // 2) % 2 = 0 THEN 51 + step % 7 ELSE 57 - step % 7 END AS INT) AS seg,
             step
      FROM c),
pr AS (SELECT seq, time, vid, speed, xway, lane, dir, seg,
              CAST(seg*800 + (step*37 + vid*53) % 800 AS INT) AS pos
       FROM d)"""


PR_A = _pr(_TIME_A)
PR_B = _pr(_TIME_B)

_COLS = "seq, time, vid, speed, xway, lane, dir, seg, pos"


def _sessions_sql(gap: int) -> str:
    return f"""
g AS (SELECT *, CASE WHEN time - lag(time) OVER (PARTITION BY vid ORDER BY time, seq) <= {gap}
                     THEN 0 ELSE 1 END brk
      FROM pr WHERE seg BETWEEN 52 AND 56),
h AS (SELECT *, sum(brk) OVER (PARTITION BY vid ORDER BY time, seq ROWS UNBOUNDED PRECEDING) sid FROM g)"""


def _crossings_sql(pr: str, gap: int, limit: str) -> str:
    return f"""WITH {pr},{_sessions_sql(gap)},
a AS (SELECT vid, sid, count(*) n,
        arg_min(struct_pack(t:=time, x:=xway, d:=dir, s:=seg, p:=pos),
                (CASE WHEN dir = 0 THEN pos ELSE -pos END, time, seq)) f,
        arg_min(struct_pack(t:=time, x:=xway, d:=dir, s:=seg, p:=pos),
                (CASE WHEN dir = 0 THEN -pos ELSE pos END, time, seq)) l
      FROM h GROUP BY vid, sid),
r AS (SELECT f.t AS time1, l.t AS time2, vid, f.x AS xway, f.d AS dir,
             (abs(f.p - l.p) / ((n - 1) * 30.0::DOUBLE)) * 2.23694::DOUBLE AS avg_speed
      FROM a WHERE (f.s = 52 AND l.s = 56) OR (f.s = 56 AND l.s = 52))
SELECT * FROM r {limit}"""


PR_C = f"""{PR_A.replace("pr AS (", "pa AS (")},
pr AS (SELECT seq, time, vid, speed, xway, lane, CAST(seq % 3 % 2 AS INT) AS dir,
              CAST(52 + (seq*7919 + vid) // 3 % 5 AS INT) AS seg, CAST((seq*7919 + vid*31) % 40000 AS INT) AS pos
       FROM pa)"""


_FOLD = """list_reduce(list(struct_pack(f:=e, l:=e) ORDER BY {order}), lambda a, r: CASE
          WHEN (r.f.d = 0 AND r.f.s <= a.f.s AND r.f.p < a.f.p) OR (r.f.d <> 0 AND r.f.s >= a.f.s AND r.f.p > a.f.p)
            THEN struct_pack(f:=r.f, l:=a.l)
          WHEN (r.f.d = 0 AND r.f.s >= a.l.s AND r.f.p > a.l.p) OR (r.f.d <> 0 AND r.f.s <= a.l.s AND r.f.p < a.l.p)
            THEN struct_pack(f:=a.f, l:=r.f)
          ELSE a END)"""
_FOLDED = """SELECT z.f.t AS time1, z.l.t AS time2, vid, z.f.x AS xway, z.f.d AS dir,
             (abs(z.f.p - z.l.p) / ((n - 1) * 30.0::DOUBLE)) * 2.23694::DOUBLE AS avg_speed
      FROM a WHERE (z.f.s = 52 AND z.l.s = 56) OR (z.f.s = 56 AND z.l.s = 52)"""


def _mixed_sql(limit: str) -> str:
    """The fold row by row; ``f`` and ``l`` are the entry and exit reports so far."""
    return f"""WITH {PR_C},{_sessions_sql(31000)},
row_ends AS (SELECT *, struct_pack(t:=time, x:=xway, d:=dir, s:=seg, p:=pos) e FROM h),
a AS (SELECT vid, sid, count(*) n,
        {_FOLD.format(order="time, seq")} z
      FROM row_ends GROUP BY vid, sid),
r AS ({_FOLDED})
SELECT * FROM r {limit}"""


def _late_sql(result: str, gap: int = 31) -> str:
    """Chunk by chunk: the reports of open sessions and the new ones are merged, then judged by their session."""
    from roadlens.streaming.runners import LATE_CHUNKS, arrival_chunk

    cols = "vid, time, seq, xway, dir, seg, pos, arrived"
    sql = f"""WITH {PR_B},
arr AS MATERIALIZED (SELECT *, CAST({arrival_chunk()} AS BIGINT) AS arrived FROM pr WHERE seg BETWEEN 52 AND 56)"""
    for b in range(LATE_CHUNKS):
        held = f" UNION ALL SELECT {cols} FROM s{b - 1} WHERE status = 'open'" if b else ""
        sql += f""",
a{b} AS (SELECT {cols} FROM arr WHERE arrived = {b}{held}),
g{b} AS (SELECT *, CASE WHEN time - lag(time) OVER (PARTITION BY vid ORDER BY time, seq) <= {gap} THEN 0 ELSE 1 END brk FROM a{b}),
h{b} AS (SELECT *, sum(brk) OVER (PARTITION BY vid ORDER BY time, seq ROWS UNBOUNDED PRECEDING) sid FROM g{b}),
e{b} AS (SELECT *, max(time) OVER (PARTITION BY vid, sid) + {gap} AS until FROM h{b}),
s{b} AS MATERIALIZED (SELECT *, CASE WHEN until <= (SELECT max(time) FROM arr WHERE arrived < {b}) THEN 'late'
                      WHEN until <= (SELECT max(time) FROM arr WHERE arrived <= {b}) THEN 'closed' ELSE 'open' END AS status FROM e{b})"""
    closed = " UNION ALL ".join(
        f"SELECT {b} AS b, * FROM s{b} WHERE status = 'closed'{' OR status = ' + chr(39) + 'open' + chr(39) if b == LATE_CHUNKS - 1 else ''}"
        for b in range(LATE_CHUNKS)
    )
    dropped = " UNION ALL ".join(f"SELECT * FROM s{b} WHERE status = 'late'" for b in range(LATE_CHUNKS))
    return sql + f""",
dropped AS ({dropped}),
fin AS (SELECT *, struct_pack(t:=time, x:=xway, d:=dir, s:=seg, p:=pos) e FROM ({closed})),
a AS (SELECT b, vid, sid, count(*) n, {_FOLD.format(order="arrived, seq")} z FROM fin GROUP BY b, vid, sid),
r AS ({_FOLDED})
{result}"""


def _steps_back_sql() -> str:
    from roadlens.streaming.runners import arrival_chunk

    return f"""WITH {PR_B},
arr AS (SELECT time, seq, CAST({arrival_chunk()} AS INT) AS batch FROM pr),
o AS (SELECT batch, time, max(time) OVER (ORDER BY batch, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM arr)
SELECT count(*) FILTER (WHERE time < before) AS steps_back, count(*) AS reports, batch FROM o GROUP BY batch"""


_FIELDS = {"time": "INT", "vid": "BIGINT", "speed": "INT", "xway": "INT", "lane": "INT", "dir": "INT", "seg": "INT", "pos": "INT"}
_READ = {n: f"TRY_CAST(ltrim(split_part(line, ',', {i + 1}), '+') AS {t})" for i, (n, t) in enumerate(_FIELDS.items())}
_QUARANTINE = f"""WITH {PR_A},
l AS (SELECT seq, concat_ws(',', {', '.join(_FIELDS)}) AS l, substr(l, instr(l, ',')) AS rest FROM pr),
s AS (SELECT seq, CASE seq % 16
        WHEN 1 THEN l || ',9' WHEN 2 THEN l || ',' WHEN 3 THEN '+' || l
        WHEN 4 THEN regexp_extract(l, '^([^,]*,){{6}}[^,]*') WHEN 5 THEN '' WHEN 6 THEN 'time,vid,speed,xway,lane,dir,seg,pos'
        WHEN 7 THEN '1,' || rest WHEN 8 THEN ' ' || l WHEN 9 THEN '2147483648' || rest
        WHEN 10 THEN '"1"' || rest WHEN 11 THEN regexp_extract(l, '^([^,]*,){{7}}') WHEN 12 THEN NULL
        ELSE l END AS line FROM l),
g AS (SELECT *, coalesce(regexp_full_match(line, '[+-]?[0-9]+(,[+-]?[0-9]+){{7}}(,.*)?'), FALSE)
             AND {' AND '.join(f'{e} IS NOT NULL' for e in _READ.values())} AS good FROM s)
SELECT seq, coalesce(line, '<null>') AS line, good,
       {', '.join(f'CASE WHEN good THEN {e} ELSE 0 END AS {n}' for n, e in _READ.items())} FROM g"""


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL per query name (same column names and types as the Spark result)."""
    q1 = f"""WITH {PR_A}
SELECT first_value(time) OVER w AS time, vid, first_value(xway) OVER w AS xway,
       first_value(seg) OVER w AS seg, first_value(dir) OVER w AS dir, max(speed) OVER w AS max_speed
FROM pr WHERE speed > 90
WINDOW w AS (PARTITION BY vid ORDER BY time, seq ROWS UNBOUNDED PRECEDING)"""
    q1_final = f"""WITH {PR_A},
a AS (SELECT vid, max(speed) AS max_speed,
             arg_min(struct_pack(t:=time, x:=xway, s:=seg, d:=dir), (time, seq)) AS f
      FROM pr WHERE speed > 90 GROUP BY vid)
SELECT f.t AS time, vid, f.x AS xway, f.s AS seg, f.d AS dir, max_speed FROM a"""
    cw = f"""WITH {PR_A}
SELECT vid, first_value(time) OVER w AS time1, time AS time2, count(*) OVER w AS n,
       first_value(pos) OVER w AS pos1, pos AS pos2
FROM pr WINDOW w AS (PARTITION BY vid ORDER BY time, seq ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)"""
    q3 = f"""WITH {PR_A},
h AS (SELECT *, count(*) OVER w n, min(pos) OVER w mn, max(pos) OVER w mx, first_value(time) OVER w t1,
             first_value(xway) OVER w fx, first_value(seg) OVER w fs, first_value(dir) OVER w fd
      FROM pr WINDOW w AS (PARTITION BY vid ORDER BY time, seq ROWS BETWEEN 3 PRECEDING AND CURRENT ROW))
SELECT t1 AS time1, time AS time2, vid, fx AS xway, fs AS seg, fd AS dir, pos FROM h WHERE n = 4 AND mn = mx"""
    slid = lambda size, slide: f"""WITH {PR_A},
w AS (SELECT vid, first_value(time) OVER w AS time1, time AS time2, count(*) OVER w AS n,
             first_value(pos) OVER w AS pos1, pos AS pos2, row_number() OVER (PARTITION BY vid ORDER BY time, seq) AS k
      FROM pr WINDOW w AS (PARTITION BY vid ORDER BY time, seq ROWS BETWEEN {size - 1} PRECEDING AND CURRENT ROW))
SELECT vid, time1, time2, n, pos1, pos2 FROM w WHERE k % {slide} = 0"""  # noqa: E731
    sess = f"""WITH {PR_A},{_sessions_sql(31000)}
SELECT vid, min(time) AS session_start, max(time) AS session_end, count(*) AS n FROM h GROUP BY vid, sid"""
    sliding = f"""WITH {PR_B},
w AS (SELECT pr.*, time - ((time % 30 + 30) % 30) - k * 30 AS ws FROM pr, range(0, 4) r(k)),
x AS (SELECT *, first_value(pos) OVER (PARTITION BY vid, ws ORDER BY time, seq) AS fp FROM w),
y AS (SELECT vid, ws, count(*) FILTER (WHERE pos = fp) AS same, max(time) AS t2,
             arg_min(struct_pack(t:=time, x:=xway, s:=seg, d:=dir, p:=pos), (time, seq)) AS f
      FROM x GROUP BY vid, ws)
SELECT f.t AS time1, t2 AS time2, vid, f.x AS xway, f.s AS seg, f.d AS dir, f.p AS pos FROM y WHERE same = 4"""
    avg_a = _crossings_sql(PR_A, 31000, "WHERE avg_speed > 60")
    arrival = lambda sql: sql.replace("event_id AS seq", "(1048576 - event_id // 1024) * 1099511627776 + event_id % 1024 AS seq").replace(
        "ORDER BY time, seq", "ORDER BY seq"
    )
    return {
        "position_reports": f"WITH {PR_A} SELECT {_COLS} FROM pr",
        "position_reports_cadence": f"WITH {PR_B} SELECT {_COLS} FROM pr",
        "parse_reports": f"WITH {PR_A} SELECT time, vid, speed, xway, lane, dir, seg, pos FROM pr",
        "speeding_reports": f"WITH {PR_A} SELECT {_COLS} FROM pr WHERE speed > 90",
        "stretch_reports": f"WITH {PR_A} SELECT {_COLS} FROM pr WHERE seg BETWEEN 52 AND 56",
        "count_window_4_1": cw,
        "count_window_4_2": slid(4, 2),
        "count_window_3_5": slid(3, 5),
        "count_window_3_5_split": slid(3, 5),
        "parse_quarantine": _QUARANTINE,
        "accident_reporter": q3,
        "speed_radar": q1,
        "speed_radar_final": q1_final,
        "vehicle_sessions": sess,
        "stretch_crossings": _crossings_sql(PR_A, 31000, ""),
        "average_speed_control": avg_a,
        "average_speed_control_fast": avg_a,
        "stretch_crossings_31s": _crossings_sql(PR_B, 31, ""),
        "average_speed_control_31s": _crossings_sql(PR_B, 31, "WHERE avg_speed > 60"),
        "stretch_crossings_mixed": _mixed_sql(""),
        "average_speed_control_mixed": _mixed_sql("WHERE avg_speed > 60"),
        "average_speed_control_mixed_split": _mixed_sql("WHERE avg_speed > 60"),
        "speed_radar_arrival": arrival(q1),
        "accident_reporter_arrival": arrival(q3),
        "accident_reporter_arrival_split": arrival(q3),
        "job_speed_radar": q1,
        "job_speed_control": avg_a,
        "job_accidents": q3,
        "stream_job_speed_control": avg_a,
        "accident_reporter_sliding": sliding,
        "stream_speed_radar": q1,
        "stream_accident_reporter": q3,
        "stream_average_speed_control": avg_a,
        "stream_average_speed_control_mixed": _mixed_sql("WHERE avg_speed > 60"),
        "stream_accident_reporter_sliding": sliding,
        "stream_late_reports": _late_sql("SELECT * FROM r WHERE avg_speed > 60"),
        "stream_late_dropped": _late_sql("SELECT vid, time, seq, arrived FROM dropped"),
        "stream_speed_radar_hot": q1,
        "stream_accident_reporter_hot": q3,
        "stream_count_window_4_2": slid(4, 2),
        "stream_count_window_3_5_hot": slid(3, 5),
        "stream_steps_back": _steps_back_sql(),
        "stream_parse_quarantine": _QUARANTINE,
    } | (_corpus.oracle_sql() if _corpus else {})
