"""roadlens: vehicle position-report analytics on Spark DataFrames and Structured Streaming.

Three questions over position reports ``(time, vid, speed, xway, lane, dir, seg, pos)``:

* speed radar      -- speeding reports with each vehicle's running maximum speed
* speed control    -- average speed of a vehicle across a stretch of segments within one session
* accident report  -- four consecutive reports of one vehicle at the same position

Every operator takes and returns a DataFrame; the public names are re-exported here.
"""

from roadlens.config import Params, SkewPolicy
from roadlens.functions.predicates import in_stretch, speeding
from roadlens.operators.speed_radar import running_max, speed_radar, speed_radar_final
from roadlens.operators.stopped import accident_reporter, count_window, stopped_sliding
from roadlens.operators.sessions import sessions, sessionize
from roadlens.operators.speed_control import average_speed_control, stretch_crossings
from roadlens.sources.reports import lines_to_reports, read_reports, reports_to_lines
from roadlens.sources.events_view import (
    load_reports,
    load_reports_and_policy,
    reports_and_policy,
    reports_from_events,
)
from roadlens.plans.blocks import checked_policy
from roadlens.plans.jobs import run_all, stream_all
from roadlens.operators.speed_control import session_endpoints
from roadlens.operators.stopped import count_window_firings
from roadlens.sources.sinks import write_csv
from roadlens.session import build_session, checkpoint_root

__all__ = [
    "Params",
    "SkewPolicy",
    "checked_policy",
    "count_window_firings",
    "load_reports",
    "load_reports_and_policy",
    "reports_and_policy",
    "run_all",
    "session_endpoints",
    "stream_all",
    "accident_reporter",
    "average_speed_control",
    "build_session",
    "checkpoint_root",
    "count_window",
    "in_stretch",
    "lines_to_reports",
    "read_reports",
    "reports_from_events",
    "reports_to_lines",
    "running_max",
    "sessionize",
    "sessions",
    "speed_radar",
    "speed_radar_final",
    "speeding",
    "stopped_sliding",
    "stretch_crossings",
    "write_csv",
]
