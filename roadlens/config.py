"""Parameters of the three queries and of the hot-key splitting."""

from __future__ import annotations

from dataclasses import dataclass

# Fixed values that must equal the reference job for equal results, in the job's order:
#   speeding test          speed > 90
#   stretch of segments    52 .. 56 (inclusive)
#   session gap            31 seconds, applied to `time` read as milliseconds
#   report interval        30.0 seconds per report
#   m/s -> mph factor      2.23694
#   average speed test     avg_speed > 60
#   stopped test           4 reports in a row, sliding by 1
#   commented-out variant  sliding event-time window of 120 s every 30 s
SPEED_LIMIT = 90
STRETCH_LO = 52
STRETCH_HI = 56
SESSION_GAP_SECONDS = 31
REPORT_INTERVAL = 30.0
MPS_TO_MPH = 2.23694
AVG_SPEED_LIMIT = 60
STOP_REPORTS = 4
SLIDING_SIZE_SECONDS = 120
SLIDING_SLIDE_SECONDS = 30

UNIT_PER_SECOND = {"ms": 1000, "s": 1}


@dataclass(frozen=True)
class Params:
    """Query parameters, defaulting to the reference constants (as written: `time` in ms)."""

    speed_limit: int = SPEED_LIMIT
    lo_seg: int = STRETCH_LO
    hi_seg: int = STRETCH_HI
    gap_seconds: float = SESSION_GAP_SECONDS
    time_unit: str = "ms"
    interval: float = REPORT_INTERVAL
    factor: float = MPS_TO_MPH
    avg_limit: float = AVG_SPEED_LIMIT
    stop_reports: int = STOP_REPORTS

    @property
    def gap_units(self) -> int:
        """Session gap expressed in units of `time`."""
        return int(round(self.gap_seconds * UNIT_PER_SECOND[self.time_unit]))


@dataclass(frozen=True)
class SkewPolicy:
    """When and how one vehicle's reports are split over several tasks.

    Ordered per-vehicle operators (running max, sessions, count windows) would put every
    report of a vehicle into one task. A vehicle with more than ``hot_rows`` reports is a
    *hot key*: its reports are cut into contiguous time blocks of about ``block_rows``
    reports (boundaries at quantiles of its time, so bursts get more blocks), each block
    runs in its own task, and small per-block summaries stitch the blocks back together
    exactly. Hot keys are found on a sample (``sample_rows`` expected rows per hot key). The
    broadcast table of hot keys holds at most ``max_hot_keys`` keys and
    ``max_total_blocks`` boundaries; keys past that bound stay whole, still exact.
    ``enabled=False`` skips the statistics pass entirely.
    """

    enabled: bool = True
    hot_rows: int = 8_000_000  # a vehicle above this many reports is split (~0.3 GB of shuffle)
    block_rows: int = 2_000_000  # target reports per block of a split vehicle
    max_blocks: int = 16_384  # most blocks of one vehicle (<= 65536)
    max_hot_keys: int = 65_536  # most vehicles split; further ones stay whole (still exact)
    max_total_blocks: int = 1 << 20  # most blocks of all split vehicles: bounds the broadcast
    quantile_grid: int = 1024  # quantiles of time per split vehicle (block boundaries)
    sample_rows: int = 1000  # expected sampled rows of a key with hot_rows rows
    seed: int = 17

    def __post_init__(self):
        if not 1 <= self.max_blocks <= 1 << 16:
            raise ValueError("max_blocks must be in 1 .. 65536")


DEFAULT_SKEW = SkewPolicy()
