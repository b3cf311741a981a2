"""SRC-2: the command line writes the three outputs (run as its own process)."""

import os
import subprocess
import sys
import tempfile

from roadlens.sources.events_view import load_reports
from roadlens.sources.reports import reports_to_lines

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_cli_batch(spark, smoke_dir):
    base = tempfile.mkdtemp(prefix="roadlens-test-")
    reports_to_lines(load_reports(spark, smoke_dir)).orderBy("seq").coalesce(1).select("value").write.text(
        f"{base}/in"
    )
    done = subprocess.run(
        [sys.executable, "-m", "roadlens.cli", f"{base}/in", f"{base}/out", "--master", "local[2]"],
        cwd=ROOT, capture_output=True, text=True, timeout=600,
    )
    assert done.returncode == 0, done.stderr[-2000:]
    counts = {}
    for name in ("SpeedRadar.csv", "AverageSpeedControl.csv", "AccidentReporter.csv"):
        folder = f"{base}/out/{name}"
        counts[name] = sum(
            sum(1 for _ in open(os.path.join(folder, f))) for f in os.listdir(folder) if f.startswith("part-")
        )
    assert counts == {"SpeedRadar.csv": 167, "AverageSpeedControl.csv": 6, "AccidentReporter.csv": 93}
