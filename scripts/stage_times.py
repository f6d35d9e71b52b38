"""Stage timings of one registered query from Spark's event log.

Usage: python scripts/stage_times.py <query> [sf_dir]
Runs the query twice (warm-up + measured) with the event log written to a
fresh scratch folder, then prints the measured run's stages.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main() -> None:
    key = sys.argv[1]
    sf = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    logdir = tempfile.mkdtemp(prefix="evlog-", dir="/tmp")
    from moodindex.plans import queries as Q
    from moodindex.session import get_session
    spark = get_session("local[8]", 8, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": logdir,
        "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false"})
    Q.QUERIES[key](spark, sf).collect()
    mark = int(time.time() * 1000)
    t0 = time.time()
    Q.QUERIES[key](spark, sf).collect()
    print(f"{key}: {time.time() - t0:.2f}s")
    spark.stop()
    rows = []
    for f in glob.glob(f"{logdir}/**", recursive=True):
        if os.path.isfile(f):
            for line in open(f, encoding="utf-8", errors="replace"):
                e = json.loads(line)
                if e.get("Event") == "SparkListenerStageCompleted":
                    si = e["Stage Info"]
                    if si["Submission Time"] >= mark:
                        rows.append((si["Submission Time"] - mark,
                                     si["Completion Time"] - si["Submission Time"],
                                     si["Stage ID"], si["Number of Tasks"], si["Stage Name"][:60]))
    for r in sorted(rows):
        print(f"start+{r[0]:6d}ms  {r[1]:6d}ms  stage {r[2]:4d}  tasks {r[3]:4d}  {r[4]}")


if __name__ == "__main__":
    main()
