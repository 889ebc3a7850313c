"""Stage timings of one registered query, read from Spark's event log.

usage: python tools/stage_times.py <query> [sf_dir] [runs]

Runs the query ``runs`` times (default 2) with the event log written to a fresh scratch
folder, then prints, for the last run, each job's duration and its stages' durations,
task counts and shuffle bytes written. No UI or server is involved.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from spendlens.catalog.queries import QUERIES  # noqa: E402
from spendlens.session import local_session  # noqa: E402


def _lines(path: str):
    if path.endswith(".zstd"):
        import zstandard
        with open(path, "rb") as fh:
            yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh),
                                        encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as fh:
            yield from fh


def main() -> None:
    name = sys.argv[1]
    sf_dir = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    runs = int(sys.argv[3]) if len(sys.argv) > 3 else 2
    log_dir = tempfile.mkdtemp(prefix="spendlens-eventlog-")
    spark = local_session(8, shuffle_partitions=16,
                          extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir})
    marks = []
    for _ in range(runs):
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        marks.append((t0 * 1000, time.time() * 1000))
    spark.stop()

    stages, jobs = {}, {}
    for path in sorted(glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)):
        if os.path.isdir(path) or "appstatus" in path:
            continue
        for line in _lines(path):
            e = json.loads(line)
            kind = e.get("Event")
            if kind == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                written = sum(a.get("Value", 0) for a in si.get("Accumulables", [])
                              if a.get("Name") == "internal.metrics.shuffle.write.bytesWritten")
                stages[si["Stage ID"]] = (si.get("Completion Time", 0) - si.get("Submission Time", 0),
                                          si["Number of Tasks"], written, si["Stage Name"][:40])
            elif kind == "SparkListenerJobStart":
                jobs[e["Job ID"]] = [e["Submission Time"], None, e["Stage IDs"]]
            elif kind == "SparkListenerJobEnd" and e["Job ID"] in jobs:
                jobs[e["Job ID"]][1] = e["Completion Time"]
    start, end = marks[-1]
    print(f"{name}: last run {(end - start) / 1000:.2f} s, event log in {log_dir}")
    for jid in sorted(jobs):
        submitted, done, stage_ids = jobs[jid]
        if submitted < start or done is None:
            continue
        print(f"  job {jid}: +{(submitted - start) / 1000:.2f} s, {(done - submitted) / 1000:.2f} s")
        for sid in stage_ids:
            if sid in stages:
                dur, tasks, written, label = stages[sid]
                print(f"    stage {sid}: {dur / 1000:.2f} s, {tasks} tasks, "
                      f"{written / 1e6:.1f} MB shuffled  {label}")


if __name__ == "__main__":
    main()
