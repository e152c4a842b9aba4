"""Job and stage times from a Spark event log (plain or zstd).

Usage: python tools/joblog.py <event-log-file-or-dir> [job-group ...]
Prints, per job group (bench.py sets one per query), the number of jobs,
their summed wall time and the slowest stages.
"""

from __future__ import annotations

import glob
import json
import os
import sys
from collections import defaultdict


def events(path: str):
    files = [path] if os.path.isfile(path) else sorted(glob.glob(f"{path}/**/events_*", recursive=True)
                                                       + glob.glob(f"{path}/**/*local-*", recursive=True))
    for f in files:
        if os.path.isdir(f) or os.path.basename(f).startswith(".") or "appstatus" in f:
            continue
        with open(f, "rb") as fh:
            if f.endswith(".zstd"):
                import zstandard
                text = zstandard.ZstdDecompressor().stream_reader(fh, read_across_frames=True).read()
            else:
                text = fh.read()
        for line in text.decode().splitlines():
            try:
                yield json.loads(line)
            except ValueError:
                continue


def main():
    path, groups = sys.argv[1], set(sys.argv[2:])
    jobs, stage_group, stage_ms = {}, {}, defaultdict(float)
    for e in events(path):
        ev = e.get("Event")
        if ev == "SparkListenerJobStart":
            g = e.get("Properties", {}).get("spark.jobGroup.id") or "-"
            jobs[e["Job ID"]] = [g, e["Submission Time"], None]
            for sid in e.get("Stage IDs", []):
                stage_group[sid] = g
        elif ev == "SparkListenerJobEnd" and e["Job ID"] in jobs:
            jobs[e["Job ID"]][2] = e["Completion Time"]
        elif ev == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            if "Completion Time" in info and "Submission Time" in info:
                stage_ms[(info["Stage ID"], info["Stage Name"][:40])] = (
                    info["Completion Time"] - info["Submission Time"])
    per = defaultdict(lambda: [0, 0.0])
    for g, start, end in jobs.values():
        if end is not None and (not groups or g in groups):
            per[g][0] += 1
            per[g][1] += (end - start) / 1000
    for g, (n, sec) in sorted(per.items(), key=lambda kv: -kv[1][1]):
        slow = sorted(((ms, name) for (sid, name), ms in stage_ms.items()
                       if stage_group.get(sid) == g), reverse=True)[:3]
        print(f"{g:36s} jobs={n:3d} wall={sec:7.2f}s  slowest stages: "
              + ", ".join(f"{name} {ms / 1000:.2f}s" for ms, name in slow))


if __name__ == "__main__":
    main()
