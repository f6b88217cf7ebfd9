"""Summarise a Spark event log per job description: stage time, tasks, single-task stages.

Usage: python tools/stage_report.py <event log dir>
"""

import glob
import io
import json
import sys
from collections import defaultdict

import zstandard


def events(path):
    for f in sorted(glob.glob(path.rstrip("/") + "/**/events_*", recursive=True)):
        raw = open(f, "rb").read()
        text = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read().decode() if f.endswith(".zstd") else raw.decode()
        for line in text.splitlines():
            if line.strip():
                yield json.loads(line)


def main():
    stage_desc, stages = {}, {}
    for e in events(sys.argv[1]):
        ev = e.get("Event")
        if ev == "SparkListenerJobStart":
            desc = (e.get("Properties") or {}).get("spark.job.description", "?")
            for sid in e.get("Stage IDs", []):
                stage_desc[sid] = desc
        elif ev == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            stages[si["Stage ID"]] = ((si.get("Completion Time", 0) - si.get("Submission Time", 0)) / 1000, si["Number of Tasks"])
    per = defaultdict(lambda: [0.0, 0, 0.0, 0])
    for sid, (dur, n) in stages.items():
        p = per[stage_desc.get(sid, "?")]
        p[0] += dur
        p[1] += 1
        if n == 1:
            p[2] += dur
            p[3] += 1
    print(f"{'query':28s} {'stage s':>8s} {'stages':>6s} {'1-task s':>9s} {'1-task':>6s}")
    for q, (t, n, t1, n1) in sorted(per.items(), key=lambda kv: -kv[1][0]):
        print(f"{q[:28]:28s} {t:8.2f} {n:6d} {t1:9.2f} {n1:6d}")


if __name__ == "__main__":
    main()
