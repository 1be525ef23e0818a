"""Summarise stage times from a Spark event log (no UI, no REST).

usage: python tools/stage_report.py <event-log file or folder> [top_n]
Run the job with spark.eventLog.enabled=true and spark.eventLog.dir=<scratch>.
"""

from __future__ import annotations

import json
import sys


def _lines(path: str):
    """Plain or zstd event log file, or a rolling event-log folder."""
    import glob
    import io
    import os
    files = sorted(glob.glob(os.path.join(path, "events_*"))) if os.path.isdir(path) else [path]
    for f in files:
        if f.endswith(".zstd"):
            import zstandard
            with open(f, "rb") as fh:
                reader = zstandard.ZstdDecompressor().stream_reader(fh)
                yield from io.TextIOWrapper(reader, encoding="utf-8")
        else:
            with open(f, encoding="utf-8") as fh:
                yield from fh


def main():
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    stages, jobs_desc = {}, {}
    recs: dict[int, list[int]] = {}
    for line in _lines(path):
        ev = json.loads(line)
        kind = ev.get("Event")
        if kind == "SparkListenerTaskEnd":
            m = ev.get("Task Metrics") or {}
            r = recs.setdefault(ev["Stage ID"], [0, 0, 0, 0])
            r[0] += (m.get("Input Metrics") or {}).get("Records Read", 0)
            r[1] += (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
            r[2] += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Records Written", 0)
            r[3] = max(r[3], m.get("Executor Run Time", 0))
        if kind == "SparkListenerStageCompleted":
            info = ev["Stage Info"]
            dur = (info.get("Completion Time", 0) or 0) - (info.get("Submission Time", 0) or 0)
            stages[info["Stage ID"]] = (dur, info["Number of Tasks"], info["Stage Name"][:70])
        elif kind == "SparkListenerJobStart":
            desc = (ev.get("Properties") or {}).get("spark.job.description", "")
            for sid in ev.get("Stage IDs", []):
                jobs_desc[sid] = desc
    by_query: dict[str, float] = {}
    for sid, (dur, _, _) in stages.items():
        by_query[jobs_desc.get(sid, "")] = by_query.get(jobs_desc.get(sid, ""), 0) + dur
    single = [(sid, v) for sid, v in stages.items() if v[1] == 1 and recs.get(sid, [0, 0, 0, 0])[1] > 10000]
    if single:
        print("single-task stages reading > 10k shuffled records:")
        for sid, (dur, _, _) in sorted(single, key=lambda x: -x[1][0])[:top]:
            print(f"  stage {sid} ({jobs_desc.get(sid, '')}): {dur / 1000:.2f} s, "
                  f"shuffle-read {recs[sid][1]}, shuffle-write {recs[sid][2]}")
    total = sum(d for d, _, _ in stages.values())
    print(f"{len(stages)} stages, {total / 1000:.1f} s summed stage time")
    for sid, (dur, tasks, name) in sorted(stages.items(), key=lambda x: -x[1][0])[:top]:
        inp, srd, swr, longest = recs.get(sid, [0, 0, 0, 0])
        print(f"{dur / 1000:7.2f} s  stage {sid:4d}  tasks {tasks:4d}  in {inp:>9}  shuffle-read {srd:>9}  "
              f"shuffle-write {swr:>9}  longest task {longest / 1000:.2f} s  {jobs_desc.get(sid, '')}")
    print("summed stage time by query:")
    for q, d in sorted(by_query.items(), key=lambda x: -x[1])[:top]:
        print(f"  {d / 1000:7.2f} s  {q}")


if __name__ == "__main__":
    main()
