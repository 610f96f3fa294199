"""Summarise a Spark event log: stages by wall time, tasks and input rows.

Run a job with ``spark.eventLog.enabled=true`` and ``spark.eventLog.dir``
pointing to a scratch folder, then:

    python tools/eventlog_summary.py <event-log dir or file> [top]
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def _lines(path: str):
    if path.endswith(".zstd"):
        import zstandard
        with open(path, "rb") as fh:
            yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as fh:
            yield from fh


def stages(path: str) -> dict[int, tuple[float, int, int, str]]:
    if os.path.isdir(path):
        inner = sorted(glob.glob(os.path.join(path, "eventlog_v2_*")), key=os.path.getmtime)
        base = inner[-1] if inner else path
        files = sorted(glob.glob(os.path.join(base, "events_*"))) or [base]
    else:
        files = [path]
    out = {}
    for f in files:
        for line in _lines(f):
            e = json.loads(line)
            if e.get("Event") != "SparkListenerStageCompleted":
                continue
            si = e["Stage Info"]
            rows = next((a.get("Value") for a in si.get("Accumulables", [])
                         if a.get("Name") == "internal.metrics.input.recordsRead"), 0)
            dur = (si.get("Completion Time", 0) - si.get("Submission Time", 0)) / 1000
            out[si["Stage ID"]] = (round(dur, 2), si["Number of Tasks"], rows, si["Stage Name"][:60])
    return out


def main() -> None:
    path, top = sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 15
    st = stages(path)
    print(f"stages {len(st)}  stage-seconds {sum(v[0] for v in st.values()):.1f}")
    for sid, (dur, tasks, rows, name) in sorted(st.items(), key=lambda kv: -kv[1][0])[:top]:
        print(f"{sid:5d} {dur:8.2f}s tasks={tasks:5d} rows={rows:>10} {name}")


if __name__ == "__main__":
    main()
