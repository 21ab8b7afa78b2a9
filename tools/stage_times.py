"""Summarise a Spark event log: the slowest stages with task counts.

    BENCH_EVENT_LOG=$(mktemp -d /tmp/run-XXXXXX) python bench.py
    python tools/stage_times.py <event-log folder or file> [top_n]
"""

from __future__ import annotations

import glob
import json
import os
import sys


def stages(path: str):
    files = sorted(glob.glob(os.path.join(path, "**", "events_*"), recursive=True)) \
        if os.path.isdir(path) else [path]
    if os.path.isdir(path) and not files:
        files = sorted(p for p in glob.glob(os.path.join(path, "**", "*"), recursive=True)
                       if os.path.isfile(p))
    for f in files:
        for line in _lines(f):
            ev = json.loads(line)
            if ev.get("Event") != "SparkListenerStageCompleted":
                continue
            info = ev["Stage Info"]
            start, end = info.get("Submission Time"), info.get("Completion Time")
            if start and end:
                yield (end - start) / 1000.0, info["Stage ID"], info["Number of Tasks"], \
                    info["Stage Name"][:90]


def _lines(path: str):
    """Event-log lines; Spark compresses logs with zstd by default."""
    import io

    with open(path, "rb") as fh:
        head = fh.read(4)
        fh.seek(0)
        if head == b"\x28\xb5\x2f\xfd":
            import zstandard

            reader = zstandard.ZstdDecompressor().stream_reader(fh, read_across_frames=True)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
        else:
            yield from io.TextIOWrapper(fh, encoding="utf-8")


def main() -> None:
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 20
    rows = sorted(stages(sys.argv[1]), reverse=True)
    print(f"{len(rows)} stages, {sum(r[0] for r in rows):.1f} s in total")
    for sec, sid, tasks, name in rows[:top]:
        print(f"{sec:8.2f}s  stage {sid:5d}  {tasks:5d} tasks  {name}")


if __name__ == "__main__":
    main()
