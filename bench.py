"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line:
{"metric": "headline_plus_matrix_wall", "value": sec, "unit": "sec",
 "queries": {name: sec, ...}, "shuffle_bytes": {name: bytes}, "sf": ...}

Each timed run builds a fresh Book (no reuse of a materialised feed), so
its time includes the loan-level scan, join and aggregation; the full run also
publishes every phase table, reads it back and validates it.  All queries run
REPS times in alternating order, after one untimed round at this scale, and
report the median (min and max alongside).  Shuffle
bytes (first run of each query) come from Spark's event log, written to a
fresh scratch folder.
"""
from __future__ import annotations

import glob
import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from runoff.config import DEFAULT  # noqa: E402
from runoff.plans import pipeline  # noqa: E402
from runoff.plans.book import Book  # noqa: E402
from runoff.session import build_session  # noqa: E402


def _sf(sf_dir: str):
    m = re.search(r"sf([0-9.]+)", sf_dir)
    return float(m.group(1)) if m else None


def _shuffle_bytes(log_dir: str) -> dict[str, int]:
    stage_group: dict[int, str] = {}
    out: dict[str, int] = {}
    paths = sorted(p for p in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)
                   if os.path.isfile(p))
    for path in paths:
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    grp = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        if grp:
                            stage_group[sid] = grp
                elif kind == "SparkListenerTaskEnd":
                    grp = stage_group.get(ev.get("Stage ID"))
                    tm = ev.get("Task Metrics") or {}
                    w = (tm.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
                    if grp:
                        out[grp] = out.get(grp, 0) + int(w)
    return out


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    scratch = tempfile.mkdtemp(prefix="runoff-bench-")
    log_dir = os.path.join(scratch, "events")
    os.makedirs(log_dir)
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus),
                          app="runoff-bench",
                          extra={"spark.eventLog.enabled": "true",
                                 "spark.eventLog.compress": "false",
                                 "spark.eventLog.dir": f"file://{log_dir}",
                                 "spark.checkpoint.dir": f"file://{scratch}/ckpt"})
    sc = spark.sparkContext
    sc.setCheckpointDir(f"file://{scratch}/ckpt")

    def run(name, fn):
        sc.setJobGroup(name, name)
        t0 = time.perf_counter()
        b = Book.from_driver_tables(spark, sf_dir, DEFAULT)
        fn(b)
        took = time.perf_counter() - t0
        b.release()
        return took

    timings = {}
    spread = {}
    reps = int(os.environ.get("BENCH_REPS", "3"))
    runs: dict[str, list[float]] = {}
    turn = iter(range(1_000_000))
    queries = (("headline_ecl", lambda b: b.headline().collect()),
               ("segment_ecl_matrix", lambda b: b.wavg.collect()),
               ("full_pipeline_with_validation", lambda b: pipeline.run(b, f"file://{scratch}/out-{next(turn)}")))
    for _, fn in queries:
        run("warm-up", fn)
    for rep in range(reps):
        for name, fn in queries if rep % 2 == 0 else queries[::-1]:
            runs.setdefault(name, []).append(run(name if rep == 0 else f"{name}#{rep}", fn))
    for name, _ in queries:
        timings[name] = statistics.median(runs[name])
        spread[name] = [round(min(runs[name]), 3), round(max(runs[name]), 3)]
    loans = Book.from_driver_tables(spark, sf_dir, DEFAULT).loans.count()
    sc.setJobGroup("done", "done")
    spark.stop()
    shuffle = _shuffle_bytes(log_dir)
    value = timings["headline_ecl"] + timings["segment_ecl_matrix"]
    print(json.dumps({
        "metric": "headline_plus_matrix_wall", "value": round(value, 3), "unit": "sec",
        "queries": {k: round(v, 3) for k, v in timings.items()},
        "min_max": spread, "reps": reps,
        "shuffle_bytes": {k: shuffle.get(k, 0) for k in timings},
        "loans_per_sec": {k: round(loans / v) for k, v in timings.items()},
        "sf": _sf(sf_dir), "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
