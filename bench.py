"""Headline-query benchmark.

Runs the main page-view queries at ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) on ``local[$BENCH_CPUS]`` and prints one JSON line:
``{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}``.

Each query is executed to completion with the ``noop`` sink (no driver
collection); one unmeasured pass over all queries runs first so JVM start-up
and JIT compilation are not charged to the measured runs.  Each query is
timed ``$BENCH_REPEAT`` times (default 3) and the best time is reported.
``$BENCH_EVENT_LOG_DIR`` (a fresh scratch folder) turns on Spark's event log
for stage and task times.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "label_pv_window",      # A1 label count in a window
    "dim_pv_window",        # A5 dimension count in a window
    "backfill_windows",     # I9 all hourly dimension windows in one pass
    "backfill_labels_5h",   # I9 all 5-hour label windows in one pass
    "latest_n_per_group",   # W1 latest 3 per group
    "job_latest_n",         # I8 cells -> rows -> top 3 per device
    "upsert_by_key",        # K1 keyed merge
    "upsert_batch",         # K7 merge with duplicate keys in the batch
    "job_label_pv",         # I5 two incremental launches with keyed writes
    "job_label_hourly",     # I5 hourly launches into an existing day
    "job_copy_window",      # I7 window copy
    "stream_label_pv",      # X1 streaming tumbling-window label counts
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    from clickwin.session import get_spark
    from clickwin.plans.queries import QUERIES

    extra = {"spark.driver.memory": os.environ.get("BENCH_MEM", "16g")}
    if os.environ.get("BENCH_EVENT_LOG_DIR"):
        # stage / task times for later reading, without any UI or server
        extra.update({"spark.eventLog.enabled": "true",
                      "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG_DIR"]})
    spark = get_spark(f"local[{cpus}]", int(cpus) * 2, extra=extra)
    # warm-up: one unmeasured run of every headline query (JIT, file footers)
    for name in HEADLINE:
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for name in HEADLINE:
        best = None
        for _ in range(repeat):
            t0 = time.perf_counter()
            df = QUERIES[name](spark, sf_dir)
            df.write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times,
                      "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
