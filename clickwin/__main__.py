"""Launch the page-view jobs, e.g. from a scheduler via spark-submit.

    python -m clickwin label    --store S --events E [--step 1] [--default-start K]
    python -m clickwin dim      --store S --log L    [--step 1]
    python -m clickwin backfill --store S --events E --kind label --step 5
    python -m clickwin copy     --events E --dest D --start K --end K

``--events`` is an events table the click log is derived from; ``--log`` is
a click log stored by ``sources.clicklog.write_clicklog`` (day folders).
Each run prints one JSON status line; exit code 0 also when the window is
not ready yet (the next launch simply tries again).
"""

from __future__ import annotations

import argparse
import json
import sys
from datetime import datetime

from clickwin.functions.timekeys import HOUR_KEY
from clickwin.plans import incremental as inc
from clickwin.session import get_spark
from clickwin.sources import clicklog as cl


def _source(spark, args):
    if args.log:
        return lambda s, e: cl.read_clicklog(spark, args.log, s, e)
    if args.events:
        def factory(s, e):
            events = cl.events_between(spark.read.parquet(args.events), s, e)
            return cl.clicklog_from_events(events)
        return factory
    raise SystemExit("give --events or --log")


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="clickwin")
    p.add_argument("job", choices=["label", "dim", "backfill", "copy"])
    p.add_argument("--store", help="root folder of result and marker tables")
    p.add_argument("--events", help="events table (Parquet) to derive the click log from")
    p.add_argument("--log", help="click log stored by day")
    p.add_argument("--step", type=int, default=1, help="window length in units")
    p.add_argument("--default-start", default=inc.DEFAULT_START)
    p.add_argument("--now", help="wall clock as yyyy-MM-dd HH:mm:ss (default: now)")
    p.add_argument("--kind", choices=["label", "dim"], default="label", help="for backfill")
    p.add_argument("--gate", choices=["next_hour", "any_later"], default="next_hour")
    p.add_argument("--unit", default="HOUR", help="of --step: HOUR, MIMUE (minute) or DAY")
    p.add_argument("--pattern", default=HOUR_KEY, help="time key of window bounds, "
                   "e.g. yyyyMMddHHmm for minutes, yyyyMMdd for days")
    p.add_argument("--guard", choices=["start", "end"], default="start")
    p.add_argument("--null-as-empty", action="store_true",
                   help="count a null label as the empty one")
    p.add_argument("--dest", help="copy target")
    p.add_argument("--start")
    p.add_argument("--end")
    p.add_argument("--master", help="only for local runs; spark-submit sets it otherwise")
    args = p.parse_args(argv)

    spark = get_spark(args.master)
    now = datetime.strptime(args.now, "%Y-%m-%d %H:%M:%S") if args.now else None
    source = _source(spark, args)
    if args.job in ("label", "dim"):
        store = inc.label_store(args.store) if args.job == "label" else inc.dim_store(args.store)
        status = inc.run_window_job(spark, source, store, args.job, args.step, now=now,
                                    default_start=args.default_start, gate=args.gate,
                                    unit=args.unit, pattern=args.pattern, guard=args.guard,
                                    null_as_empty=args.null_as_empty)
    elif args.job == "backfill":
        store = inc.label_store(args.store) if args.kind == "label" else inc.dim_store(
            args.store)
        status = inc.run_catch_up(spark, source, store, args.kind, args.step, now=now,
                                  default_start=args.default_start, gate=args.gate)
    else:
        inc.copy_window(spark, source, args.dest,
                        ["ID", "TIME", "PARAM_TYPE", "URL", "TITLE", "CONTENT_TYPE"],
                        args.start, args.end)
        status = {"status": "done", "start": args.start, "end": args.end}
    print(json.dumps(status))
    return 0


if __name__ == "__main__":
    sys.exit(main())
