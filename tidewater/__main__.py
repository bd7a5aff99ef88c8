"""Command line: ``python -m tidewater {daily,backfill,snapshot,stream} ...``.

The job counterpart of the original entry script: the landing folder replaces
the live API, the store folder the staging database.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from tidewater.plans.pipeline import RunContext, run_backfill, run_post_snapshot, run_staging
from tidewater.session import checkpoint_dir, get_spark
from tidewater.sources.landing import read_landing
from tidewater.sources.store import StagingStore


def _date(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="tidewater")
    ap.add_argument("command", choices=["daily", "backfill", "snapshot", "stream", "vacuum"])
    ap.add_argument("--landing", help="landed pages (Parquet); every command but vacuum")
    ap.add_argument("--store", required=True, help="staging store folder (shared)")
    ap.add_argument("--run-date", type=_date, default=dt.date.today())
    ap.add_argument("--since", type=_date)
    ap.add_argument("--until", type=_date)
    ap.add_argument("--chunk-days", type=int, default=10)
    ap.add_argument("--full-refresh", choices=["true", "false", "auto"], default="auto",
                    help="auto: weekly (Thursday) rule for posts")
    ap.add_argument("--post-mode", default="recent")
    ap.add_argument("--post-limit", type=int, default=1000)
    ap.add_argument("--on-conflict", choices=["error", "ignore"], default="error")
    ap.add_argument("--max-files-per-trigger", type=int, default=None,
                    help="stream: bound each micro-batch to this many landed files")
    ap.add_argument("--keep-manifests", type=int, default=10, help="vacuum: manifests whose folders stay")
    ap.add_argument("--older-than-hours", type=float, default=24.0, help="vacuum: minimum folder age")
    args = ap.parse_args(argv)
    if args.command != "vacuum" and not args.landing:
        ap.error(f"{args.command} needs --landing")

    spark = get_spark()
    store = StagingStore(spark, args.store)
    if args.command == "vacuum":
        for path in store.vacuum(args.keep_manifests, dt.timedelta(hours=args.older_than_hours)):
            print(json.dumps({"deleted": path}))
        return 0
    load_ts = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)
    full = {"true": True, "false": False, "auto": None}[args.full_refresh]
    if args.command == "stream":
        from tidewater.streaming.landing_stream import start_landing_stream
        q = start_landing_stream(spark, args.landing, store, f"{checkpoint_dir(spark)}/landing-stream",
                                 args.run_date, load_ts, since=args.since, until=args.until,
                                 max_files_per_trigger=args.max_files_per_trigger)
        q.awaitTermination()
        return 0
    ctx = RunContext(spark=spark, landing=read_landing(spark, args.landing, run_date=args.run_date), store=store,
                     run_date=args.run_date, load_ts=load_ts, full_refresh=full, since=args.since,
                     until=args.until, post_mode=args.post_mode, post_limit=args.post_limit,
                     on_conflict=args.on_conflict)
    if args.command == "daily":
        results = run_staging(ctx)
    elif args.command == "backfill":
        if args.since is None or args.until is None:
            ap.error("backfill needs --since and --until")
        results = run_backfill(ctx, args.since, args.until, args.chunk_days)
    else:
        results = run_post_snapshot(ctx)
    for r in results:
        print(json.dumps({"step": r.name, "status": r.status, "rows_received": r.rows_received,
                          "rows_written": r.rows_written, "rows_inserted": r.rows_inserted, "rows_updated": r.rows_updated,
                          "rows_rejected": r.rows_rejected, "rows_skipped": r.rows_skipped, "error": r.error}))
    return 0 if all(r.status == "succeeded" for r in results) else 1


if __name__ == "__main__":
    sys.exit(main())
