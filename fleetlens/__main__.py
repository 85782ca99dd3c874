"""Command line: ``python -m fleetlens {ingest,build,refresh,sync,stream,check} ...``.

    ingest  --quarter 2026Q1 --csv DIR --raw RAW --meta META   one quarter (exit 2 if it does not reconcile)
    ingest  --landing DIR --raw RAW --meta META                every quarter=YYYYQn folder, one batch
    build   --raw RAW --out WAREHOUSE [--buckets N] [--min-drive-count 100 --min-drive-days 10000]
    refresh --raw RAW --out WAREHOUSE --quarters Q [Q ...]     load some quarters, rebuild what depends on all
    sync    --raw RAW --out WAREHOUSE [--drive-buckets N]      find what changed in RAW, rewrite what depends on it
    stream  --landing DIR --raw RAW --meta META --out WAREHOUSE --checkpoint DIR   load new drops, then sync
    check   --raw RAW --out WAREHOUSE [--rows DIR]             data tests; exit 1 if an error-level check fails;
                                                               the rows that break a check go to DIR

Uses the active SparkSession (or creates one from spark-submit's configuration).
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from fleetlens.config import AfrThresholds
from fleetlens.operators import checks
from fleetlens.plans.incremental import refresh_quarters
from fleetlens.plans.refresh import refresh
from fleetlens.plans.warehouse import BuildResult, WarehouseBuild, read_raw
from fleetlens.sources import ingest
from fleetlens.streaming.refresher import refresh_from_landing

TABLES = [
    "int_drive_spans", "dim_drive", "dim_model", "dim_date",
    "fct_drive_daily", "fct_failures", "mart_model_afr_quarterly",
]


def _session() -> SparkSession:
    return SparkSession.builder.appName("fleetlens").getOrCreate()


def cmd_ingest(spark: SparkSession, a: argparse.Namespace) -> int:
    try:
        if a.landing:
            reports = ingest.ingest_landing(spark, a.landing, a.raw, a.meta)
        else:
            reports = [ingest.ingest_quarter(spark, a.quarter, a.csv, a.raw, a.meta)]
    except ingest.ReconciliationError as e:
        print(f"not loaded: {e}", file=sys.stderr)
        return 2
    for r in reports:
        print(json.dumps({"quarter": r.quarter, "files": r.files, "rows": r.parquet_rows,
                          "drift": r.drift["status"], "result": "PASS" if r.ok else "FAIL"}))
    return 0


def cmd_build(spark: SparkSession, a: argparse.Namespace) -> int:
    thr = AfrThresholds(a.min_drive_count, a.min_drive_days)
    res = WarehouseBuild(spark, read_raw(spark, a.raw), a.out, thr, buckets=a.buckets).run()
    print(json.dumps({"tables": res.tables, "seconds": {k: round(v, 3) for k, v in res.seconds.items()}}))
    return 0


def cmd_refresh(spark: SparkSession, a: argparse.Namespace) -> int:
    thr = AfrThresholds(a.min_drive_count, a.min_drive_days)
    print(json.dumps({"tables": refresh_quarters(spark, a.raw, a.out, a.quarters, thr)}))
    return 0


def cmd_sync(spark: SparkSession, a: argparse.Namespace) -> int:
    thr = AfrThresholds(a.min_drive_count, a.min_drive_days)
    r = refresh(spark, a.raw, a.out, thr, buckets=a.drive_buckets)
    print(json.dumps({"changed": r.changed, "vanished": r.vanished, "touched_drives": r.touched_drives,
                      "touched_buckets": r.touched_buckets, "rewritten_buckets": r.rewritten_buckets, "mart_quarters": r.mart_quarters}))
    return 0


def cmd_stream(spark: SparkSession, a: argparse.Namespace) -> int:
    thr = AfrThresholds(a.min_drive_count, a.min_drive_days)
    n = refresh_from_landing(spark, a.landing, a.raw, a.meta, a.out, a.checkpoint, thr, a.drive_buckets)
    print(json.dumps({"batches": n}))
    return 0


def cmd_check(spark: SparkSession, a: argparse.Namespace) -> int:
    res = BuildResult(a.out.rstrip("/"), {t: f"{a.out.rstrip('/')}/{t}" for t in TABLES})
    tables = {t: res.read(spark, t) for t in TABLES}
    tables["stg_drive_stats"] = res.staged(spark, a.raw)
    summary = checks.checks_suite_with_singular(tables, read_raw(spark, a.raw)).collect()
    failed = [r for r in summary if r.status == "fail"]
    for r in sorted(summary, key=lambda r: (r.status != "fail", r.status != "warn", r.check_name)):
        print(f"{r.status.upper():5} {r.failing_rows:>10} {r.check_name}")
    print(f"{len(summary)} checks: {len(failed)} failed, {sum(r.status == 'warn' for r in summary)} warned")
    if a.rows:
        late = checks.failure_only_on_last_seen(tables["stg_drive_stats"], tables["int_drive_spans"])
        rows = checks.failing_rows(tables, singular={"failure_only_on_last_seen": ("stg_drive_stats", late)})
        checks.write_failing_rows(rows, a.rows)
    return 1 if failed else 0


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    p = argparse.ArgumentParser(prog="python -m fleetlens")
    sub = p.add_subparsers(dest="cmd", required=True)
    i = sub.add_parser("ingest")
    i.add_argument("--quarter")
    i.add_argument("--csv")
    i.add_argument("--landing")
    i.add_argument("--raw", required=True)
    i.add_argument("--meta", required=True)
    b = sub.add_parser("build")
    b.add_argument("--buckets", type=int, default=None)
    f = sub.add_parser("refresh")
    f.add_argument("--quarters", nargs="+", required=True)
    s = sub.add_parser("sync")
    t = sub.add_parser("stream")
    for flag in ("--landing", "--meta", "--checkpoint"):
        t.add_argument(flag, required=True)
    for v in (s, t):
        v.add_argument("--drive-buckets", type=int, default=64)
    for v in (b, f, s, t):
        v.add_argument("--raw", required=True)
        v.add_argument("--out", required=True)
        v.add_argument("--min-drive-count", type=int, default=100)
        v.add_argument("--min-drive-days", type=int, default=10_000)
    c = sub.add_parser("check")
    c.add_argument("--raw", required=True)
    c.add_argument("--out", required=True)
    c.add_argument("--rows")
    a = p.parse_args(argv)
    if a.cmd == "ingest" and not a.landing and not (a.quarter and a.csv):
        p.error("ingest needs --landing, or --quarter and --csv")
    if a.cmd == "ingest" and a.quarter and not ingest.is_quarter(a.quarter):
        p.error(f"--quarter must look like 2026Q1, got {a.quarter!r}")
    spark = spark or _session()
    commands = {"ingest": cmd_ingest, "build": cmd_build, "refresh": cmd_refresh, "sync": cmd_sync, "stream": cmd_stream, "check": cmd_check}
    return commands[a.cmd](spark, a)


if __name__ == "__main__":
    raise SystemExit(main())
