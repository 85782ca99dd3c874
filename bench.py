"""Benchmark: build the reliability warehouse from the given tables and time each step.

Reads ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on ``local[$BENCH_CPUS]``,
prints ONE JSON line: {"metric", "value", "unit", "queries": {step: sec}, "sf", ...}.

Preparation (untimed, reported as ``landing_prep``): the drive-day telemetry is
derived from lineitem + part and landed as CSV files in ``quarter=YYYYQn`` folders,
the stand-in for the quarterly CSV drops.

Timed steps: ``csv_ingest`` loads every landed quarter into the quarter-partitioned
Parquet raw zone (header union by name, type pass, reconciliation, drift history);
then the 8 warehouse tables, the data-quality suite over them (like the reference's
build with its tests), and the analytics marts, each reading the written tables.

A warm-up build on sf0.001 runs first in the same session (JVM start, class
loading, code generation) and is reported separately as ``warmup_sec``; the
headline ``value`` is the timed run on ``$BENCH_SF_DIR`` only. The same steps also run on
sf0.01 (``small``), and ``marginal_rows_per_sec`` is the slope between both sizes.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fleetlens.config import TEST_SCALE_THRESHOLDS  # noqa: E402
from fleetlens.operators import checks  # noqa: E402
from fleetlens.plans import analytics  # noqa: E402
from fleetlens.plans.incremental import refresh_quarters  # noqa: E402
from fleetlens.plans.warehouse import BuildResult, WarehouseBuild, read_raw, write_table  # noqa: E402
from fleetlens.session import local_session  # noqa: E402
from fleetlens.sources.ingest import ingest_landing  # noqa: E402
from fleetlens.sources.telemetry import RAW_COLUMNS, raw_drive_stats  # noqa: E402


# Drive-keyed tables bucketed by serial (0 = plain Parquet); default 2 x cpus.
BUCKETS = int(os.environ.get("BENCH_BUCKETS", str(2 * int(os.environ.get("BENCH_CPUS", "8"))))) or None


def land_csv(spark, sf_dir: str, out: str) -> str:
    """Untimed preparation: the telemetry as quarterly CSV drops (quarter=YYYYQn/part-*.csv)."""
    landing = f"{out}/landing"
    raw_drive_stats(spark, sf_dir).write.partitionBy("quarter").option("header", True).csv(landing)
    return landing


SMALL_DIR = "/root/testdata/sf0.01"  # the second size, for the marginal rates


COUNTS: dict[str, int] = {}  # non-time facts of the timed run (reported outside "queries")
TIMES: dict[str, float] = {}  # seconds per step of the timed run


def run_all(spark, landing: str, out: str, times: dict[str, float]) -> BuildResult:
    t0 = time.perf_counter()
    raw_root = f"{out}/raw/drive_stats"
    reports = ingest_landing(spark, landing, raw_root, f"{out}/meta")
    times["csv_ingest"] = time.perf_counter() - t0
    COUNTS["csv_ingest_quarters"] = len(reports)

    t0 = time.perf_counter()
    result = WarehouseBuild(spark, read_raw(spark, raw_root), f"{out}/warehouse", TEST_SCALE_THRESHOLDS, buckets=BUCKETS).run()
    times["warehouse_build"] = time.perf_counter() - t0
    times.update(result.seconds)

    t0 = time.perf_counter()
    tables = {name: result.read(spark, name) for name in result.tables}
    tables["stg_drive_stats"] = result.staged(spark, raw_root)
    summary = checks.checks_suite_with_singular(tables, read_raw(spark, raw_root), result.counts).collect()
    times["data_checks"] = time.perf_counter() - t0
    COUNTS["data_checks"] = len(summary)
    COUNTS["data_checks_failed"] = sum(r.status == "fail" for r in summary)

    for name, fn in analytics.GOLD_QUERIES.items():
        t0 = time.perf_counter()
        fn(spark, result).write.format("noop").mode("overwrite").save()
        times[name] = time.perf_counter() - t0
    return result


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    extra = {}
    if os.environ.get("BENCH_EVENT_LOG"):  # a scratch folder for Spark's event log (stage/task times)
        extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG"]}
    spark = local_session(cpus, max(2 * int(cpus), 8), app="fleetlens-bench", extra_conf=extra)
    spark.sparkContext.setLogLevel("ERROR")
    out = tempfile.mkdtemp(prefix="fleetlens-bench-", dir=os.environ.get("BENCH_OUT", "/tmp"))

    t0 = time.perf_counter()
    run_all(spark, land_csv(spark, "/root/testdata/sf0.001", f"{out}/warmup"), f"{out}/warmup", {})
    warmup = time.perf_counter() - t0

    small: dict[str, float] = {}
    small_rows = 0
    if os.path.isdir(SMALL_DIR) and os.path.realpath(SMALL_DIR) != os.path.realpath(sf_dir):
        built = run_all(spark, land_csv(spark, SMALL_DIR, f"{out}/small"), f"{out}/small", small)
        small_rows = built.read(spark, "fct_drive_daily").count()

    t0 = time.perf_counter()
    landing = land_csv(spark, sf_dir, f"{out}/run")
    prep = time.perf_counter() - t0

    times = TIMES
    t_all = time.perf_counter()
    result = run_all(spark, landing, f"{out}/run", times)
    total = time.perf_counter() - t_all

    # Incremental before/after (outside the headline): the warehouse loaded through the
    # partition-keyed path, then one more refresh of only the newest quarter.
    raw_root = f"{out}/run/raw/drive_stats"
    quarters = sorted(r.quarter for r in read_raw(spark, raw_root).select("quarter").distinct().collect())
    t0 = time.perf_counter()
    refresh_quarters(spark, raw_root, f"{out}/run/incremental", quarters)
    inc_full = time.perf_counter() - t0
    t0 = time.perf_counter()
    refresh_quarters(spark, raw_root, f"{out}/run/incremental", quarters[-1:])
    inc_one = time.perf_counter() - t0

    rows = result.read(spark, "fct_drive_daily").count()
    log = spark.read.parquet(f"{out}/run/meta/ingest_log").groupBy().sum("gb_in", "gb_out").first()
    spark.stop()
    # rows per second that a step takes on beyond the smaller size (null where the difference is noise)
    marginal = {
        k: round((rows - small_rows) / (v - small[k]), 1) if small and v - small[k] > 0.2 else None for k, v in times.items()
    }
    print(
        json.dumps(
            {
                "metric": "warehouse_end_to_end",
                "value": round(total, 3),
                "unit": "sec",
                "queries": {k: round(v, 3) for k, v in times.items()},
                "sf": sf,
                "drive_days": rows,
                "drive_days_per_sec": round(rows / total, 1) if total else None,
                "csv_ingest_rows_per_sec": round(rows / times["csv_ingest"], 1),
                "csv_ingest_cells_per_sec": round(rows * len(RAW_COLUMNS) / times["csv_ingest"], 1),
                "csv_gb_in": round(log[0], 4),
                "parquet_gb_out": round(log[1], 4),
                "small": {"drive_days": small_rows, "queries": {k: round(v, 3) for k, v in small.items()}},
                "marginal_rows_per_sec": marginal,
                "cpus": int(cpus),
                "warmup_sec": round(warmup, 3),
                "landing_prep_sec": round(prep, 3),
                "buckets": BUCKETS,
                "incremental_full_load_sec": round(inc_full, 3),
                "incremental_one_quarter_sec": round(inc_one, 3),
                "counts": COUNTS,
            }
        )
    )


if __name__ == "__main__":
    try:
        main()
    except Exception as exc:  # still print the one JSON line the driver reads
        print(json.dumps({"metric": "warehouse_end_to_end", "value": None, "unit": "sec",
                          "queries": {k: round(v, 3) for k, v in TIMES.items()},
                          "error": f"{type(exc).__name__}: {str(exc)[:500]}"}))
        raise SystemExit(1)
