"""Checks counted by the write, rows that break a check, and the grouped unique and relationship passes."""

from __future__ import annotations

import json

from fleetlens.operators import checks, contract
from fleetlens.operators.checks import CheckSpec
from fleetlens.plans.warehouse import WarehouseBuild, read_raw, write_table
from fleetlens.sources.telemetry import raw_drive_stats

from helpers import SF001

SUITE = [
    CheckSpec("not_null", "c", "k"),
    CheckSpec("accepted_values", "c", "v", values=(0, 1)),
    CheckSpec("expression", "c", "v", "warn", predicate="v < 0", name="not_negative"),
    CheckSpec("unique", "c", "k"),
    CheckSpec("unique", "c", "d", via=("k", "v")),
    CheckSpec("relationships", "c", "k", to_table="p", to_column="key"),
    CheckSpec("unique", "p", "key"),
    CheckSpec("relationships", "p", "key", to_table="c", to_column="k"),
]


def frames(spark):
    rows = [("a", 0, "x"), ("a", 0, "x"), ("b", 5, "y"), (None, -1, "z"), ("lost", 1, None), ("lost", 1, None)]
    return {
        "c": spark.createDataFrame(rows, "k string, v int, d string"),
        "p": spark.createDataFrame([("a",), ("b",), ("b",), ("other",), (None,)], "key string"),
    }


WANT = {
    "not_null:c.k": 1, "accepted_values:c.v": 2, "not_negative": 1, "unique:c.k": 2, "unique:c.d": 1, "relationships:c.k->p.key": 2,
    "unique:p.key": 1, "relationships:p.key->c.k": 1,
}


def test_counts(spark):
    got = checks.run_checks(frames(spark), SUITE).collect()
    assert {r.check_name: r.failing_rows for r in got} == WANT
    assert {r.check_name: r.status for r in got}["not_negative"] == "warn"
    assert len(got) == len(SUITE)


def test_no_rows_no_failures(spark):
    empty = {k: df.limit(0) for k, df in frames(spark).items()}
    got = checks.run_checks(empty, SUITE).collect()
    assert {r.check_name for r in got} == set(WANT) and all(r.failing_rows == 0 and r.status == "pass" for r in got)


def test_observed_by_the_write(spark, scratch):
    tables = frames(spark)
    df, counts = checks.observed(tables["c"], checks.column_checks("c", SUITE))
    write_table(df, f"{scratch}/c")
    told = counts()
    assert told == {k: WANT[k] for k in ("not_null:c.k", "accepted_values:c.v", "not_negative")}
    got = checks.run_checks(tables, SUITE, told)
    assert {r.check_name: r.failing_rows for r in got.collect()} == WANT
    # what was observed reads no table
    plan = checks.run_checks(tables, checks.column_checks("c", SUITE), told)._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and "LogicalRDD" not in plan.replace("LogicalRDD [check_name", ""), plan
    assert checks.observed(tables["p"], [])[1]() == {}


def test_rows_that_break_a_check(spark, scratch):
    got = checks.failing_rows(frames(spark), SUITE)
    path = checks.write_failing_rows(got, f"{scratch}/failing")
    back = spark.read.parquet(path)
    assert sorted(back.columns) == ["check_name", "kind", "row", "severity", "table_name"]
    found: dict[str, list] = {}
    for r in back.collect():
        found.setdefault(r.check_name, []).append(json.loads(r.row))
    assert len(found["not_null:c.k"]) == 1 and found["not_null:c.k"][0] == {"v": -1, "d": "z"}
    assert sorted(r["v"] for r in found["accepted_values:c.v"]) == [-1, 5]
    assert sorted(r["k"] for r in found["unique:c.k"]) == ["a", "a", "lost", "lost"]
    assert [r["d"] for r in found["unique:c.d"]] == ["x", "x"]
    assert [r["k"] for r in found["relationships:c.k->p.key"]] == ["lost", "lost"]
    assert [r["key"] for r in found["relationships:p.key->c.k"]] == ["other"]
    assert {r.severity for r in back.where("check_name = 'not_negative'").collect()} == {"warn"}


def test_a_row_is_tagged_with_all_that_it_breaks(spark):
    tagged = checks.tag_rows(frames(spark)["c"], checks.column_checks("c", SUITE))
    assert sorted((r.d or "", sorted(r.broken)) for r in tagged.collect() if r.broken) == [
        ("y", ["accepted_values:c.v"]), ("z", ["accepted_values:c.v", "not_negative", "not_null:c.k"]),
    ]


def test_the_build_counts_what_a_scan_counts(spark, scratch):
    raw_root = write_table(raw_drive_stats(spark, SF001), f"{scratch}/raw", partition_by="quarter")
    built = WarehouseBuild(spark, read_raw(spark, raw_root), f"{scratch}/wh").run()
    tables = {name: built.read(spark, name) for name in built.tables}
    tables["stg_drive_stats"] = contract.stage_contract(read_raw(spark, raw_root))
    column = {s.check_name for s in checks.WAREHOUSE_SUITE if checks.breaks(s) is not None and s.table != "int_drive_model_partials"}
    assert set(built.counts) == column
    scanned = {r.check_name: r.failing_rows for r in checks.run_checks(tables).collect()}
    assert {k: scanned[k] for k in column} == built.counts
    observed = {r.check_name: r.failing_rows for r in checks.run_checks(tables, counts=built.counts).collect()}
    assert observed == scanned
