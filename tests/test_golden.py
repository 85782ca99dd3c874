"""The AFR formula reproduces the published 33-model table; reconcile_published flags differences."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetlens.functions.columns import afr_pct
from fleetlens.operators.checks import reconcile_published

# The published per-model table the reference reconciles against
# (model, drive_days, failures, afr_pct), in its original order.
GOLDEN = [
    ("HMS5C4040BLE640", 15858, 0, 0.0),
    ("HUH728080ALE600", 86921, 0, 0.0),
    ("HUH721212ALE600", 234350, 8, 1.25),
    ("HUH721212ALE604", 1183774, 86, 2.65),
    ("HUH721212ALN604", 870252, 95, 3.98),
    ("ST8000DM002", 639473, 25, 1.43),
    ("ST8000NM000A", 21552, 1, 1.69),
    ("ST8000NM0055", 1176619, 39, 1.21),
    ("ST10000NM0086", 86667, 11, 4.63),
    ("ST12000NM0007", 87389, 11, 4.59),
    ("ST12000NM0008", 1664558, 129, 2.83),
    ("ST12000NM000J", 96887, 1, 0.38),
    ("ST12000NM001G", 1185545, 33, 1.02),
    ("ST14000NM000J", 37258, 1, 0.98),
    ("ST14000NM001G", 944400, 21, 0.81),
    ("ST14000NM0138", 111709, 15, 4.9),
    ("ST16000NM000J", 10117, 1, 3.61),
    ("ST16000NM001G", 3098105, 44, 0.52),
    ("ST16000NM002J", 41931, 0, 0.0),
    ("ST24000NM002H", 820090, 74, 3.29),
    ("MG07ACA14TA", 3343724, 94, 1.03),
    ("MG07ACA14TEY", 88602, 5, 2.06),
    ("MG08ACA16TA", 3548250, 102, 1.05),
    ("MG08ACA16TE", 553878, 21, 1.38),
    ("MG08ACA16TEY", 435063, 26, 2.18),
    ("MG09ACA16TE", 36988, 1, 0.99),
    ("MG10ACA20TE", 1665263, 42, 0.92),
    ("MG11ACA24TE", 495387, 3, 0.22),
    ("WUH721414ALE6L4", 776557, 7, 0.33),
    ("WUH721816ALE6L0", 267868, 24, 3.27),
    ("WUH721816ALE6L4", 2402732, 64, 0.97),
    ("WUH722222ALE6L4", 3992942, 42, 0.38),
    ("WUH722626ALE6L4", 182471, 4, 0.8),
]
SCHEMA = "model string, drive_days bigint, failures bigint, afr_pct double"


def test_formula_reproduces_published_afr_and_fleet(spark):
    pub = spark.createDataFrame(GOLDEN, SCHEMA)
    got = pub.select("model", "afr_pct", afr_pct(F.col("failures"), F.col("drive_days")).alias("calc")).collect()
    assert all(r.afr_pct == r.calc for r in got)
    tot = pub.agg(F.sum("drive_days").alias("d"), F.sum("failures").alias("f"))
    row = tot.select("d", "f", afr_pct(F.col("f"), F.col("d")).alias("a")).first()
    assert (row.d, row.f, row.a) == (30_203_180, 1_030, 1.24)


def test_reconcile_published_pass_and_investigate(spark):
    pub = spark.createDataFrame(GOLDEN, SCHEMA)
    computed = pub.select("model", "drive_days", "failures")  # AFR recomputed by the operator
    res = reconcile_published(computed, pub).collect()
    assert len(res) == 33 and {r.result for r in res} == {"PASS"}
    off = computed.withColumn("failures", F.when(F.col("model") == "ST8000DM002", 26).otherwise(F.col("failures")))
    extra = spark.createDataFrame([("NEW1", 10, 0)], "model string, drive_days bigint, failures bigint")
    res2 = {r.model: r for r in reconcile_published(off.unionByName(extra), pub).collect()}
    assert res2["ST8000DM002"].result == "INVESTIGATE" and res2["ST8000DM002"].failures_delta == 1
    assert res2["NEW1"].result == "INVESTIGATE" and res2["NEW1"].published_drive_days is None
    assert sum(r.result == "PASS" for r in res2.values()) == 32
