"""fleetlens: device-fleet reliability analytics on Spark DataFrames.

Daily per-device telemetry -> staged contract -> observation spans with censoring
-> drive / model / date dimensions -> daily and failure facts -> annualized
failure rates, survival, trends and data-quality checks. Every operator is a
function from DataFrames to a DataFrame built from built-in Spark expressions.

Entry points:

* ``fleetlens.sources.ingest.ingest_landing`` / ``ingest_quarter``: CSV drops -> raw zone
* ``fleetlens.plans.warehouse.WarehouseBuild(spark, raw, root, buckets=...).run()``: all tables
* ``fleetlens.plans.incremental.refresh_quarters``: partition-keyed refresh
* ``fleetlens.operators.checks.checks_suite_with_singular``: the data-quality suite
* ``fleetlens.operators.{afr,survival,trend,fleet}``: marts and measures
* ``python -m fleetlens ingest|build|check``: the same from the command line
"""

__version__ = "0.1.0"
