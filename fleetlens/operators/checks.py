"""Data-quality checks as Spark jobs: generic tests, singular tests, reconciliations.

``run_checks`` counts offending rows, ``failing_rows`` returns them.

* Column checks (not_null, accepted_values, expressions) of a table are one aggregate over it, or none: ``observed``
  counts them with ``DataFrame.observe`` while the table is written, so that no scan is added.
* The unique checks of all tables are one grouped pass over (check, key), the relationship checks one
  anti-join of (check, key) counts, whatever their number. A key that needs no shuffle (``via``) is grouped on its own.
* For the rows themselves, one pass over a table tags each row with the array of the rules it breaks.

Nothing is collected except the final one-row-per-check summary and the observed counts.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from fleetlens.config import DRIVE_TYPES, STATUSES
from fleetlens.functions.columns import afr_pct
from fleetlens.sources.files import keep_readable


@dataclass(frozen=True)
class CheckSpec:
    """One test. kind: not_null | unique | accepted_values | relationships | expression."""

    kind: str
    table: str
    column: str
    severity: str = "error"
    values: tuple = ()
    to_table: str = ""
    to_column: str = ""
    predicate: str = ""  # expression kind: SQL boolean that marks an offending row (Spark and DuckDB)
    name: str = ""
    # unique kind: columns the key is an injective function of; grouping by them is the
    # same test, and needs no shuffle on a table bucketed by their first column
    via: tuple = ()

    @property
    def check_name(self) -> str:
        if self.name:
            return self.name
        base = f"{self.kind}:{self.table}.{self.column}"
        if self.kind == "relationships":
            base += f"->{self.to_table}.{self.to_column}"
        return base


def _nn(table: str, *cols: str) -> list[CheckSpec]:
    return [CheckSpec("not_null", table, c) for c in cols]


def _acc(table: str, col: str, values, severity: str = "error") -> CheckSpec:
    return CheckSpec("accepted_values", table, col, severity, values=tuple(values))


def _rel(table: str, col: str, to_table: str, to_col: str) -> CheckSpec:
    return CheckSpec("relationships", table, col, to_table=to_table, to_column=to_col)


# The suite (the reference's generic tests per model, plus the D1 temperature bound).
TEMPERATURE_BOUNDS = (0, 100)  # degrees Celsius; the blueprint names the test but gives no bounds

# Which columns are checked for what is the contract of the tables.
WAREHOUSE_SUITE: list[CheckSpec] = (
    _nn("stg_drive_stats", "snapshot_date", "serial_number", "model", "failure_flag")
    + [_acc("stg_drive_stats", "failure_flag", (0, 1))]
    + _nn("int_drive_spans", "serial_number", "first_seen", "last_seen", "observed_days",
          "final_day_failure_flag", "censoring_status")
    + [CheckSpec("unique", "int_drive_spans", "serial_number"),
       _acc("int_drive_spans", "final_day_failure_flag", (0, 1)),
       _acc("int_drive_spans", "censoring_status", STATUSES)]
    + _nn("dim_drive", "serial_number", "model", "capacity_bytes", "first_seen", "last_seen", "drive_days", "status")
    + [CheckSpec("unique", "dim_drive", "serial_number"), _rel("dim_drive", "model", "dim_model", "model"),
       _acc("dim_drive", "status", STATUSES)]
    + _nn("dim_model", "model", "manufacturer", "capacity_bytes", "capacity_class", "fleet_drive_count", "drive_type")
    + [CheckSpec("unique", "dim_model", "model"), _acc("dim_model", "drive_type", DRIVE_TYPES)]
    + _nn("dim_date", "date_day", "year_number", "quarter_number", "quarter_label", "month_number")
    + [CheckSpec("unique", "dim_date", "date_day"), _acc("dim_date", "quarter_number", (1, 2, 3, 4))]
    + _nn("fct_drive_daily", "drive_day_key", "serial_number", "snapshot_date", "failure_flag")
    # drive_day_key = serial || '|' || ISO date: the date suffix has a fixed width, so
    # the key is injective in (serial, date) and uniqueness can be tested on them.
    + [CheckSpec("unique", "fct_drive_daily", "drive_day_key", via=("serial_number", "snapshot_date")),
       _rel("fct_drive_daily", "serial_number", "dim_drive", "serial_number"),
       _rel("fct_drive_daily", "snapshot_date", "dim_date", "date_day"),
       _acc("fct_drive_daily", "failure_flag", (0, 1))]
    + _nn("fct_failures", "failure_event_key", "serial_number", "failure_date")
    + [CheckSpec("unique", "fct_failures", "failure_event_key"), CheckSpec("unique", "fct_failures", "serial_number"),
       _rel("fct_failures", "serial_number", "dim_drive", "serial_number"),
       _rel("fct_failures", "failure_date", "dim_date", "date_day")]
    + _nn("mart_model_afr_quarterly", "model_quarter_key", "model", "quarter_label", "manufacturer",
          "capacity_class", "drive_count", "drive_days", "failures", "afr_pct")
    + [CheckSpec("unique", "mart_model_afr_quarterly", "model_quarter_key"),
       _rel("mart_model_afr_quarterly", "model", "dim_model", "model")]
    + [
        CheckSpec("expression", "mart_model_afr_quarterly", "afr_pct", "warn",
                  predicate="afr_pct < 0 or afr_pct > 50", name="afr_pct_reasonable"),
        CheckSpec("expression", "dim_drive", "capacity_bytes", "error",
                  predicate="capacity_bytes is null or capacity_bytes <= 0", name="dim_drive_capacity_positive"),
        CheckSpec("expression", "stg_drive_stats", "quarter", "warn",
                  predicate="quarter <> concat(cast(year(snapshot_date) as string), 'Q', "
                  "cast(quarter(snapshot_date) as string))",
                  name="quarter_label_matches_partition"),
        CheckSpec("expression", "stg_drive_stats", "smart_194_temperature_celsius_raw", "warn",
                  predicate=f"smart_194_temperature_celsius_raw < {TEMPERATURE_BOUNDS[0]} "
                  f"or smart_194_temperature_celsius_raw > {TEMPERATURE_BOUNDS[1]}",
                  name="temperature_within_bounds"),
    ]
)


# --------------------------------------------------------------------------- offending rows


def unique_failures(df: DataFrame, column: str, via: tuple = ()) -> DataFrame:
    """Duplicated non-NULL key values with their counts (hash aggregate, partial counts).

    ``via``: group by these columns instead of the key (same test when the key is an
    injective function of them); on a table bucketed by ``via[0]`` this needs no shuffle.
    """
    keys = list(via) if via else [column]
    return df.where(F.col(column).isNotNull()).groupBy(*keys).count().where(F.col("count") > 1)


def orphan_row_count(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """One row: the number of non-NULL child rows whose key has no parent.

    The child is first reduced to (key, rows) with map-side partial counts, so a
    fact-to-dimension check shuffles one row per key and map task, not every fact
    row; the anti-join then runs at dimension size.
    """
    per_key = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_rows"))
    keys = parent.select(F.col(parent_column).alias(column))
    return per_key.join(keys, column, "left_anti").agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("_orphans"))


def failure_only_on_last_seen(stg: DataFrame, spans_df: DataFrame) -> DataFrame:
    """Failure rows dated before the drive's last_seen."""
    s = spans_df.select("serial_number", "last_seen")
    return (
        stg.where(F.col("failure_flag") == 1)
        .join(s, "serial_number")
        .where(F.col("snapshot_date") != F.col("last_seen"))
        .select("serial_number", "snapshot_date", "last_seen")
    )


# --------------------------------------------------------------------------- runner


def _status(failing: Column, severity: Column) -> Column:
    return F.when(failing == 0, F.lit("pass")).when(severity == "warn", F.lit("warn")).otherwise(F.lit("fail"))


def _summary_row(df: DataFrame, spec: CheckSpec, count_expr: Column) -> DataFrame:
    return df.agg(count_expr.cast("bigint").alias("failing_rows")).select(
        F.lit(spec.check_name).alias("check_name"),
        F.lit(spec.table).alias("table_name"),
        F.lit(spec.kind).alias("kind"),
        F.lit(spec.severity).alias("severity"),
        "failing_rows",
    )


def breaks(spec: CheckSpec) -> Column | None:
    """True for a row that breaks a column check; None for a kind that looks at more than one row."""
    if spec.kind == "not_null":
        return F.col(spec.column).isNull()
    if spec.kind == "accepted_values":
        return ~F.col(spec.column).isin(list(spec.values))
    if spec.kind == "expression":
        return F.expr(spec.predicate)
    if spec.kind in ("unique", "relationships"):
        return None
    raise ValueError(f"unknown check kind {spec.kind}")


def column_checks(table: str, suite: list[CheckSpec]) -> list[CheckSpec]:
    return [s for s in suite if s.table == table and breaks(s) is not None]


def observed(df: DataFrame, specs: list[CheckSpec]) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """``df`` with the column checks counted as it is written (or read by any one action), and a function that
    returns check name -> offending rows after that action."""
    if not specs:
        return df, dict
    seen = Observation()
    metrics = [F.count(F.when(breaks(s), 1)).alias(f"c{i}") for i, s in enumerate(specs)]
    return df.observe(seen, *metrics), lambda: {s.check_name: seen.get[f"c{i}"] for i, s in enumerate(specs)}


_SUMMARY = "check_name string, table_name string, kind string, severity string"


def _counted(like: DataFrame, specs: list[CheckSpec], counts: DataFrame) -> DataFrame:
    """A summary row for each of ``specs``; ``counts`` has (check_name, failing_rows) of those that fail."""
    named = like.sparkSession.createDataFrame([(s.check_name, s.table, s.kind, s.severity) for s in specs], _SUMMARY)
    joined = named.join(counts, "check_name", "left")
    return joined.select(*named.columns, F.coalesce("failing_rows", F.lit(0)).cast("bigint").alias("failing_rows"))


def _keys(df: DataFrame, keys: list[tuple[CheckSpec, str]]) -> DataFrame:
    """(check_name, key) of every non-NULL key of each row: one pass for all checks of a table."""
    each = [F.struct(F.lit(s.check_name).alias("check_name"), F.col(c).cast("string").alias("key")) for s, c in keys]
    return df.select(F.explode(F.array(*each)).alias("k")).select("k.*").where(F.col("key").isNotNull())


def _by_table(specs: list[CheckSpec], key: Callable[[CheckSpec], str]) -> dict[str, list[CheckSpec]]:
    out: dict[str, list[CheckSpec]] = {}
    for s in specs:
        out.setdefault(key(s), []).append(s)
    return out


def _unique_counts(tables: dict[str, DataFrame], specs: list[CheckSpec]) -> DataFrame:
    """(check_name, failing_rows): duplicated keys of each check."""
    parts = [_keys(tables[t], [(s, s.column) for s in own]) for t, own in _by_table(specs, lambda s: s.table).items()]
    twice = reduce(DataFrame.unionByName, parts).groupBy("check_name", "key").count().where(F.col("count") > 1)
    return twice.groupBy("check_name").agg(F.count(F.lit(1)).alias("failing_rows"))


def _orphan_counts(tables: dict[str, DataFrame], specs: list[CheckSpec]) -> DataFrame:
    """(check_name, failing_rows): child rows without a parent. Children are counted by key map-side first, so
    a fact sends one row per key and task."""
    children = [_keys(tables[t], [(s, s.column) for s in own]) for t, own in _by_table(specs, lambda s: s.table).items()]
    parents = [_keys(tables[t], [(s, s.to_column) for s in own]) for t, own in _by_table(specs, lambda s: s.to_table).items()]
    rows = reduce(DataFrame.unionByName, children).groupBy("check_name", "key").agg(F.count(F.lit(1)).alias("rows"))
    orphans = rows.join(reduce(DataFrame.unionByName, parents), ["check_name", "key"], "left_anti")
    return orphans.groupBy("check_name").agg(F.sum("rows").alias("failing_rows"))


def run_checks(
    tables: dict[str, DataFrame], suite: list[CheckSpec] = WAREHOUSE_SUITE, counts: dict[str, int] | None = None
) -> DataFrame:
    """Summary (check_name, table_name, kind, severity, failing_rows, status), one row per check.

    ``counts``: what was ``observed`` when the tables were written; those checks cost nothing here. The other
    column checks of a table share one aggregate (one scan), unpivoted with ``stack``.
    """
    counts = counts or {}
    parts: list[DataFrame] = []
    by_table: dict[str, list[CheckSpec]] = {}
    told = [s for s in suite if s.check_name in counts]
    for spec in suite:
        if breaks(spec) is not None and spec.check_name not in counts:
            by_table.setdefault(spec.table, []).append(spec)
    grouped = [s for s in suite if s.kind == "unique" and not s.via]
    related = [s for s in suite if s.kind == "relationships"]
    any_table = next(iter(tables.values()))
    if told:
        rows = [(s.check_name, s.table, s.kind, s.severity, counts[s.check_name]) for s in told]
        parts.append(any_table.sparkSession.createDataFrame(rows, f"{_SUMMARY}, failing_rows bigint"))
    if grouped:
        parts.append(_counted(any_table, grouped, _unique_counts(tables, grouped)))
    if related:
        parts.append(_counted(any_table, related, _orphan_counts(tables, related)))
    for spec in suite:
        if spec.kind == "unique" and spec.via:
            parts.append(_summary_row(unique_failures(tables[spec.table], spec.column, spec.via), spec, F.count(F.lit(1))))
    for table, specs in by_table.items():
        totals = tables[table].agg(*[F.count(F.when(breaks(s), 1)).cast("bigint").alias(f"c{i}") for i, s in enumerate(specs)])
        stack_args = ", ".join(f"'{s.check_name}', '{s.table}', '{s.kind}', '{s.severity}', c{i}" for i, s in enumerate(specs))
        parts.append(
            totals.selectExpr(f"stack({len(specs)}, {stack_args}) as (check_name, table_name, kind, severity, failing_rows)")
        )
    out = reduce(DataFrame.unionByName, parts)
    return out.withColumn("status", _status(F.col("failing_rows"), F.col("severity")))


# --------------------------------------------------------------------------- the rows themselves


def tag_rows(df: DataFrame, specs: list[CheckSpec], out: str = "broken") -> DataFrame:
    """``df`` with the array of the names of the column checks that each row breaks (empty where it breaks none)."""
    names = [F.when(breaks(s), F.lit(s.check_name)) for s in specs]
    found = F.filter(F.array(*names), lambda x: x.isNotNull()) if names else F.array().cast("array<string>")
    return df.withColumn(out, found)


def failing_rows(
    tables: dict[str, DataFrame], suite: list[CheckSpec] = WAREHOUSE_SUITE, singular: dict[str, tuple[str, DataFrame]] | None = None
) -> DataFrame:
    """(check_name, table_name, kind, severity, row): every row that breaks a check, as JSON of its columns.

    A row that breaks several checks is there once for each. Column checks are one pass over a table; a unique check gives all
    rows of its duplicated keys, a relationship check the child rows without a parent; ``singular`` adds
    check name -> (table name, its rows).
    """
    parts: list[DataFrame] = []

    def rows(df: DataFrame, *named: Column) -> DataFrame:
        columns = [c for c in df.columns if c != "broken"]
        return df.select(*named, F.to_json(F.struct(*columns)).alias("row"))

    def of(spec: CheckSpec, df: DataFrame) -> DataFrame:
        return rows(df, *[F.lit(x).alias(n) for x, n in ((spec.check_name, "check_name"), (spec.table, "table_name"), (spec.kind, "kind"), (spec.severity, "severity"))])

    for table, specs in _by_table([s for s in suite if breaks(s) is not None], lambda s: s.table).items():
        tagged = tag_rows(tables[table], specs).where(F.size("broken") > 0)
        about = F.create_map(*[F.lit(x) for s in specs for x in (s.check_name, f"{s.kind}/{s.severity}")])
        parts.append(
            rows(tagged, F.explode("broken").alias("check_name")).select(
                "check_name",
                F.lit(table).alias("table_name"),
                F.split(about[F.col("check_name")], "/")[0].alias("kind"),
                F.split(about[F.col("check_name")], "/")[1].alias("severity"),
                "row",
            )
        )
    for spec in suite:
        df = tables[spec.table]
        if spec.kind == "unique":
            keys = list(spec.via) or [spec.column]
            twice = unique_failures(df, spec.column, spec.via).select(*[F.col(k).alias(f"_{k}") for k in keys])
            same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
            parts.append(of(spec, df.where(F.col(spec.column).isNotNull()).join(twice, same, "left_semi")))
        elif spec.kind == "relationships":
            parent = tables[spec.to_table].select(F.col(spec.to_column).alias("_key"))
            child = df.where(F.col(spec.column).isNotNull())
            lost = child.select(F.col(spec.column).alias("_child")).distinct().join(parent, F.col("_child") == F.col("_key"), "left_anti")
            parts.append(of(spec, child.join(lost, F.col(spec.column) == F.col("_child"), "left_semi")))
    for name, (table, df) in (singular or {}).items():
        parts.append(of(CheckSpec("singular", table, "", name=name), df))
    return reduce(DataFrame.unionByName, parts)


def write_failing_rows(df: DataFrame, path: str) -> str:
    """``failing_rows`` as a table with a partition for each check that has some."""
    df.write.mode("overwrite").option("compression", "zstd").partitionBy("check_name").parquet(path)
    keep_readable(df.sparkSession, df, path, "check_name")
    return path


# --------------------------------------------------------------------------- freshness and published figures


def source_freshness(
    df: DataFrame, date_col: str, as_of: str, warn_after_days: int = 120, error_after_days: int = 400
) -> DataFrame:
    """(max_date, as_of, age_days, status): 'pass', 'warn' (> warn days) or 'error' (> error days).

    ``as_of`` is an ISO date argument, so the result is reproducible.
    """
    m = df.agg(F.max(date_col).alias("max_date"))
    age = F.datediff(F.lit(as_of).cast("date"), F.col("max_date"))
    return m.select(
        "max_date",
        F.lit(as_of).cast("date").alias("as_of"),
        age.cast("bigint").alias("age_days"),
        F.when(F.col("max_date").isNull(), F.lit("error"))
        .when(age > error_after_days, F.lit("error"))
        .when(age > warn_after_days, F.lit("warn"))
        .otherwise(F.lit("pass"))
        .alias("status"),
    )


def reconcile_published(
    computed: DataFrame,
    published: DataFrame,
    key: str = "model",
    afr_tolerance: float = 0.01,
) -> DataFrame:
    """Computed vs published per key: drive_days, failures, afr_pct, deltas, PASS / INVESTIGATE.

    Full outer join on the key, so a model on one side only is reported (INVESTIGATE).
    ``computed`` and ``published`` both carry (key, drive_days, failures); a missing
    published afr_pct is recomputed with the same formula.
    """
    def side(df: DataFrame, tag: str) -> DataFrame:
        afr = F.col("afr_pct") if "afr_pct" in df.columns else afr_pct(F.col("failures"), F.col("drive_days"))
        return df.select(
            key,
            F.col("drive_days").cast("bigint").alias(f"{tag}_drive_days"),
            F.col("failures").cast("bigint").alias(f"{tag}_failures"),
            afr.cast("double").alias(f"{tag}_afr_pct"),
        )

    j = side(computed, "computed").join(side(published, "published"), key, "full_outer")
    same = (
        (F.col("computed_drive_days") == F.col("published_drive_days"))
        & (F.col("computed_failures") == F.col("published_failures"))
        & (F.abs(F.col("computed_afr_pct") - F.col("published_afr_pct")) <= F.lit(afr_tolerance))
    )
    return j.select(
        "*",
        (F.col("computed_drive_days") - F.col("published_drive_days")).alias("drive_days_delta"),
        (F.col("computed_failures") - F.col("published_failures")).alias("failures_delta"),
        (F.col("computed_afr_pct") - F.col("published_afr_pct")).alias("afr_pct_delta"),
        F.when(F.coalesce(same, F.lit(False)), F.lit("PASS")).otherwise(F.lit("INVESTIGATE")).alias("result"),
    )


def checks_suite_with_singular(
    tables: dict[str, DataFrame], raw: DataFrame | None = None, counts: dict[str, int] | None = None
) -> DataFrame:
    """run_checks plus the two singular tests that need a join (last-seen, row parity)."""
    summary = run_checks(tables, counts=counts)
    extra = [
        failure_only_on_last_seen(tables["stg_drive_stats"], tables["int_drive_spans"])
        .agg(F.count(F.lit(1)).cast("bigint").alias("failing_rows"))
        .select(F.lit("failure_only_on_last_seen").alias("check_name"), F.lit("stg_drive_stats").alias("table_name"),
                F.lit("singular").alias("kind"), F.lit("error").alias("severity"), "failing_rows")
    ]
    if raw is not None:
        a = tables["stg_drive_stats"].agg(F.count(F.lit(1)).alias("s"))
        extra.append(
            a.withColumn("r", raw.agg(F.count(F.lit(1))).scalar()).select(
                F.lit("row_parity_stg_vs_raw").alias("check_name"), F.lit("stg_drive_stats").alias("table_name"),
                F.lit("singular").alias("kind"), F.lit("error").alias("severity"),
                F.abs(F.col("s") - F.col("r")).cast("bigint").alias("failing_rows"),
            )
        )
    extras = reduce(DataFrame.unionByName, extra).withColumn("status", _status(F.col("failing_rows"), F.col("severity")))
    return summary.unionByName(extras)
