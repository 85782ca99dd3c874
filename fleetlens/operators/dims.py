"""Dimensions: drive (with capacity repair), model (with longest-prefix manufacturer), date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.config import DEFAULT_COLUMNS, FleetColumns
from fleetlens.functions.columns import capacity_class, day_of_week_sunday0, non_sentinel, normalize_model, quarter_label
from fleetlens.operators.spans import censoring_status, decode_day_flag, encode_day_flag


# --------------------------------------------------------------------------- shared partials


def drive_model_partials(stg: DataFrame, cols: FleetColumns = DEFAULT_COLUMNS) -> DataFrame:
    """One row per (serial_number, normalized model): the only full pass over staged rows.

    Every drive and model aggregate of the dimensions merges from these partials
    (min, max, sum and count all merge), so dim_drive, dim_model and the capacity
    fallback read drive-sized rows, not drive-day rows. All buffers are fixed-width
    (the model is a grouping key, the last-day flag an encoded long), so Spark plans
    a hash aggregate with map-side partials, which absorbs a hot drive or model.
    """
    d = F.col(cols.date)
    return stg.groupBy(
        F.col(cols.entity).alias("serial_number"), normalize_model(cols.model).alias("model")
    ).agg(
        F.min(d).alias("first_seen"),
        F.max(d).alias("last_seen"),
        F.count(F.lit(1)).alias("rows"),
        F.max(encode_day_flag(d, F.col(cols.failure))).alias("last_day_code"),
        F.count(cols.slot).alias("slot_rows"),
        F.max(non_sentinel(F.col(cols.capacity), F.col(cols.sentinel))).alias("capacity_bytes"),
    )


def drive_quarter_partials(stg: DataFrame, cols: FleetColumns = DEFAULT_COLUMNS, by: tuple[str, ...] = ()) -> DataFrame:
    """One row per (serial_number, normalized model, calendar quarter of the date): what every
    drive, model, quarter and day-count measure merges from, in one pass over the staged rows.

    As ``drive_model_partials``, and with the failures of the quarter and its observed days as
    bits (day 0-63 in ``days_low``, the rest in ``days_high``), so that distinct drives per day
    need no shuffle at drive-day grain. All buffers are fixed-width. ``by``: further grouping
    columns (the partition of an incremental load).
    """
    d = F.col(cols.date)
    day = F.datediff(d, F.trunc(d, "quarter"))
    return stg.groupBy(
        F.col(cols.entity).alias("serial_number"),
        normalize_model(cols.model).alias("model"),
        quarter_label(d).alias("quarter_label"),
        *by,
    ).agg(
        F.min(d).alias("first_seen"),
        F.max(d).alias("last_seen"),
        F.count(F.lit(1)).alias("rows"),
        F.max(encode_day_flag(d, F.col(cols.failure))).alias("last_day_code"),
        F.count(cols.slot).alias("slot_rows"),
        F.max(non_sentinel(F.col(cols.capacity), F.col(cols.sentinel))).alias("capacity_bytes"),
        F.count(F.when(F.col(cols.failure) == 1, F.lit(1))).alias("failures"),
        F.bit_or(F.when(day < 64, F.call_function("shiftleft", F.lit(1).cast("long"), day))).alias("days_low"),
        F.bit_or(F.when(day >= 64, F.call_function("shiftleft", F.lit(1).cast("long"), day - 64))).alias("days_high"),
    )


def merge_quarters(quarter_partials: DataFrame) -> DataFrame:
    """``drive_model_partials`` merged from the quarter partials."""
    return quarter_partials.groupBy("serial_number", "model").agg(
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
        F.sum("rows").alias("rows"),
        F.max("last_day_code").alias("last_day_code"),
        F.sum("slot_rows").alias("slot_rows"),
        F.max("capacity_bytes").alias("capacity_bytes"),
    )


def active_drives_by_day(quarter_partials: DataFrame) -> DataFrame:
    """(snapshot_date, active_drives): distinct non-NULL serials per day, from the day bits of the
    drives' quarters (the bits of several models of a drive are merged first)."""
    bits = (
        quarter_partials.where("serial_number is not null and quarter_label is not null")
        .groupBy("serial_number", F.trunc("first_seen", "quarter").alias("start"))
        .agg(F.bit_or("days_low").alias("low"), F.bit_or("days_high").alias("high"))
    )
    # 92 candidates at most per row, counted per day before the shuffle
    return (
        bits.select("start", "low", "high", F.explode(F.sequence(F.lit(0), F.lit(91))).alias("day"))
        .where("(case when day < 64 then shiftright(low, day) else shiftright(high, day - 64) end) & 1 = 1")
        .groupBy(F.expr("date_add(start, day)").alias("snapshot_date"))
        .agg(F.count(F.lit(1)).alias("active_drives"))
    )


def model_rollup(partials: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Per normalized model (NULL included): fleet_drive_count, observations, slot_observations, capacity_bytes.

    ``capacity_bytes`` is the max non-sentinel capacity over the model's rows (the
    capacity fallback); ``fleet_drive_count`` counts distinct non-NULL serials,
    exact because the partials are unique per (serial, model). ``by``: further grouping columns that
    are functions of the serial.
    """
    return partials.groupBy(*by, "model").agg(
        F.count("serial_number").alias("fleet_drive_count"),
        F.sum("rows").alias("observations"),
        F.sum("slot_rows").alias("slot_observations"),
        F.max("capacity_bytes").alias("capacity_bytes"),
    )


def merge_model_rollups(parts: DataFrame) -> DataFrame:
    """``model_rollup`` of all drives from that of disjoint sets of drives."""
    return parts.groupBy("model").agg(
        F.sum("fleet_drive_count").alias("fleet_drive_count"),
        F.sum("observations").alias("observations"),
        F.sum("slot_observations").alias("slot_observations"),
        F.max("capacity_bytes").alias("capacity_bytes"),
    )


def drive_rollup(partials: DataFrame) -> DataFrame:
    """Per serial (NULL included): span aggregates, its model (max) and own non-sentinel capacity."""
    return partials.groupBy("serial_number").agg(
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
        F.sum("rows").alias("observed_days"),
        F.coalesce(decode_day_flag(F.max("last_day_code")), F.lit(0)).cast("int").alias("final_day_failure_flag"),
        F.max("model").alias("model"),
        F.max("capacity_bytes").alias("drive_capacity_bytes"),
    )


def model_capacity(stg: DataFrame, cols: FleetColumns = DEFAULT_COLUMNS) -> DataFrame:
    """(model, model_capacity_bytes): max non-sentinel capacity per normalized model.

    Grouped by the row's own normalized model (not the drive's), as the fallback is
    defined. Algebraic, so a hot model is absorbed by map-side partials.
    """
    return (
        stg.where(~F.col(cols.sentinel))
        .groupBy(normalize_model(cols.model).alias("model"))
        .agg(F.max(cols.capacity).alias("model_capacity_bytes"))
    )


# --------------------------------------------------------------------------- dim_drive


def dim_drive_from_partials(
    partials: DataFrame,
    grace_days: int = 0,
    drive_capacity: DataFrame | None = None,
    model_capacity_df: DataFrame | None = None,
) -> DataFrame:
    """dim_drive from (serial, model) partials; see ``dim_drive``.

    ``drive_capacity`` (serial_number, drive_capacity_bytes) and ``model_capacity_df``
    (model, model_capacity_bytes) replace the max-based capacities when given
    (the modal rule).
    """
    drives = drive_rollup(partials)
    dataset_max = drives.agg(F.max("last_seen")).scalar()  # scalar subquery, inlined once
    if model_capacity_df is None:
        fallback = model_rollup(partials).select("model", F.col("capacity_bytes").alias("model_capacity_bytes"))
    else:
        fallback = model_capacity_df
    if drive_capacity is not None:
        drives = drives.drop("drive_capacity_bytes").join(drive_capacity, "serial_number", "left")
    return dim_drive_of(drives, fallback, dataset_max, grace_days)


def dim_drive_of(drives: DataFrame, fallback: DataFrame, dataset_max: Column, grace_days: int = 0) -> DataFrame:
    """dim_drive from ``drive_rollup`` rows (all drives or some), the capacity of each model
    (model, model_capacity_bytes) and the last date of the data."""
    return (
        drives.where(F.col("serial_number").isNotNull())
        .withColumn("dataset_max_date", dataset_max)
        .join(fallback, "model", "left")
        .select(
            "serial_number",
            "model",
            F.coalesce("drive_capacity_bytes", "model_capacity_bytes").alias("capacity_bytes"),
            "first_seen",
            "last_seen",
            F.col("observed_days").alias("drive_days"),
            censoring_status(
                F.col("final_day_failure_flag"), F.col("last_seen"), F.col("dataset_max_date"), grace_days
            ).alias("status"),
        )
    )


def modal_value(df: DataFrame, key: Column, key_name: str, value: str, out: str) -> DataFrame:
    """(key_name, out): the most frequent non-NULL ``value`` per key; ties go to the larger value.

    Two steps instead of the holistic ``mode`` aggregate (per-group hash maps, which
    hung the reference's build): a hash aggregate of (key, value) counts with
    map-side partials, then a max of (count, value) over those reduced rows. A hot
    key costs one partial row per distinct value and map task.
    """
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(key.alias(key_name), F.col(value).alias("_v"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    return counts.groupBy(key_name).agg(F.max(F.struct("_n", "_v"))["_v"].alias(out))


def dim_drive(
    stg: DataFrame, cols: FleetColumns = DEFAULT_COLUMNS, capacity_rule: str = "max", grace_days: int = 0
) -> DataFrame:
    """serial_number, model, capacity_bytes (repaired), first_seen, last_seen, drive_days, status.

    Spans, drive attributes and the model fallback all merge from (serial, model) partials.
    Catalyst plans the partials once per use, so over staged rows write them first and call
    ``dim_drive_from_partials`` (as the warehouse build and the registered queries do). The inner join's effect (a NULL serial never matches)
    is the ``isNotNull`` filter. Capacity repair: the drive's own non-sentinel value,
    else its model's, else NULL. The fallback is model-sized; AQE broadcasts it when
    its measured size is under the threshold, else it is a sort-merge join.

    ``capacity_rule='mode'`` uses the modal non-sentinel capacity (per drive, and per
    model for the fallback) instead of the max; both agree while capacity is
    constant per drive and model, as in the reference's data.
    """
    partials = drive_model_partials(stg, cols)
    if capacity_rule == "max":
        return dim_drive_from_partials(partials, grace_days)
    if capacity_rule != "mode":
        raise ValueError("capacity_rule must be 'max' or 'mode'")
    ok = stg.where(~F.col(cols.sentinel))
    per_drive = modal_value(ok, F.col(cols.entity), "serial_number", cols.capacity, "drive_capacity_bytes")
    per_model = modal_value(ok, normalize_model(cols.model), "model", cols.capacity, "model_capacity_bytes")
    return dim_drive_from_partials(partials, grace_days, per_drive, per_model)


def repair_capacity(stg: DataFrame, cols: FleetColumns = DEFAULT_COLUMNS) -> DataFrame:
    """(serial_number, model, drive_capacity_bytes, model_capacity_bytes, capacity_bytes, repair_source)."""
    return repair_capacity_from_partials(drive_model_partials(stg, cols))


def repair_capacity_from_partials(partials: DataFrame) -> DataFrame:
    """``repair_capacity`` from (serial, model) partials."""
    drives = drive_rollup(partials).where(F.col("serial_number").isNotNull())
    fallback = model_rollup(partials).select("model", F.col("capacity_bytes").alias("model_capacity_bytes"))
    out = drives.join(fallback, "model", "left")
    return out.select(
        "serial_number",
        "model",
        "drive_capacity_bytes",
        "model_capacity_bytes",
        F.coalesce("drive_capacity_bytes", "model_capacity_bytes").alias("capacity_bytes"),
        F.when(F.col("drive_capacity_bytes").isNotNull(), F.lit("drive"))
        .when(F.col("model_capacity_bytes").isNotNull(), F.lit("model"))
        .otherwise(F.lit("none"))
        .alias("repair_source"),
    )


def spans_from_partials(partials: DataFrame, grace_days: int = 0) -> DataFrame:
    """int_drive_spans merged from the (serial, model) partials (NULL serial kept, as in the spans model)."""
    drives = drive_rollup(partials)
    return spans_of(drives, drives.agg(F.max("last_seen")).scalar(), grace_days)


def spans_of(drives: DataFrame, dataset_max: Column, grace_days: int = 0) -> DataFrame:
    """int_drive_spans from ``drive_rollup`` rows (all drives or some) and the last date of the data."""
    return drives.withColumn("dataset_max_date", dataset_max).select(
        "serial_number",
        "first_seen",
        "last_seen",
        "observed_days",
        "final_day_failure_flag",
        censoring_status(
            F.col("final_day_failure_flag"), F.col("last_seen"), F.col("dataset_max_date"), grace_days
        ).alias("censoring_status"),
    )


# --------------------------------------------------------------------------- longest prefix


def longest_prefix_match(
    keys: DataFrame,
    key: str,
    table: DataFrame,
    prefix: str = "model_prefix",
    value: str = "manufacturer",
    default: str | None = "Unknown",
    out: str = "manufacturer",
    broadcast_table: bool = False,
) -> DataFrame:
    """For each distinct ``key``: the ``value`` of the longest ``prefix`` that starts it.

    Semantics of ``key LIKE prefix || '%'`` ranked by ``length(prefix) desc`` (prefixes
    are literal strings). Instead of a theta join (a nested loop over keys x prefixes),
    every key is expanded into its own prefixes, lengths 0..length(key), and
    equi-joined to the table, so the join is a hash join whatever the table size.
    Ties on one length (duplicate prefixes) resolve to the max value, deterministically.
    A NULL key is kept and gets the default.
    """
    distinct_keys = keys.select(key).distinct()
    cand = distinct_keys.select(
        key, F.explode_outer(F.sequence(F.lit(0), F.length(F.col(key)))).alias("_plen")
    ).withColumn("_prefix", F.col(key).substr(F.lit(1), F.col("_plen")))
    t = table.select(F.col(prefix).alias("_prefix"), F.col(value).alias("_value"))
    if broadcast_table:
        t = F.broadcast(t)
    matched = cand.join(t, "_prefix", "left")
    best = F.max(F.when(F.col("_value").isNotNull(), F.struct(F.length("_prefix").alias("l"), F.col("_value").alias("v"))))
    res = matched.groupBy(key).agg(best["v"].alias(out))
    if default is not None:
        res = res.withColumn(out, F.coalesce(F.col(out), F.lit(default)))
    return res


# --------------------------------------------------------------------------- dim_model


def model_stats(stg: DataFrame, cols: FleetColumns = DEFAULT_COLUMNS) -> DataFrame:
    """Per normalized model: fleet_drive_count, observations, slot_observations, capacity_bytes.

    Two levels: (serial, model) partials, then per model; both algebraic, so a model
    holding a third of all rows costs one partial row per map task and drive.
    """
    return model_rollup(drive_model_partials(stg, cols))


def drive_type(slot_observations: Column, observations: Column) -> Column:
    """'data' if at least half of the observations carry a slot (exact half is 'data'), else 'boot'."""
    return F.when(slot_observations * 2 >= observations, F.lit("data")).otherwise(F.lit("boot"))


def dim_model(
    stg: DataFrame,
    seed: DataFrame,
    cols: FleetColumns = DEFAULT_COLUMNS,
    broadcast_seed: bool | None = None,
    drive_type_scope: str = "all",
) -> DataFrame:
    """model, manufacturer, capacity_bytes, capacity_class, fleet_drive_count, drive_type.

    One row per non-NULL normalized model. ``broadcast_seed=None`` broadcasts the
    seed only when it is a driver-side local relation (its size is known, e.g. the
    built-in 15 rows); a seed read from files is left to the planner / AQE size check.

    ``drive_type_scope='slot_quarters'`` counts slot share only over partitions
    (quarters) in which any row carries a slot, so a quarter loaded before the slot
    column existed cannot flip data models to 'boot'. The set of such quarters is
    one row per quarter (calendar-bounded), broadcast by a proven bound.
    """
    partials = drive_model_partials(stg, cols)
    if drive_type_scope == "all":
        return dim_model_from_partials(partials, seed, broadcast_seed)
    if drive_type_scope != "slot_quarters":
        raise ValueError("drive_type_scope must be 'all' or 'slot_quarters'")
    slot_quarters = stg.groupBy(cols.partition).agg(F.count(cols.slot).alias("_s")).where(F.col("_s") > 0)
    scoped = stg.join(F.broadcast(slot_quarters.select(cols.partition)), cols.partition, "left_semi")
    shares = scoped.groupBy(normalize_model(cols.model).alias("model")).agg(
        F.count(F.lit(1)).alias("observations"), F.count(cols.slot).alias("slot_observations")
    )
    base = dim_model_from_partials(partials, seed, broadcast_seed)
    return (
        base.join(shares, "model", "left")
        .withColumn(
            "drive_type",
            F.when(F.col("observations").isNull(), F.col("drive_type")).otherwise(
                drive_type(F.col("slot_observations"), F.col("observations"))
            ),
        )
        .select(*base.columns)
    )


def is_local_relation(df: DataFrame) -> bool:
    """True when the frame's rows already sit on the driver (a LocalRelation): a proven size."""
    return df._jdf.queryExecution().optimizedPlan().getClass().getSimpleName() == "LocalRelation"


def dim_model_from_partials(partials: DataFrame, seed: DataFrame, broadcast_seed: bool | None = None) -> DataFrame:
    """dim_model from (serial, model) partials; see ``dim_model``."""
    return dim_model_of(model_rollup(partials), seed, broadcast_seed)


def dim_model_of(stats: DataFrame, seed: DataFrame, broadcast_seed: bool | None = None) -> DataFrame:
    """dim_model from ``model_rollup`` rows; see ``dim_model``."""
    if broadcast_seed is None:
        broadcast_seed = is_local_relation(seed)
    stats = stats.where(F.col("model").isNotNull())
    maker = longest_prefix_match(stats, "model", seed, broadcast_table=broadcast_seed)
    return stats.join(maker, "model").select(
        "model",
        "manufacturer",
        "capacity_bytes",
        capacity_class(F.col("capacity_bytes")).alias("capacity_class"),
        "fleet_drive_count",
        drive_type(F.col("slot_observations"), F.col("observations")).alias("drive_type"),
    )


def manufacturer_fleet(dim_model_df: DataFrame) -> DataFrame:
    """Per manufacturer: models, data models and drives (the sum of fleet_drive_count, which
    equals the fleet's drive count when every drive maps to one model)."""
    return dim_model_df.groupBy("manufacturer").agg(
        F.count(F.lit(1)).alias("models"),
        F.count(F.when(F.col("drive_type") == "data", 1)).alias("data_models"),
        F.sum("fleet_drive_count").alias("drives"),
    )


def attribute_consistency(stg: DataFrame, cols: FleetColumns = DEFAULT_COLUMNS) -> DataFrame:
    """One row: drives carrying more than one normalized model, drives and models carrying more
    than one non-sentinel capacity. All zero means ``max`` equals the modal value.

    Each count is a two-level hash aggregate ((key, value) then key), never a set per group.
    """
    ent, model = F.col(cols.entity), normalize_model(cols.model)
    cap = non_sentinel(F.col(cols.capacity), F.col(cols.sentinel))

    def multi(key: Column, value: Column, name: str) -> Column:
        pairs = stg.where(key.isNotNull() & value.isNotNull()).select(key.alias("_k"), value.alias("_v")).distinct()
        return pairs.groupBy("_k").count().where(F.col("count") > 1).agg(F.count(F.lit(1))).scalar().alias(name)

    return stg.sparkSession.range(1).select(
        multi(ent, model, "drives_with_several_models"),
        multi(ent, cap, "drives_with_several_capacities"),
        multi(model, cap, "models_with_several_capacities"),
    )


# --------------------------------------------------------------------------- dim_date


def date_spine(stg: DataFrame, cols: FleetColumns = DEFAULT_COLUMNS) -> DataFrame:
    """Every day from min to max staged date, inclusive; NULL bounds give no rows.

    The generator runs on the one-row bounds, so its output is bounded by the
    calendar span (days), not by the data volume.
    """
    bounds = stg.agg(F.min(cols.date).alias("min_date"), F.max(cols.date).alias("max_date"))
    return bounds.select(
        F.explode(F.sequence("min_date", "max_date", F.expr("interval 1 day"))).alias("date_day")
    )


def calendar_columns(date_day: Column) -> list[Column]:
    d = date_day
    dow = day_of_week_sunday0(d)
    return [
        d.alias("date_day"),
        F.year(d).cast("bigint").alias("year_number"),
        F.quarter(d).cast("bigint").alias("quarter_number"),
        quarter_label(d).alias("quarter_label"),
        F.month(d).cast("bigint").alias("month_number"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).cast("bigint").alias("day_of_month"),
        dow.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        dow.isin(0, 6).alias("is_weekend"),
        F.weekofyear(d).cast("bigint").alias("week_of_year"),
        F.dayofyear(d).cast("bigint").alias("day_of_year"),
        F.trunc(d, "quarter").alias("first_day_of_quarter"),
        F.trunc(d, "month").alias("first_day_of_month"),
    ]


def dim_date_from_partials(partials: DataFrame) -> DataFrame:
    """``dim_date`` over the dates that the partials (of either kind) span."""
    bounds = partials.agg(F.min("first_seen").alias("a"), F.max("last_seen").alias("b"))
    days = bounds.select(F.explode(F.sequence("a", "b", F.expr("interval 1 day"))).alias("date_day"))
    return days.select(*calendar_columns(F.col("date_day")))


def dim_date(stg: DataFrame, cols: FleetColumns = DEFAULT_COLUMNS) -> DataFrame:
    """Calendar dimension over the loaded date range: 14 columns, one row per day."""
    return date_spine(stg, cols).select(*calendar_columns(F.col("date_day")))
