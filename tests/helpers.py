"""Tiny staged frames for edge-case tests."""

from __future__ import annotations

import datetime as dt

from fleetlens.operators.contract import STAGED_COLUMNS

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"

STAGED_SCHEMA = (
    "snapshot_date date, serial_number string, model string, capacity_bytes bigint, is_capacity_sentinel boolean, "
    "failure_flag tinyint, smart_5_reallocated_sectors_raw bigint, smart_187_reported_uncorrectable_raw bigint, "
    "smart_188_command_timeout_raw bigint, smart_197_pending_sectors_raw bigint, "
    "smart_198_offline_uncorrectable_raw bigint, smart_9_power_on_hours_raw bigint, "
    "smart_194_temperature_celsius_raw bigint, pod_slot_num bigint, quarter string"
)


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def staged_rows(spark, rows: list[dict]):
    """rows: dicts with at least date, serial; defaults fill the rest."""
    out = []
    for r in rows:
        date = d(r["date"]) if r.get("date") else None
        cap = r.get("capacity", 4_000_000_000_000)
        q = f"{date.year}Q{(date.month - 1) // 3 + 1}" if date else None
        out.append((
            date, r.get("serial"), r.get("model", "ST4"), cap, (cap <= 0) if cap is not None else None,
            r.get("failure", 0), 0, 0, 0, 0, 0, r.get("hours", 100), r.get("temp", 30), r.get("slot", 1),
            r.get("quarter", q),
        ))
    df = spark.createDataFrame(out, STAGED_SCHEMA)
    assert df.columns == STAGED_COLUMNS
    return df


def int_columns(pdf):
    """Nullable integer dtypes, so NULLs do not turn integer CSV fields into '4.0'."""
    out = pdf.copy()
    for c in out.columns:
        if out[c].dtype.kind in "fi" and c not in ("date",):
            if out[c].dropna().apply(float.is_integer if out[c].dtype.kind == "f" else (lambda v: True)).all():
                out[c] = out[c].astype("Int64")
    return out
