"""Column names and parameters shared by every operator.

The operators are written against these names so that they apply to any
per-device daily telemetry, not only to the default drive layout.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class FleetColumns:
    """Names of the columns of the staged drive-day frame."""

    entity: str = "serial_number"
    date: str = "snapshot_date"
    model: str = "model"
    capacity: str = "capacity_bytes"
    sentinel: str = "is_capacity_sentinel"
    failure: str = "failure_flag"
    slot: str = "pod_slot_num"
    temperature: str = "smart_194_temperature_celsius_raw"
    power_on_hours: str = "smart_9_power_on_hours_raw"
    partition: str = "quarter"


@dataclass(frozen=True)
class AfrThresholds:
    """Inclusion rule of the AFR mart: both comparisons are strict (HAVING-style)."""

    min_drive_count: int = 100
    min_drive_days: int = 10_000


# Published cutoff of the reference report (passes no model-quarter on the small test tables).
PUBLISHED_THRESHOLDS = AfrThresholds(100, 10_000)
# Cutoff used on the test scale (sf0.01): most data model-quarters pass, some do not.
TEST_SCALE_THRESHOLDS = AfrThresholds(20, 50)

DEFAULT_COLUMNS = FleetColumns()

# SMART measures carried by the staging contract: raw name -> warehouse name.
# Fixed values (must equal the reference's contract).
SMART_RENAMES = [
    ("smart_5_raw", "smart_5_reallocated_sectors_raw"),
    ("smart_187_raw", "smart_187_reported_uncorrectable_raw"),
    ("smart_188_raw", "smart_188_command_timeout_raw"),
    ("smart_197_raw", "smart_197_pending_sectors_raw"),
    ("smart_198_raw", "smart_198_offline_uncorrectable_raw"),
    ("smart_9_raw", "smart_9_power_on_hours_raw"),
    ("smart_194_raw", "smart_194_temperature_celsius_raw"),
]
SMART_COLUMNS = [new for _, new in SMART_RENAMES]

# Censoring states of a drive span. Fixed values.
STATUS_FAILED = "failed"
STATUS_EXITED = "exited_without_failure"
STATUS_ACTIVE = "active"
STATUSES = [STATUS_FAILED, STATUS_EXITED, STATUS_ACTIVE]

DRIVE_TYPES = ["data", "boot"]
