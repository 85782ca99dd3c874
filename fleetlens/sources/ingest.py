"""Quarterly CSV ingest into the Hive-partitioned raw zone, with reconciliation and drift history.

``ingest_quarters`` loads any number of quarters in a fixed number of Spark jobs:

1. a text scan of the drops gives, per file, the data records, the bytes and the dialect (delimiter and
   quote): a count of the rows that does not depend on the CSV parser. A second one picks the header
   lines by their hash. Where quoted fields span lines, a scan of those files carries the open quote over lines and
   splits, so that their records are counted and not their lines;
2. files of one quarter and one header are read together, all columns as strings, and
   everything is joined by column name. The CSV is parsed once, into a staged Parquet
   copy; a row with too few or too many fields is kept there as a corrupt record;
3. one aggregate over the staged copy gives per quarter the rows, the corrupt rows and, per
   column, the kinds of values met (one ``bit_or`` each). Values are recognised by strict
   patterns; what fits none stays text;
4. a quarter passes if lines and staged rows agree and no row is corrupt. Only quarters that
   pass are published (zstd, dynamic partition overwrite, so a rerun replaces its quarters and
   no other), and only after that do they enter the schema history and the drift log;
5. every quarter gets a row in the run log; a quarter that failed raises after that.

Types are those of the batch. ``read_raw_zone`` reads each quarter under its own schema and
widens columns across quarters by name, so a later batch can never make the zone unreadable.
"""

from __future__ import annotations

import csv
import re
import time
import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Fixed casts applied at ingest (everything else is inferred). Fixed values.
INGEST_CASTS = {"date": "date", "failure": "tinyint", "capacity_bytes": "bigint"}

CORRUPT = "_corrupt_record"


def is_quarter(label: str) -> bool:
    """True for a year of four ASCII digits, ``Q``, and 1 to 4."""
    year, q, number = label[:4], label[4:5], label[5:]
    return len(year) == 4 and year.isascii() and year.isdigit() and q == "Q" and number in ("1", "2", "3", "4")


def require_quarter(label: str) -> str:
    if not is_quarter(label):
        raise ValueError(f"not a quarter such as 2026Q1: {label!r}")
    return label


# --------------------------------------------------------------------------- files, headers, lines


def list_csv_files(spark: SparkSession, root: str) -> list[str]:
    """All CSV files under ``root``, at any depth, sorted. A listing: no content is read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.[cC][sS][vV]")
        .load(root)
        .select("path")
    )
    return sorted(r.path for r in files.collect())


#: Delimiters and quotes that a drop may use, in the order in which ties are decided.
DELIMITERS = (",", ";", "\t", "|")
QUOTES = ('"', "'")


@dataclass(frozen=True)
class Dialect:
    delimiter: str = ","
    quote: str = '"'
    multiline: bool = False  # a quoted field spans lines: the parser must read the file as a whole


@dataclass
class DropFile:
    path: str
    header: tuple[str, ...]
    lines: int  # data records
    size: int
    dialect: Dialect = Dialect()


def split_header(line: str | None, dialect: Dialect = Dialect()) -> tuple[str, ...]:
    """Column names of a header line; a delimiter inside quotes does not separate."""
    text = (line or "").lstrip("﻿")
    return tuple(c.strip() for c in next(csv.reader([text], delimiter=dialect.delimiter, quotechar=dialect.quote), []))


def _count_of(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark)))


def _bare(text: Column, quote: str) -> Column:
    """The text without its quoted parts."""
    return F.regexp_replace(text, f"{quote}[^{quote}]*{quote}", "")


def _drop_lines(spark: SparkSession, files: list[str]) -> DataFrame:
    """Non-empty lines with their file, split and a number that grows along each split by one a line."""
    return (
        spark.read.text(files)
        .where(F.length(F.trim("value")) > 0)
        .select(
            "value",
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_size").alias("size"),
            F.col("_metadata.file_block_start").alias("split"),
            F.monotonically_increasing_id().alias("place"),
        )
    )


def scan_files(spark: SparkSession, files: list[str]) -> dict[str, DropFile]:
    """Header, data records, bytes and dialect of every file, from two text scans (a third where quoted fields span
    lines, one more where a header holds several delimiters).

    The header is the first line of a file: the one that its first split reads first. What reaches the driver is one
    row a file.
    """
    fields = "".join(re.escape(d) for d in DELIMITERS)
    lines = _drop_lines(spark, files)
    has = [F.contains("value", F.lit(q)) for q in QUOTES]  # most lines have no quote at all
    per_file = lines.groupBy("path").agg(
        # numbers only: lines are aggregated by hash, without a sort of their texts
        F.min_by(F.xxhash64("value"), F.when(F.col("split") == 0, F.col("place"))).alias("header"),
        F.count(F.lit(1)).alias("lines"),
        F.first("size").alias("size"),
        *[F.count(F.when(h & (_count_of(F.col("value"), q) % 2 == 1), 1)).alias(f"odd{i}") for i, (q, h) in enumerate(zip(QUOTES, has))],
        # fields that are quoted as a whole
        *[
            F.count(F.when(h & F.col("value").rlike(f"(^|[{fields}]){q}[^{q}]*({q}([{fields}]|$)|$)"), 1)).alias(f"quoted{i}")
            for i, (q, h) in enumerate(zip(QUOTES, has))
        ],
    )
    rows = {_plain(r.path): r for r in per_file.collect()}
    headers = _headers(lines, {f: r.header for f, r in rows.items()})
    quotes = {f: QUOTES[1] if r.quoted1 and not r.quoted0 else QUOTES[0] for f, r in rows.items()}
    delimiters = _delimiters(spark, {f: (headers[f] or "", quotes[f]) for f in rows})
    open_ = {f: quotes[f] for f, r in rows.items() if r[f"odd{QUOTES.index(quotes[f])}"]}
    inside = _continuations(spark, open_) if open_ else {}
    out = {}
    for f in files:
        key = _plain(f)
        r = rows.get(key)
        if r is None:
            out[f] = DropFile(f, (), 0, 0)
            continue
        dialect = Dialect(delimiters[key], quotes[key], key in open_)
        out[f] = DropFile(f, split_header(headers[key], dialect), max(0, r.lines - 1 - inside.get(key, 0)), r.size, dialect)
    return out


def _headers(lines: DataFrame, hashes: dict[str, int | None]) -> dict[str, str | None]:
    """file -> header, the line of its first split whose hash is that of the first line. Where lines of a file share the
    hash but not the text, the first one is found by its place."""
    named = lines.where((F.col("split") == 0) & F.xxhash64("value").isin(sorted({h for h in hashes.values() if h is not None})))
    out: dict[str, str | None] = dict.fromkeys(hashes)
    again = []
    # as a rule one row a file: a line that repeats the header is the same row
    for r in named.select("path", "value", F.xxhash64("value").alias("hash")).distinct().collect():
        key = _plain(r.path)
        if r.hash == hashes[key]:
            again += [r.path] if out[key] is not None else []
            out[key] = r.value
    if again:
        first = F.min_by("value", F.when(F.col("split") == 0, F.col("place"))).alias("header")
        out |= {_plain(r.path): r.header for r in lines.where(F.col("path").isin(again)).groupBy("path").agg(first).collect()}
    return out


def _delimiters(spark: SparkSession, headers: dict[str, tuple[str, str]]) -> dict[str, str]:
    """file -> delimiter. A header with one kind of delimiter outside quotes decides at once; where it has several,
    the file's lines vote: the one that most lines have as often as the header, then the one with more columns."""
    counts: dict[str, dict[str, int]] = {}
    for f, (header, quote) in headers.items():
        bare = re.sub(f"{quote}[^{quote}]*{quote}", "", header)
        counts[f] = {d: bare.count(d) for d in DELIMITERS if d in bare}
    out = {f: next(iter(c), DELIMITERS[0]) for f, c in counts.items()}
    unsure = {f: c for f, c in counts.items() if len(c) > 1}
    if not unsure:
        return out
    votes = spark.createDataFrame(
        [(f, headers[f][1], [c.get(d, 0) for d in DELIMITERS]) for f, c in unsure.items()], "file string, quote string, counts array<int>"
    )
    bare = F.when(F.col("quote") == QUOTES[0], _bare(F.col("value"), QUOTES[0])).otherwise(_bare(F.col("value"), QUOTES[1]))
    lines = _drop_lines(spark, sorted(unsure)).select(F.regexp_replace("path", "^file:/*", "/").alias("file"), "value")
    lines = lines.join(votes, "file").select("file", "counts", bare.alias("bare"))
    alike = [F.count(F.when(_count_of(F.col("bare"), d) == F.col("counts")[i], 1)).alias(f"v{i}") for i, d in enumerate(DELIMITERS)]
    for r in lines.groupBy("file").agg(*alike).collect():
        choices = [(r[f"v{i}"], unsure[r.file][d], -i) for i, d in enumerate(DELIMITERS) if d in unsure[r.file]]
        out[r.file] = DELIMITERS[-max(choices)[2]]
    return out


def _continuations(spark: SparkSession, quotes: dict[str, str]) -> dict[str, int]:
    """file -> lines that continue a record: those after a line that leaves a quote open, up to the one that closes it.

    A line with an odd number of quotes opens or closes. Lines are numbered along a file by the lines of the splits before
    and the place in the split; only the odd lines are then paired by a window over the file. A quote
    that is never closed holds no line: the counts then differ, and the load fails.
    """
    lines = _drop_lines(spark, sorted(quotes)).withColumn("file", F.regexp_replace("path", "^file:/*", "/"))
    splits = lines.groupBy("file", "split").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    single = [f for f, q in quotes.items() if q == QUOTES[1]]
    marks = F.when(F.col("file").isin(single), _count_of(F.col("value"), QUOTES[1])).otherwise(_count_of(F.col("value"), QUOTES[0]))
    odd = lines.where(marks % 2 == 1).select("file", "split", "place").join(splits, ["file", "split"])
    odd = odd.select("file", (F.col("before") + F.col("place") - F.col("first")).alias("line"))
    along = Window.partitionBy("file").orderBy("line")
    paired = odd.select("file", "line", F.row_number().over(along).alias("nth"), F.lead("line").over(along).alias("next"))
    held = paired.where("nth % 2 = 1").groupBy("file").agg(F.coalesce(F.sum(F.col("next") - F.col("line")), F.lit(0)).alias("held"))
    return {r.file: r.held for r in held.collect()}


def _plain(path: str) -> str:
    """A path without the spelling differences of local URIs (``file:///a`` and ``/a``)."""
    return re.sub(r"^file:/*", "/", path)


Group = tuple[str, tuple[str, ...], Dialect]


def read_by_header(spark: SparkSession, groups: dict[Group, list[str]]) -> DataFrame:
    """(quarter, header, dialect) -> files, read as strings and joined by name, with ``quarter`` and the corrupt record.

    A quote inside a quoted field is doubled. Only files whose records span lines are read as a whole; others split.
    """
    frames = []
    for (quarter, header, dialect), paths in sorted(groups.items(), key=lambda g: (*g[0][:2], str(g[0][2]))):
        schema = StructType([StructField(c, StringType()) for c in (*header, CORRUPT)])
        df = (
            spark.read.option("header", True)
            .option("columnNameOfCorruptRecord", CORRUPT)
            .options(sep=dialect.delimiter, quote=dialect.quote, escape=dialect.quote, multiLine=dialect.multiline)
            .schema(schema)
            .csv(paths)
        )
        frames.append(df.withColumn("quarter", F.lit(quarter)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


# --------------------------------------------------------------------------- types

# Kinds of values and the patterns that recognise them, in the order tried; a date or timestamp must also be valid.
INTEGER, DECIMAL, DATE, TIMESTAMP, BOOLEAN, TEXT = 1, 2, 4, 8, 16, 32
_DAY = r"\\d{4}-\\d{2}-\\d{2}"
_PATTERNS = (
    # no leading zero: it would be lost; at most 18 digits: always a bigint
    (INTEGER, r"^-?(0|[1-9]\\d{0,17})$", None),
    (DECIMAL, r"^-?(0|[1-9]\\d*)(\\.\\d+)?([eE][+-]?\\d+)?$", "double"),
    (DATE, f"^{_DAY}$", "date"),
    (TIMESTAMP, f"^{_DAY}[ T]\\\\d{{2}}:\\\\d{{2}}:\\\\d{{2}}(\\\\.\\\\d{{1,6}})?$", "timestamp_ntz"),
    (BOOLEAN, r"^(true|false|True|False|TRUE|FALSE)$", None),
)


def kind_of(column: str) -> Column:
    """The kind of each value of a string column; NULL for NULL."""
    v = f"`{column}`"
    cases = " ".join(
        f"WHEN {v} RLIKE '{p}'" + (f" AND try_cast({v} AS {t}) IS NOT NULL" if t else "") + f" THEN {k}" for k, p, t in _PATTERNS
    )
    return F.expr(f"CASE WHEN {v} IS NULL THEN NULL {cases} ELSE {TEXT} END")


def type_of(kinds: int | None) -> str:
    """Type that holds all values of these kinds (a bit set); void where there is no value."""
    if not kinds:
        return "void"
    exact = {INTEGER: "bigint", DATE: "date", BOOLEAN: "boolean"}
    if kinds in exact:
        return exact[kinds]
    if not kinds & ~(INTEGER | DECIMAL):
        return "double"
    if not kinds & ~(DATE | TIMESTAMP):
        return "timestamp_ntz"
    return "string"


def wider(a: str, b: str) -> str:
    """The type that holds the values of both, text if nothing narrower does."""
    if a == b or b == "void":
        return a
    if a == "void":
        return b
    numbers = ("tinyint", "smallint", "int", "bigint", "double")
    if a in numbers and b in numbers:
        return max(a, b, key=numbers.index)
    if {a, b} == {"date", "timestamp_ntz"}:
        return "timestamp_ntz"
    return "string"


def _stored(t: str) -> str:
    """Parquet has no void column: text NULLs stand for it."""
    return "string" if t == "void" else t


def apply_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast each column; fixed casts first, in their order, then the rest in scan order."""
    first = [c for c in INGEST_CASTS if c in df.columns]
    rest = [c for c in df.columns if c not in first]
    return df.select(*[F.col(c).cast(_stored(types.get(c, "string"))).alias(c) for c in first + rest])


# --------------------------------------------------------------------------- run log


@dataclass
class IngestReport:
    quarter: str
    files: int
    csv_rows: int
    csv_lines: int
    corrupt_rows: int
    parquet_rows: int
    gb_in: float
    gb_out: float
    seconds: float
    columns: list[str]
    types: dict[str, str]
    drift: dict

    @property
    def ok(self) -> bool:
        return self.corrupt_rows == 0 and self.csv_rows == self.parquet_rows == self.csv_lines


class ReconciliationError(RuntimeError):
    pass


AUDIT_SCHEMA = (
    "logged_at string, quarter string, files int, csv_rows bigint, csv_lines bigint, corrupt_rows bigint, "
    "parquet_rows bigint, delta bigint, result string, gb_in double, gb_out double, seconds double"
)


def _stamp() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")


def append_audits(spark: SparkSession, audit_path: str, reports: list[IngestReport]) -> None:
    """Append one row per quarter to the Parquet run log (one write). ``seconds`` is the quarter's
    share of the batch by input bytes."""
    stamp = _stamp()
    rows = [
        (stamp, r.quarter, r.files, r.csv_rows, r.csv_lines, r.corrupt_rows, r.parquet_rows, r.parquet_rows - r.csv_lines,
         "PASS" if r.ok else "FAIL", r.gb_in, r.gb_out, r.seconds)
        for r in reports
    ]
    spark.createDataFrame(rows, AUDIT_SCHEMA).coalesce(1).write.mode("append").parquet(audit_path)


# --------------------------------------------------------------------------- schema history and drift


HISTORY_SCHEMA = "quarter string, ordinal int, column_name string, data_type string"

DRIFT_LOG_SCHEMA = (
    "logged_at string, quarter string, status string, prior_quarter string, prior_columns bigint, "
    "columns bigint, added array<string>, removed array<string>"
)


def append_drift_log(spark: SparkSession, log_path: str, drifts: list[dict]) -> None:
    """Append the drift entries of quarters that are not unchanged to the Parquet drift log, one write."""
    stamp = _stamp()
    rows = [
        (stamp, d["quarter"], d["status"], d["prior_quarter"], d["prior_columns"], d["columns"], d["added"], d["removed"])
        for d in drifts
        if d["status"] != "unchanged"
    ]
    if rows:
        spark.createDataFrame(rows, DRIFT_LOG_SCHEMA).coalesce(1).write.mode("append").parquet(log_path)


def read_history(spark: SparkSession, history_path: str) -> DataFrame | None:
    """The stored schemas, or None where none was ever stored. Any other failure is raised."""
    try:
        return spark.read.schema(HISTORY_SCHEMA).parquet(history_path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def record_schemas(
    spark: SparkSession, history_path: str, snapshots: dict[str, tuple[list[str], dict[str, str]]]
) -> dict[str, dict]:
    """Stores the columns and types of each quarter and compares each with the latest earlier one.

    Status: ``baseline`` (nothing earlier), ``changed`` (other columns, or another order),
    ``retyped`` (the quarter's own columns with other types) or ``unchanged``, which is not written
    again. One write; the differences are those of ``drift_report`` over the history so far.
    """
    old = read_history(spark, history_path)
    stored: dict[str, list[tuple[str, str]]] = {}
    for r in sorted(old.collect(), key=lambda r: (r.quarter, r.ordinal)) if old is not None else ():
        stored.setdefault(r.quarter, []).append((r.column_name, r.data_type))
    fresh = {q: [(c, types.get(c, "string")) for c in columns] for q, (columns, types) in snapshots.items()}
    status = {}
    for q, now in fresh.items():
        before = stored.get(q)
        if before == now:
            status[q] = "unchanged"
        elif before is not None and [c for c, _ in before] == [c for c, _ in now]:
            status[q] = "retyped"
        else:
            status[q] = "baseline" if min({*stored, *fresh}) == q else "changed"
    rows = [(q, i, c, t) for q in fresh if status[q] != "unchanged" for i, (c, t) in enumerate(fresh[q], start=1)]
    if rows:
        (
            spark.createDataFrame(rows, HISTORY_SCHEMA)
            .coalesce(1)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("quarter")
            .parquet(history_path)
        )
    told = {r.quarter: r for r in drift_report(read_history(spark, history_path)).collect()}
    sizes = {q: r.columns for q, r in told.items()}
    return {
        q: {
            "quarter": q,
            "status": status[q],
            "columns": told[q].columns,
            "prior_quarter": told[q].prior_quarter,
            "prior_columns": sizes.get(told[q].prior_quarter),
            "added": told[q].added,
            "removed": told[q].removed,
        }
        for q in fresh
    }


def drift_report(history: DataFrame) -> DataFrame:
    """Per quarter vs the previous stored quarter: (quarter, prior_quarter, columns, added, removed).

    Table-based, so a backfilled older quarter is diffed in place and the newer
    quarter is re-diffed against it. The window orders the distinct quarters
    (one row per quarter, a metadata-sized frame).
    """
    quarters = history.select("quarter").distinct()
    prev = quarters.withColumn("prior_quarter", F.lag("quarter").over(Window.orderBy("quarter")))
    h = history.select("quarter", "ordinal", "column_name")
    cur = h.join(prev, "quarter")
    pri = h.select(F.col("quarter").alias("prior_quarter"), F.col("column_name").alias("_pc"), F.col("ordinal").alias("_po"))
    added = (
        cur.join(pri, (cur.prior_quarter == pri.prior_quarter) & (cur.column_name == pri._pc), "left_anti")
        .where(F.col("prior_quarter").isNotNull())
        .groupBy("quarter")
        .agg(F.sort_array(F.collect_list(F.struct("ordinal", "column_name")))["column_name"].alias("added"))
    )
    cur2 = h.select(F.col("quarter").alias("_cq"), F.col("column_name").alias("_cc"))
    removed = (
        pri.join(prev, "prior_quarter")
        .join(cur2, (F.col("_cq") == F.col("quarter")) & (F.col("_cc") == F.col("_pc")), "left_anti")
        .groupBy("quarter")
        .agg(F.sort_array(F.collect_list(F.struct("_po", "_pc")))["_pc"].alias("removed"))
    )
    counts = h.groupBy("quarter").agg(F.count(F.lit(1)).alias("columns"))
    return (
        prev.join(counts, "quarter")
        .join(added, "quarter", "left")
        .join(removed, "quarter", "left")
        .select(
            "quarter",
            "prior_quarter",
            "columns",
            F.coalesce("added", F.array().cast("array<string>")).alias("added"),
            F.coalesce("removed", F.array().cast("array<string>")).alias("removed"),
        )
    )


# --------------------------------------------------------------------------- the job


def quarter_of_path(path: str) -> str | None:
    """The quarter named by a folder of the path (``quarter=2026Q1`` or ``2026Q1``), innermost wins."""
    for folder in reversed(path.split("/")[:-1]):
        label = folder.removeprefix("quarter=")
        if is_quarter(label):
            return label
    return None


def _partition_bytes(spark: SparkSession, raw_root: str, quarters: Iterable[str]) -> dict[str, int]:
    """Bytes of the Parquet files of each quarter (a listing)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(raw_root)
    sizes = files.where(F.col("quarter").isin(list(quarters))).groupBy("quarter").agg(F.sum("length").alias("n"))
    return {r.quarter: r.n for r in sizes.collect()}


def ingest_quarters(spark: SparkSession, sources: dict[str, list[str]], raw_root: str, meta_root: str) -> list[IngestReport]:
    """Load quarter -> CSV files into ``raw_root`` (see module doc); one report per quarter.

    A quarter that does not pass leaves the raw zone, the schema history and the drift log as
    they were; after the run log is written it raises ``ReconciliationError``.
    """
    t0 = time.perf_counter()
    sources = {require_quarter(q): sorted(fs) for q, fs in sorted(sources.items()) if fs}
    if not sources:
        raise FileNotFoundError("no CSV files to ingest")
    drops = scan_files(spark, [f for fs in sources.values() for f in fs])
    groups: dict[Group, list[str]] = {}
    q_columns: dict[str, list[str]] = {}
    for q, files in sources.items():
        for f in files:
            groups.setdefault((q, drops[f].header, drops[f].dialect), []).append(f)
        q_columns[q] = list(dict.fromkeys(c for f in files for c in drops[f].header))
    columns = list(dict.fromkeys(c for cs in q_columns.values() for c in cs))

    # a folder of this load: another one may run beside it
    stage = f"{meta_root.rstrip('/')}/_staging/load={uuid.uuid4().hex}"
    strings = read_by_header(spark, groups).select(*columns, CORRUPT, "quarter")
    strings.write.mode("overwrite").option("compression", "zstd").parquet(stage)
    staged = spark.read.schema(strings.schema).parquet(stage)

    # a fixed cast needs no kinds
    kinds = [F.bit_or(kind_of(c)).alias(f"k{i}") for i, c in enumerate(columns) if c not in INGEST_CASTS]
    facts = {
        r["quarter"]: r
        for r in staged.groupBy("quarter").agg(F.count(F.lit(1)).alias("_rows"), F.count(CORRUPT).alias("_corrupt"), *kinds).collect()
    }
    csv_rows = {q: facts[q]["_rows"] if q in facts else 0 for q in sources}
    corrupt = {q: facts[q]["_corrupt"] if q in facts else 0 for q in sources}
    csv_lines = {q: sum(drops[f].lines for f in files) for q, files in sources.items()}
    good = [q for q in sources if not corrupt[q] and csv_rows[q] == csv_lines[q]]

    seen = {
        q: {c: INGEST_CASTS.get(c) or type_of(facts[q][f"k{i}"] if q in facts else None) for i, c in enumerate(columns)} for q in sources
    }
    types = {c: reduce(wider, (seen[q][c] for q in good), "void") for c in columns}
    written: dict[str, int] = {}
    sizes: dict[str, int] = {}
    if good:
        typed = apply_types(staged.where(F.col("quarter").isin(good)).drop(CORRUPT), types)
        (
            typed.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", "zstd")
            .partitionBy("quarter")
            .parquet(raw_root)
        )
        counts = spark.read.schema("quarter string").parquet(raw_root).where(F.col("quarter").isin(good)).groupBy("quarter").count()
        written = {r.quarter: r["count"] for r in counts.collect()}
        sizes = _partition_bytes(spark, raw_root, good)
    # the staged copy goes: an empty table takes its place
    spark.createDataFrame([], strings.schema).coalesce(1).write.mode("overwrite").parquet(stage)

    done = [q for q in good if written.get(q, 0) == csv_rows[q]]
    # a quarter is written under the batch's types, so those are what the history holds
    drift = record_schemas(spark, f"{meta_root}/schema_history", {q: (q_columns[q], types) for q in done}) if done else {}
    append_drift_log(spark, f"{meta_root}/schema_drift_log", [drift[q] for q in done])

    seconds, total = time.perf_counter() - t0, sum(d.size for d in drops.values()) or 1
    reports = []
    for q, files in sources.items():
        size = sum(drops[f].size for f in files)
        reports.append(
            IngestReport(q, len(files), csv_rows[q], csv_lines[q], corrupt[q], written.get(q, 0), size / 1e9,
                         sizes.get(q, 0) / 1e9, seconds * size / total, q_columns[q], {c: types[c] for c in q_columns[q]},
                         drift.get(q, {"quarter": q, "status": "failed"}))
        )
    append_audits(spark, f"{meta_root}/ingest_log", reports)
    bad = [r for r in reports if not r.ok]
    if bad:
        raise ReconciliationError(
            "; ".join(
                f"{r.quarter}: {r.csv_lines} lines, {r.csv_rows} rows of which {r.corrupt_rows} corrupt, {r.parquet_rows} published"
                for r in bad
            )
        )
    return reports


def ingest_quarter(spark: SparkSession, quarter: str, csv_dir: str, raw_root: str, meta_root: str) -> IngestReport:
    """One quarter: every CSV under ``csv_dir`` (recursively) -> ``raw_root/quarter=Q``."""
    files = list_csv_files(spark, csv_dir)
    if not files:
        raise FileNotFoundError(f"no CSV files under {csv_dir}")
    return ingest_quarters(spark, {quarter: files}, raw_root, meta_root)[0]


def ingest_landing(spark: SparkSession, landing_root: str, raw_root: str, meta_root: str) -> list[IngestReport]:
    """Every quarter found under ``landing_root`` (folders ``quarter=YYYYQn`` or ``YYYYQn``), as one batch."""
    sources: dict[str, list[str]] = {}
    for f in list_csv_files(spark, landing_root):
        q = quarter_of_path(f)
        if q is None:
            raise ValueError(f"cannot tell the quarter of {f}: put it under a quarter=YYYYQn folder")
        sources.setdefault(q, []).append(f)
    return ingest_quarters(spark, sources, raw_root, meta_root)


# --------------------------------------------------------------------------- reading


def read_raw_zone(spark: SparkSession, raw_root: str, quarters: list[str] | None = None) -> DataFrame:
    """The raw zone, or some of its quarters, joined by column name.

    Each quarter is read under its own schema (one footer per quarter, and only of the quarters
    asked for), quarters of one schema together; a column's type is the widest of the quarters
    read, and a column that a quarter lacks, or holds no value of, is NULL there.
    """
    names = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(raw_root).select("path", "quarter")
    if quarters:
        names = names.where(F.col("quarter").isin(quarters))
    first = names.groupBy("quarter").agg(F.min("path").alias("path")).orderBy("quarter").collect()
    if not first:
        raise FileNotFoundError(f"no quarter to read under {raw_root}")
    root = raw_root.rstrip("/")
    groups: dict[tuple[tuple[str, str], ...], list[str]] = {}
    for r in first:
        fields = spark.read.parquet(r.path).schema.fields
        groups.setdefault(tuple((f.name, f.dataType.simpleString()) for f in fields), []).append(r.quarter)
    columns: dict[str, str] = {}
    for fields in groups:
        for name, t in fields:
            columns[name] = wider(columns[name], t) if name in columns else t
    if len(groups) > 1:
        # text may only stand for a column without any value: then the others' type holds
        for name in [c for c, t in columns.items() if t == "string"]:
            types = {t for fields in groups for c, t in fields if c == name}
            if len(types) > 1:
                texts = [(fields, qs) for fields, qs in groups.items() if (name, "string") in fields]
                frames = [_quarters_frame(spark, root, fields, qs).select(name) for fields, qs in texts]
                if all(f.where(F.col(name).isNotNull()).isEmpty() for f in frames):
                    columns[name] = reduce(wider, types - {"string"})
    frames = []
    for fields, qs in groups.items():
        # one schema for all quarters: nothing to tell apart
        df = _quarters_frame(spark, root, fields, qs if quarters or len(groups) > 1 else None)
        frames.append(df.select(*[F.col(c).cast(columns[c]).alias(c) for c, _ in fields], "quarter"))
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return out.select(*columns, "quarter")


def _quarters_frame(spark: SparkSession, root: str, fields: tuple[tuple[str, str], ...], quarters: list[str] | None) -> DataFrame:
    """Some quarters of one schema, pruned by partition; None for all."""
    schema = ", ".join(f"`{c}` {t}" for c, t in (*fields, ("quarter", "string")))
    df = spark.read.schema(schema).parquet(root)
    return df.where(F.col("quarter").isin(quarters)) if quarters else df
