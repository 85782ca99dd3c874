"""Drops of another delimiter or quote, and records that span lines."""

from __future__ import annotations

import pytest

from fleetlens.sources import ingest


def land(root, name, text):
    import os

    os.makedirs(root, exist_ok=True)
    with open(f"{root}/{name}", "w", encoding="utf-8", newline="") as f:
        f.write(text)


def load(spark, scratch, quarter="2024Q1"):
    return ingest.ingest_quarter(spark, quarter, f"{scratch}/csv", f"{scratch}/raw", f"{scratch}/meta")


def rows(spark, scratch, *columns):
    df = ingest.read_raw_zone(spark, f"{scratch}/raw").select(*columns)
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_records_over_several_lines_reconcile(spark, scratch):
    text = 'date,serial_number,note\n2024-01-01,A,"one\ntwo, ""three""\n\nfour"\n2024-01-02,B,plain\n2024-01-03,C,"x\ny"\n'
    land(f"{scratch}/csv", "a.csv", text)
    land(f"{scratch}/csv", "b.csv", "date,serial_number,note\n2024-01-04,D,single\n")
    report = load(spark, scratch)
    assert (report.csv_lines, report.csv_rows, report.parquet_rows, report.corrupt_rows) == (4, 4, 4, 0)
    assert rows(spark, scratch, "serial_number", "note") == [
        ("A", 'one\ntwo, "three"\n\nfour'), ("B", "plain"), ("C", "x\ny"), ("D", "single"),
    ]


@pytest.mark.parametrize("mark", [";", "\t", "|"])
def test_other_delimiters(spark, scratch, mark):
    lines = [["date", "serial_number", "price, net", "failure"], ["2024-01-01", "A", "1,5", "0"], ["2024-01-02", "B", "2,5", "1"]]
    land(f"{scratch}/csv", "a.csv", "".join(mark.join(x) + "\r\n" for x in lines))
    land(f"{scratch}/csv", "b.csv", 'date,serial_number,failure,"price, net"\n2024-01-03,C,0,"3,5"\n')
    assert load(spark, scratch).ok
    assert rows(spark, scratch, "serial_number", "`price, net`", "failure") == [("A", "1,5", 0), ("B", "2,5", 1), ("C", "3,5", 0)]


def test_lines_vote_where_the_header_has_several_delimiters(spark, scratch):
    land(f"{scratch}/csv", "a.csv", "serial_number;size, GB;note | more\nA;1;x\nB;2;y\n")
    land(f"{scratch}/csv", "b.csv", "serial_number,a;b,c;d;e\nC,1,2\n")
    found = ingest.scan_files(spark, ingest.list_csv_files(spark, f"{scratch}/csv"))
    assert [d.header for _, d in sorted(found.items())] == [("serial_number", "size, GB", "note | more"), ("serial_number", "a;b", "c;d;e")]


def test_single_quotes(spark, scratch):
    land(f"{scratch}/csv", "a.csv", "serial_number;note\n'A';'it is; one\nand two'\n'B';'two'\n")
    land(f"{scratch}/csv", "b.csv", "serial_number;note\nC;it's one\nD;it's two\n")
    assert load(spark, scratch).csv_lines == 4
    assert rows(spark, scratch, "serial_number", "note") == [("A", "it is; one\nand two"), ("B", "two"), ("C", "it's one"), ("D", "it's two")]


def test_quotes_are_carried_over_splits(spark, scratch):
    """A file of many splits: the same count whatever its pieces."""
    body = "".join(f'S{i},"line one of {i}\nline, two\n\nline three"\nT{i},plain\n' for i in range(3000))
    land(f"{scratch}/csv", "a.csv", "serial_number,note\n" + body)
    files = ingest.list_csv_files(spark, f"{scratch}/csv")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("1000", "7919", "64000"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            (drop,) = ingest.scan_files(spark, files).values()
            assert drop.lines == 6000 and drop.dialect.multiline and drop.header == ("serial_number", "note")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("bad", ["2024-01-01;A\n", "2024-01-01;A;x;y\n", '2024-01-01;A;"never closed\n2024-01-02;B;z\n'])
def test_ragged_rows_still_fail(spark, scratch, bad):
    land(f"{scratch}/csv", "a.csv", "date;serial_number;note\n2024-01-05;Z;ok\n" + bad)
    with pytest.raises(ingest.ReconciliationError):
        load(spark, scratch)


def test_plain_files_still_split(spark, scratch):
    land(f"{scratch}/csv", "a.csv", 'a,b\n1,"x, y"\n2,"say ""hi"""\n')
    (drop,) = ingest.scan_files(spark, ingest.list_csv_files(spark, f"{scratch}/csv")).values()
    assert drop.dialect == ingest.Dialect() and drop.lines == 2
