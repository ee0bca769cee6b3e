from __future__ import annotations

import hashlib
from pathlib import Path
from urllib.parse import unquote, urlparse

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from clicktide.schemas import EVENTS_CSV, NESTED_EVENTS
from clicktide.session import scratch_path
from clicktide.sources.flat import read_events
from clicktide.sources import landing
from clicktide.sources.landing import changed_ranges, file_ranges, land, manifest
from clicktide.sources.shards import scan_days, validate_range
from clicktide.sources import tables
from clicktide.sources.tables import is_foldered, replace_partitions, rewrite_partitions, rewrite_table, write_table

from conftest import as_set, event, event_rows, events_of, plan_of, write_csv

FIRST, LAST = "20201101", "20210131"


@pytest.mark.parametrize(
    "start,end",
    [
        ("20201031", "20201120"),  # begins a day early
        ("20210102", "20210103x"),
        ("20201215", "20201214"),
        ("20210130", "20230101"),
        ("20201199", "20201231"),  # no such day
        ("2020111", "20201231"),
    ],
)
def test_invalid_ranges(start, end):
    with pytest.raises(ValueError):
        validate_range(start, end, FIRST, LAST)


def test_valid_range():
    lo, hi = validate_range(FIRST, LAST, FIRST, LAST)
    assert (hi - lo).days == 91


def nested_row(day):
    return (day, 0, "page_view", "u", None, None, None, None, None, None)


def test_scan_opens_only_the_days_asked_for(spark, tmp_path):
    path = str(tmp_path / "nested")
    days = ["20201101", "20201102", "20201103"]
    land(spark.createDataFrame([nested_row(d) for d in days], NESTED_EVENTS), path)
    df = scan_days(spark, path, "20201102", "20201103", FIRST, LAST)
    assert sorted(r.event_date for r in df.collect()) == days[1:]
    plan = plan_of(df)
    physical = plan[plan.index("== Physical Plan ==") :]
    filters = physical[physical.index("PartitionFilters") :].split("PushedFilters")[0]
    assert "20201102" in filters and "20201103" in filters


def test_landing_counts_and_refuses_nothing(spark, tmp_path):
    df = events_of(spark, [event(), event(country="Y")])
    assert land(df, str(tmp_path / "a")) == 2
    with pytest.raises(RuntimeError):
        land(df.where("country = 'nowhere'"), str(tmp_path / "b"))
    assert land(df.where("country = 'nowhere'"), str(tmp_path / "c"), require_rows=False) == 0


def test_manifest_digests_every_file(spark, tmp_path, monkeypatch):
    """The digest is that of the row ranges, whatever the size; the same rows give the same digest."""
    monkeypatch.setattr(landing, "RANGE_ROWS", 100)
    path, again = str(tmp_path / "out"), str(tmp_path / "again")
    for where in (path, again):
        land(spark.range(0, 1000, 1, 3), where, partition=None)
    rows = manifest(spark, {"events": path}, "src", FIRST, LAST).collect()
    assert sum(r.rows for r in rows) == 1000 and {r.output for r in rows} == {"events"}
    ranges = {(r.file, r.part): r.digest for r in file_ranges(spark, path).collect()}
    for r in rows:
        own = [d for (file, _), d in sorted(ranges.items()) if file == r.file]
        assert len(own) == -(-r.rows // 100) and r.digest == hashlib.sha256("".join(own).encode()).hexdigest()
        assert r.bytes == len(Path(unquote(urlparse(r.file).path)).read_bytes())
    assert len({r.digest for r in rows}) == 3
    assert {r.digest for r in manifest(spark, {"events": again}, "src", FIRST, LAST).collect()} == {r.digest for r in rows}


def test_a_changed_row_changes_its_range_only(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(landing, "RANGE_ROWS", 64)
    plain = spark.range(0, 1000, 1, 1).select("id", F.lit(None).cast("string").alias("a"), F.lit("x").alias("b"))
    changed = {
        "value": plain.withColumn("b", F.when(F.col("id") == 700, "y").otherwise(F.col("b"))),
        # The same values, one column further left: only the NULL has moved.
        "null": plain.select("id", F.when(F.col("id") == 700, "x").alias("a"), F.when(F.col("id") != 700, "x").alias("b")),
    }
    plain.write.parquet(str(tmp_path / "plain"))
    before = file_ranges(spark, str(tmp_path / "plain")).withColumn("file", F.lit("f"))
    for name, df in changed.items():
        df.write.parquet(str(tmp_path / name))
        after = file_ranges(spark, str(tmp_path / name)).withColumn("file", F.lit("f"))
        assert [tuple(r) for r in changed_ranges(before, after).collect()] == [("f", 700 // 64)]
    fewer = plain.where("id < 990")
    fewer.write.parquet(str(tmp_path / "fewer"))
    after = file_ranges(spark, str(tmp_path / "fewer")).withColumn("file", F.lit("f"))
    assert [tuple(r) for r in changed_ranges(before, after).collect()] == [("f", 15)]


def test_csv_header_must_match(spark, tmp_path):
    rows = [{("user" if k == "user_pseudo_id" else k): v for k, v in row.items()} for row in event_rows()]
    write_csv(tmp_path / "events.csv", rows)
    with pytest.raises(ValueError, match="unknown columns .'user'., missing columns .'user_pseudo_id'."):
        read_events(spark, str(tmp_path / "events.csv"))


def test_csv_columns_bind_by_name(spark, tmp_path):
    rows = [{"is_entrance": "true", **dict(reversed(row.items()))} for row in event_rows()]
    write_csv(tmp_path / "events.csv", rows)
    write_csv(tmp_path / "plain.csv", event_rows())
    got, plain = (read_events(spark, str(tmp_path / f"{n}.csv")) for n in ("events", "plain"))
    assert got.columns == plain.columns == EVENTS_CSV.fieldNames()
    assert as_set(got.drop("is_entrance")) == as_set(plain.drop("is_entrance"))
    assert got.where("is_entrance").count() == got.count() and plain.where("is_entrance IS NULL").count() == plain.count()


def test_csv_schema(spark, fixture_csv):
    df = read_events(spark, fixture_csv)
    assert df.columns == EVENTS_CSV.fieldNames() and df.count() == 20


def test_oversized_and_small_days_share_no_task(spark):
    """A day with most rows is split over several files, small days are not scattered."""
    df = spark.range(200_000).select(
        F.when(F.col("id") % 3 != 0, F.lit("2020-11-01")).otherwise(F.lit("2020-11-02")).cast("date").alias("event_date"),
        F.sha2(F.col("id").cast("string"), 256).alias("x"),
    )
    keep = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        path = scratch_path(spark, "skew")
        out = write_table(df, path, "event_date")
        files = [f for f in out.inputFiles()]
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", keep)
    assert out.count() == 200_000
    assert sum("2020-11-01" in f for f in files) > 3


def test_replaced_days_lose_old_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "event_date date, n int"
    old = spark.createDataFrame([("2020-11-01", 1), ("2020-11-02", 2), ("2020-11-03", 3)], "d string, n int")
    old = old.select(F.col("d").cast("date").alias("event_date"), "n")
    write_table(old, path, "event_date")
    days = [r[0] for r in old.orderBy("event_date").select("event_date").collect()]
    new = spark.createDataFrame([(days[0], 9)], schema)
    for _ in range(2):
        replace_partitions(new, path, "event_date", days[:2])
        got = spark.read.schema(schema).parquet(path)
        assert as_set(got.select("event_date", "n")) == {(days[0], 9), (days[2], 3)}


@pytest.mark.parametrize("folders", [64, 2])  # with fewer than there are days, Spark sorts
def test_rewriting_by_folder_keeps_rows_days_and_files(spark, tmp_path, monkeypatch, folders):
    monkeypatch.setattr(tables, "OPEN_FOLDERS", folders)
    rows = [(n, f"2021-03-{1 + n % 7:02d}" if n % 9 else None) for n in range(400)] * 2
    source, target = str(tmp_path / "source"), str(tmp_path / "target")
    df = spark.createDataFrame(rows, "n int, day string").withColumn("event_date", F.col("day").cast("date"))
    df.repartition(3).write.partitionBy("event_date").parquet(source)
    assert is_foldered(spark, source, "event_date") and not is_foldered(spark, target, "event_date")
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    read = spark.read.schema(df.schema).parquet(source)
    done = rewrite_table(read.withColumn("n", F.col("n") + 1), target, "event_date")
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    assert sorted(map(str, done.collect())) == sorted(map(str, df.withColumn("n", F.col("n") + 1).collect()))
    assert done.schema == df.schema
    assert len(list(Path(target).rglob("*.parquet"))) <= len(list(Path(source).rglob("*.parquet")))
    assert {p.name for p in Path(target).glob("event_date=*")} == {p.name for p in Path(source).glob("event_date=*")}


def test_replacing_folders_without_a_shuffle(spark, tmp_path):
    path = str(tmp_path / "table")
    write_table(spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "n int, day string"), path, "day")
    new = spark.createDataFrame([(n, "b") for n in range(4)] + [(9, None)], "n int, day string").coalesce(1)
    rewrite_partitions(new, path, "day", ["a", "b", None])
    assert as_set(spark.read.parquet(path).select("n", "day")) == {(n, "b") for n in range(4)} | {(9, None)}


def test_tables_in_folders_are_written_without_a_sort(spark, tmp_path, monkeypatch):
    """Spark sorts a task's rows by folder unless it may keep files open; the setting ends with the write."""
    name, seen, write = "spark.sql.maxConcurrentOutputFileWriters", [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda *a, **k: seen.append(spark.conf.get(name)) or write(*a, **k))
    before = spark.conf.get(name)
    rows = spark.createDataFrame([(n, str(n % 5) if n % 6 else None) for n in range(60)], "n int, day string")
    done = write_table(rows, f"{tmp_path}/t", "day")
    assert seen == [str(tables.OPEN_FOLDERS)] and spark.conf.get(name) == before
    assert as_set(done) == as_set(rows)
