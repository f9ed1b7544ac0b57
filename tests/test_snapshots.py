"""Replaces that die half-way, and tables replaced from themselves."""

import pytest
from pyspark.sql import functions as F

from barlake.sources import files, snapshots


def rows(df):
    return sorted(r[0] for r in df.collect())


def frame(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v int")


def test_a_write_killed_half_way_leaves_the_old_snapshot(spark, tmp_path):
    path = str(tmp_path / "table")
    files.write_table(frame(spark, 1, 2), path)
    # one task writes its rows, the other fails
    bad = spark.range(0, 10, 1, 2).select(
        F.when(F.col("id") < 9, F.col("id")).otherwise(F.raise_error(F.lit("lost")).cast("bigint")).cast("int").alias("v"))
    with pytest.raises(Exception, match="lost"):
        files.write_table(bad, path)
    assert rows(files.read_table(spark, path)) == [1, 2]
    files.write_table(frame(spark, 3), path)
    assert rows(files.read_table(spark, path)) == [3]


def test_a_table_is_replaced_from_itself(spark, tmp_path):
    path = str(tmp_path / "table")
    df = files.write_table(frame(spark, 1, 2), path)
    for _ in range(3):
        df = files.write_table(df.select((F.col("v") * 2).alias("v")), path)
    assert rows(df) == [8, 16] == rows(files.read_table(spark, path))


def test_a_reader_keeps_its_snapshot_over_one_replace(spark, tmp_path):
    path = str(tmp_path / "table")
    first = files.write_table(frame(spark, 1), path)
    files.write_table(frame(spark, 2), path)
    assert rows(first) == [1]
    third = files.write_table(frame(spark, 3), path)
    kept = snapshots.published(spark, path)
    assert len(kept) == snapshots.KEEP and third.inputFiles()[0].split("/")[-2] == kept[0]
    assert {p.name for p in (tmp_path / "table").iterdir() if p.name.startswith("snapshot")} == set(kept)


def test_a_failed_first_write_leaves_no_table(spark, tmp_path):
    path = str(tmp_path / "table")
    with pytest.raises(Exception, match="lost"):
        files.write_table(frame(spark, 1).select(F.raise_error(F.lit("lost")).cast("int").alias("v")), path)
    assert snapshots.published(spark, path) == [] and snapshots.location(spark, path) == path


def test_skip_when_empty_keeps_the_table(spark, tmp_path):
    path = str(tmp_path / "table")
    assert files.write_if_not_empty(frame(spark, 5), path)
    assert not files.write_if_not_empty(frame(spark), path)
    assert rows(files.read_table(spark, path)) == [5]


def test_landed_files_are_read_as_they_are(spark, tmp_path):
    (tmp_path / "t.csv").write_text("ticker,name,sector,market,type,source,etf\nA,a,,US,stock,spdr,X\n")
    assert [r.ticker for r in files.read_tickers_csv(spark, str(tmp_path / "t.csv")).collect()] == ["A"]


def test_partitioned_and_bucketed_tables_are_replaced_too(spark, tmp_path):
    dated = spark.sql("SELECT DATE '2024-01-05' + cast(id AS int) AS date, id FROM range(60)")
    path = str(tmp_path / "months")
    files.write_by_month(dated, path)
    again = files.write_by_month(files.read_table(spark, path).drop("month").where("id < 40"), path)
    assert again.count() == 40 and set(again.columns) == {"date", "id", "month"}
    path = str(tmp_path / "buckets")
    first = files.write_bucketed_table(dated, "snapshot_test", path, "id", ("id",), 2)
    second = files.write_bucketed_table(first.where("id < 7"), "snapshot_test", path, "id", ("id",), 2)
    assert (first.count(), second.count()) == (60, 7)
    files.write_bucketed_table(second, "snapshot_test", path, "id", ("id",), 2)
    assert second.count() == 7 and len(snapshots.published(spark, path)) == 2
