"""Snapshot tables: atomic publishing, merges that touch only their partitions, look-ups by company, registration without listing."""

import json
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from helpers import rows
from marketframe import schemas as S
from marketframe.sinks import snapshots
from marketframe.sinks import tables as sinks
from marketframe.sources import snapshots as reading
from marketframe.sources import tables as stored
from test_tables import FIRST, SECOND, kept, macro


def facts(spark, cells, stamp="now"):
    data = [(c, f"S{c}", y, v, v * 2, "Revenues", f"{y}-12-31", f"{y + 1}-02-01", stamp) for c, y, v in cells]
    return spark.createDataFrame(data, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in S.FUNDAMENTALS.columns))


def test_versions_modes_and_streams(spark, path):
    assert reading.current(spark, path("t")) is None
    changed = snapshots.publish(macro(spark, FIRST), path("t"), S.MACRO)
    assert set(changed) == {("GS10", "2023"), ("UNRATE", "2024")} and kept(spark, path("t")) == sorted(FIRST, key=repr)
    snapshots.publish(macro(spark, SECOND), path("t"), S.MACRO, sinks.SKIP)
    assert kept(spark, path("t")) == sorted([*FIRST, SECOND[1]], key=repr)
    snapshots.publish(macro(spark, SECOND[:1]), path("t"), S.MACRO, sinks.APPEND, ("feed", 3))
    assert not snapshots.publish(macro(spark, SECOND[:1]), path("t"), S.MACRO, sinks.APPEND, ("feed", 3))
    assert kept(spark, path("t")) == sorted([*FIRST, *SECOND], key=repr)
    sinks.write_table(macro(spark, SECOND[:1]), path("t"), S.MACRO)  # the plain writer publishes here too
    assert kept(spark, path("t")) == sorted([FIRST[2], *SECOND], key=repr)
    assert reading.current(spark, path("t")).version == 4
    assert sorted(snapshots.stored_partitions(spark, path("t"))) == [("CPI", "2024"), ("GS10", "2023"), ("UNRATE", "2024")]
    assert rows(stored.file_inventory(spark, path("t"), S.MACRO.keys), "series", "year") == [("CPI", "2024"), ("GS10", "2023"), ("UNRATE", "2024")]
    assert not snapshots.publish(macro(spark, FIRST).limit(0), path("t"), S.MACRO)
    with pytest.raises(ValueError, match="unknown mode"):
        snapshots.publish(macro(spark, FIRST), path("t"), S.MACRO, "merge")


def test_a_write_that_stops_between_two_partitions_shows_nothing(spark, path):
    snapshots.publish(macro(spark, FIRST), path("t"), S.MACRO)
    stops = macro(spark, [("GS10", "2023", 1, 9.0), ("UNRATE", "2024", 1, 9.0)]).withColumn(
        "description", F.when(F.col("series") == "UNRATE", F.raise_error(F.lit("lost")).cast("string")).otherwise("d")
    )
    with pytest.raises(Exception, match="lost"):
        snapshots.publish(stops, path("t"), S.MACRO)
    assert kept(spark, path("t")) == sorted(FIRST, key=repr)
    snapshots.publish(macro(spark, SECOND), path("t"), S.MACRO)  # and the next write is not hindered
    assert ("GS10", "2023", 3, 4.1) in kept(spark, path("t"))


def test_a_reader_keeps_its_version(spark, path):
    snapshots.publish(macro(spark, FIRST), path("t"), S.MACRO)
    before = stored.read_table(spark, S.MACRO, path("t"))
    snapshots.publish(macro(spark, SECOND), path("t"), S.MACRO)
    assert rows(before, "series", "year", "month", "value") == sorted(FIRST, key=repr)


def test_the_second_of_two_writers_is_refused(spark, path):
    snapshots.publish(macro(spark, FIRST), path("t"), S.MACRO)
    base = reading.current(spark, path("t"))
    snapshots.publish(macro(spark, SECOND), path("t"), S.MACRO, base=base)
    with pytest.raises(snapshots.ConcurrentWrite):
        snapshots.publish(macro(spark, FIRST[:1]), path("t"), S.MACRO, base=base)
    assert ("GS10", "2023", 3, 4.1) in kept(spark, path("t"))


def test_a_batch_reads_only_the_partitions_it_touches(spark, path, monkeypatch):
    snapshots.publish(macro(spark, [("GS10", str(y), 1, 1.0) for y in range(1990, 2020)]), path("t"), S.MACRO)
    read = []

    def watch(spark_, table, root, folders):
        read.append(list(folders))
        return stored.read_folders(spark_, table, root, folders)

    monkeypatch.setattr(snapshots, "read_folders", watch)
    snapshots.publish(macro(spark, [("GS10", "2019", 2, 2.0), ("GS10", "2020", 2, 2.0)]), path("t"), S.MACRO, sinks.APPEND)
    assert len(read) == 2 and all(len(folders) == 1 and folders[0].endswith("/series=GS10/year=2019") for folders in read)
    whole = stored.read_table(spark, S.MACRO, path("t"))
    assert whole.count() == 32 and len(whole.inputFiles()) == 31


def test_company_years_are_replaced_within_a_year(spark, path):
    table = S.FUNDAMENTALS_BY_YEAR
    snapshots.publish(facts(spark, [("1", 2022, 5), ("2", 2022, 6), ("1", 2023, 7), ("3", 2021, 1)]), path("f"), table)
    changed = snapshots.publish(facts(spark, [("2", 2022, 60), ("4", 2022, 61)], "later"), path("f"), table)
    assert set(changed) == {("2022",)}
    read = stored.read_table(spark, table, path("f"))
    assert rows(read, "cik", "year", "capex_usd") == [("1", "2022", 5), ("1", "2023", 7), ("2", "2022", 60), ("3", "2021", 1), ("4", "2022", 61)]


def test_a_company_look_up_prunes_files_and_row_groups(spark, path):
    companies = spark.range(0, 60_000, 1, 4).select(F.lpad(F.col("id").cast("string"), 10, "0").alias("cik"))
    wide = companies.crossJoin(spark.createDataFrame([(2022,), (2023,)], "year long")).select(
        "cik", F.col("cik").alias("symbol"), "year", *[F.lit(1).cast("long").alias(c) for c in ("capex_usd", "revenue_usd")],
        *[F.lit("x").alias(c) for c in ("revenue_tag", "period_end", "filed", "extracted_at")],
    )
    was = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as if there were more companies than a file takes
    try:
        snapshots.publish(wide.repartition(8, F.rand(1)), path("f"), S.FUNDAMENTALS_BY_YEAR)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", was)
    for year in ("2022", "2023"):
        ranges = []
        for file in Path(path("f")).glob(f"commit=*/year={year}/*.parquet"):
            meta = pq.read_metadata(file)
            for g in range(meta.num_row_groups):
                column = next(c for c in (meta.row_group(g).column(i) for i in range(meta.num_columns)) if c.path_in_schema == "cik")
                ranges.append((column.statistics.min, column.statistics.max))
        ranges.sort()
        assert len(ranges) > 1 and all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
    assert len(list(Path(path("f")).glob("commit=*/year=*"))) == 2
    found = stored.read_table(spark, S.FUNDAMENTALS_BY_YEAR, path("f")).where("cik = '0000031415' AND year = '2023'")
    assert found.count() == 1
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(cik,0000031415)" in plan and "PartitionFilters: [isnotnull(year" in plan


def test_registration_lists_nothing_and_follows_replacements(spark, path):
    name = sinks.create_table(spark, S.MACRO, path("t"), "snapshot_catalog_test")
    said = []
    real = spark.sql
    try:
        spark.sql = lambda text, *a, **k: (said.append(text), real(text, *a, **k))[1]
        for batch in (FIRST, SECOND, [("O'Neil \\ co", "2020", 1, 1.0)]):
            changed = snapshots.publish(macro(spark, batch), path("t"), S.MACRO)
            snapshots.register_changed(spark, name, S.MACRO, path("t"), changed)
    finally:
        del spark.sql
    assert not any("MSCK" in text for text in said) and len(said) == 6
    assert rows(spark.table(name), "series", "year", "month", "value") == kept(spark, path("t"))
    spark.sql(f"DROP TABLE {name}")


def test_conversion_vacuum_and_foreign_roots(spark, path):
    sinks.write_table(macro(spark, FIRST), path("plain"), S.MACRO)
    with pytest.raises(ValueError, match="another layout"):
        snapshots.publish(macro(spark, SECOND), path("plain"), S.MACRO)
    snapshots.convert(stored.read_table(spark, S.MACRO, path("plain")), path("t"), S.MACRO)
    with pytest.raises(ValueError, match="already"):
        snapshots.convert(macro(spark, FIRST), path("t"), S.MACRO)
    for value in (1.0, 2.0, 3.0):
        snapshots.publish(macro(spark, [("GS10", "2023", 1, value)]), path("t"), S.MACRO)
    assert snapshots.vacuum(spark, path("t"), keep=2) == 1
    assert snapshots.vacuum(spark, path("t")) == 1 and snapshots.vacuum(spark, path("none")) == 0
    assert kept(spark, path("t")) == [("GS10", "2023", 1, 3.0), ("UNRATE", "2024", 1, 4.0)]


def test_version_files_are_plain_json(spark, path):
    snapshots.publish(macro(spark, FIRST[:1]), path("t"), S.MACRO, stream=("s", 0))
    text = json.loads(Path(path("t/_versions/000000000001.json")).read_text())
    assert text["streams"] == {"s": 0} and text["partitions"][0][0] == ["GS10", "2023"]
