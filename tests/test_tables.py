import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from helpers import rows
from marketframe import schemas as S
from marketframe.sinks import tables as sinks
from marketframe.sources import tables as stored
from marketframe.streaming.ingest import ingest_available_now, publish_batch


def macro(spark, data):
    df = spark.createDataFrame(data, "series string, year string, month bigint, value double")
    text = [c for c in S.MACRO.columns.names if c not in ("year", "month", "value")]
    return df.withColumns({c: F.concat(F.lit(c), F.lit("-"), "series") for c in text})


def kept(spark, root):
    return rows(stored.read_table(spark, S.MACRO, root), "series", "year", "month", "value")


FIRST = [("GS10", "2023", 1, 3.8), ("GS10", "2023", 2, 3.9), ("UNRATE", "2024", 1, 4.0)]
SECOND = [("GS10", "2023", 3, 4.1), ("CPI", "2024", 1, 300.0)]


def test_overwrite_replaces_only_the_partitions_it_holds(spark, path):
    sinks.write_table(macro(spark, FIRST), path("t"), S.MACRO)
    sinks.write_table(macro(spark, SECOND), path("t"), S.MACRO)
    assert kept(spark, path("t")) == [("CPI", "2024", 1, 300.0), ("GS10", "2023", 3, 4.1), ("UNRATE", "2024", 1, 4.0)]


def test_skip_leaves_stored_partitions_alone_and_append_adds(spark, path):
    sinks.write_table(macro(spark, FIRST), path("t"), S.MACRO, sinks.SKIP)
    sinks.write_table(macro(spark, SECOND), path("t"), S.MACRO, sinks.SKIP)
    assert kept(spark, path("t")) == sorted([*FIRST, ("CPI", "2024", 1, 300.0)], key=repr)
    sinks.write_table(macro(spark, SECOND[:1]), path("t"), S.MACRO, sinks.APPEND)
    assert ("GS10", "2023", 3, 4.1) in kept(spark, path("t"))


def test_one_file_per_small_partition(spark, path):
    many = [("GS10", "2023", i, float(i)) for i in range(200)] + [("GS10", "2024", i, float(i)) for i in range(200)]
    sinks.write_table(macro(spark, many).repartition(8), path("t"), S.MACRO)
    files = stored.file_inventory(spark, path("t"), S.MACRO.keys)
    assert rows(files, "series", "year") == [("GS10", "2023"), ("GS10", "2024")]


def test_a_large_partition_is_written_by_several_tasks(spark, path):
    """All rows in one partition: the rebalance splits it above the advisory size."""
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        hot = spark.range(0, 200_000, 1, 8).select(
            F.lit("GS10").alias("series"), F.lit("2023").alias("year"), F.col("id").alias("month"), F.rand(1).alias("value"),
            *[F.uuid().alias(c) for c in S.MACRO.columns.names if c not in ("year", "month", "value")],
        )
        sinks.write_table(hot, path("t"), S.MACRO)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size)
    assert stored.file_inventory(spark, path("t"), S.MACRO.keys).count() > 1
    assert stored.read_table(spark, S.MACRO, path("t")).count() == 200_000


def test_key_values_keep_leading_zeros(spark, path):
    row = ("0001326801", "META", 2023, 1, 2, "Revenues", "2023-12-31", "2024-02-01", "now")
    df = spark.createDataFrame([row], ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in S.FUNDAMENTALS.columns))
    sinks.write_table(df, path("t"), S.FUNDAMENTALS)
    assert stored.read_table(spark, S.FUNDAMENTALS, path("t")).first().cik == "0001326801"
    assert rows(stored.partitions(spark, path("t"), S.FUNDAMENTALS.keys)) == [("0001326801", "2023")]


def test_schema_drift_raises(spark, path):
    good = macro(spark, FIRST)
    with pytest.raises(sinks.SchemaDrift, match="value: missing"):
        sinks.write_table(good.drop("value"), path("t"), S.MACRO)
    with pytest.raises(sinks.SchemaDrift, match="value: string instead of double"):
        sinks.write_table(good.withColumn("value", F.lit("x")), path("t"), S.MACRO)
    assert not Path(path("t")).exists()
    extra = sinks.conform(good.withColumn("more", F.lit(1)).withColumn("month", F.lit(1)), S.MACRO)
    assert extra.columns == S.MACRO.schema.names and extra.schema["month"].dataType.simpleString() == "bigint"
    with pytest.raises(ValueError):
        sinks.write_table(good, path("t"), S.MACRO, "merge")


def test_series_scan_prunes_and_tolerates_missing_partitions(spark, path, capsys):
    sinks.write_table(macro(spark, FIRST), path("t"), S.MACRO)
    out = stored.scan_series(spark, path("t"), ["GS10", "NOPE"], (2020, 2023))
    assert rows(out, "series", "value") == [("GS10", 3.8), ("GS10", 3.9)]
    out.select("value").explain()
    plan = capsys.readouterr().out
    # Both conditions sit in the scan's partition filters: no filter step is left and only one column is read.
    assert "Filter (" not in plan and "ReadSchema: struct<value:double>" in plan
    with pytest.raises(ValueError):
        stored.scan_series(spark, path("t"), ["NOPE"], (2020, 2023))
    wanted = spark.createDataFrame([("GS10",), ("NOPE",)], "series string")
    assert rows(stored.missing_series(wanted, out, "series")) == [("NOPE",)]


def test_inventory_and_latest_file(spark, path):
    sinks.write_table(macro(spark, FIRST), path("t"), S.MACRO)
    sinks.write_table(macro(spark, SECOND[:1]), path("t"), S.MACRO, sinks.APPEND)
    files = stored.file_inventory(spark, path("t"), S.MACRO.keys)
    assert files.count() == 3
    newest = stored.latest_file(files).first().path
    read = stored.with_file(stored.read_table(spark, S.MACRO, path("t"))).where(F.col("path") == newest)
    assert rows(read, "series", "month") == [("GS10", 3)]


def test_catalog_partitions(spark, path):
    sinks.write_table(macro(spark, FIRST), path("t"), S.MACRO)
    name = sinks.create_table(spark, S.MACRO, path("t"), "macro_catalog_test")
    assert spark.table(name).count() == 0
    for _ in range(2):  # adding twice is harmless
        sinks.register_partition(spark, name, {"series": "UNRATE", "year": "2024"}, path("t/series=UNRATE/year=2024"))
    assert spark.table(name).count() == 1
    sinks.register_all(spark, name)
    assert spark.table(name).count() == 3
    spark.sql(f"DROP TABLE {name}")


def test_every_table_can_be_created(spark, path):
    for table in S.TABLES.values():
        name = sinks.create_table(spark, table, path(table.name), f"t_{table.name}")
        assert spark.table(name).columns == table.schema.names
        spark.sql(f"DROP TABLE {name}")


def test_csv_and_json_exports(spark, path):
    df = spark.createDataFrame([("A", 'x, "y"', 1.5), ("B", None, 2.0)], "symbol string, note string, v double")
    assert sinks.export_csv(df, path("csv"), ["symbol", "note"])
    assert rows(stored.read_csv(spark, path("csv"), "symbol string, note string")) == [("A", 'x, "y"'), ("B", None)]
    assert not sinks.export_csv(df.limit(0), path("none")) and not Path(path("none")).exists()
    document = [{"symbol": "META", "category": "AI Builder", "sharpe_ratio": 1.99, "rolling_sharpe": [{"date": "2024-01-01", "rolling_sharpe_12m": 2.0}]}]
    Path(path("r.json")).write_text(json.dumps(document))
    row = stored.read_results(spark, path("r.json"), lines=False).first()
    assert row.rolling_sharpe[0].rolling_sharpe_12m == 2.0 and row.capex_2026_B is None


def test_stream_takes_only_new_files(spark, path):
    columns = S.STOCKS.columns

    def land(symbol, day):
        row = {"symbol": symbol, "price": 1.0, "previous_close": 1.0, "change": 0.0, "change_percent": 0.0, "volume": 1, "trading_day": day, "timestamp": day}
        Path(path("in")).mkdir(exist_ok=True)
        Path(path(f"in/{symbol}-{day}.json")).write_text(json.dumps(row))

    def run():
        ingest_available_now(
            spark, path("in"), path("out"), S.STOCKS, path("ckpt"), columns, lambda df: df.withColumn("date", F.col("trading_day"))
        )
        return rows(stored.read_table(spark, S.STOCKS, path("out")), "symbol", "date")

    land("A", "2024-01-01")
    assert run() == [("A", "2024-01-01")]
    assert run() == [("A", "2024-01-01")]
    land("B", "2024-01-01")
    land("A", "2024-01-02")
    assert run() == [("A", "2024-01-01"), ("A", "2024-01-02"), ("B", "2024-01-01")]


def test_loads_into_an_absent_or_empty_table(spark, path):
    assert not stored.has_files(spark, path("t"))
    sinks.write_table(macro(spark, FIRST).limit(0), path("t"), S.MACRO, sinks.SKIP)
    assert not stored.has_files(spark, path("t"))
    with pytest.raises(ValueError):
        stored.scan_series(spark, path("t"), ["GS10"], (2020, 2023))
    sinks.write_table(macro(spark, FIRST), path("t"), S.MACRO, sinks.SKIP)
    assert len(kept(spark, path("t"))) == 3


def test_result_records_of_many_lines_are_all_read(spark, path):
    records = spark.range(50).select(F.concat(F.lit("S"), "id").alias("symbol"), F.col("id").cast("double").alias("sharpe_ratio")).coalesce(1)
    sinks.export_json(records, path("many"))
    assert stored.read_results(spark, path("many")).where("sharpe_ratio IS NOT NULL").count() == 50


def test_a_repeated_batch_changes_nothing_and_batch_writers_share_the_table(spark, path):
    def stocks(*pairs):
        row = "price double, previous_close double, change double, change_percent double, volume bigint"
        data = [(s, 1.0, 1.0, 0.0, 0.0, v, d, d, d) for s, d, v in pairs]
        return spark.createDataFrame(data, f"symbol string, {row}, trading_day string, timestamp string, date string").select(*S.STOCKS.schema.names)

    def content():
        return rows(stored.read_table(spark, S.STOCKS, path("t")), "symbol", "date", "volume")

    first, second = stocks(("A", "d1", 1), ("B", "d1", 2)), stocks(("A", "d1", 1), ("C", "d2", 3))
    for _ in range(2):
        publish_batch(first, 0, path("t"), S.STOCKS, "feed")
    for _ in range(2):
        publish_batch(second, 1, path("t"), S.STOCKS, "feed")
    assert content() == [("A", "d1", 1), ("A", "d1", 1), ("B", "d1", 2), ("C", "d2", 3)]
    sinks.write_table(stocks(("D", "d2", 4)), path("t"), S.STOCKS, sinks.APPEND)
    sinks.write_table(stocks(("E", "d1", 5), ("E", "d3", 5)), path("t"), S.STOCKS, sinks.SKIP)
    sinks.write_table(stocks(("F", "d1", 6)), path("t"), S.STOCKS, sinks.OVERWRITE)
    assert content() == [("C", "d2", 3), ("D", "d2", 4), ("E", "d3", 5), ("F", "d1", 6)]
    assert rows(stored.partitions(spark, path("t"), S.STOCKS.keys)) == [("d1",), ("d2",), ("d3",)]
