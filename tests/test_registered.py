"""Every registered query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from marketframe import session
from marketframe.workload.oracle import ORACLES
from marketframe.workload.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = ["customer", "events", "lineitem", "orders", "part"]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not there")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def ordered(rows, columns):
    return sorted(([r[c] for c in columns] for r in rows), key=repr)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, db, name):
    frame = contract.queries()[name](spark, SF_DIR)
    cursor = db.execute(contract.oracle_sql()[name])
    columns = sorted(d[0] for d in cursor.description)
    names = [d[0] for d in cursor.description]
    expected = [dict(zip(names, r)) for r in cursor.fetchall()]
    assert sorted(frame.columns) == columns
    assert ordered([r.asDict() for r in frame.collect()], columns) == ordered(expected, columns)


# Plan steps that would not scale, or leave the JVM.
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "InArrow")


def plan_of(frame, capsys):
    capsys.readouterr()
    frame.explain("extended")
    return capsys.readouterr().out


@pytest.mark.parametrize("name", ["risk_metrics", "rolling_sharpe", "trailing_sharpe_asof", "monthly_panel", "fundamentals",
                                  "sql4_moving_average", "sql5_high_volume", "sql7_category_performance", "beta", "max_drawdown",
                                  "regime_crosstab", "spend_efficiency", "completeness", "dq_quotes", "xbrl_annual"])
def test_plans_have_no_unwanted_steps(spark, capsys, name):
    plan = plan_of(contract.queries()[name](spark, SF_DIR), capsys)
    assert not [step for step in UNWANTED if step in plan]


def test_the_flagship_reads_four_line_item_columns_and_sorts_once_per_symbol(spark, capsys):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = plan_of(contract.queries()["risk_metrics"](spark, SF_DIR), capsys).split("== Physical Plan ==")[1]
    schema = plan.split("ReadSchema: struct<l_")[1].split(">")[0]
    assert schema.count(":") == 4
    # The monthly totals, the series of each symbol, and the distinct symbols of the security table.
    assert plan.count("hashpartitioning(symbol") == 3


def test_every_query_has_sql_and_the_entry_runs(spark):
    assert QUERIES.keys() == ORACLES.keys()
    assert contract.entry(spark).count() > 0


def test_scratch_area_is_the_configured_folder_and_required_on_a_cluster(spark, monkeypatch):
    assert session.scratch_path(spark, "x").startswith(session.shared_dir(spark))

    class Conf:
        def get(self, key, default):
            return default

    class Remote:
        conf = Conf()
        sparkContext = type("Context", (), {"master": "yarn"})

    with pytest.raises(RuntimeError):
        session.shared_dir(Remote())
