"""Plan shape (pushdown, pruning, broadcast, top-k, no Python on hot paths)
and the registered queries against their DuckDB oracles."""

from __future__ import annotations

import os
import re
import sys

import duckdb
import pytest

from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracles import rows_of  # noqa: E402
from quire.operators.introspect import plan_text, schema_text  # noqa: E402
from quire.plans import catalog  # noqa: E402
from quire.sources.tables import TABLES, table_path  # noqa: E402


def plan(df) -> str:
    return plan_text(df, "formatted")


def test_clean_tx_pushdown_and_pruning(spark):
    p = plan(catalog.clean_tx(spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThan(o_orderdate" in p
    assert "PushedFilters: [IsNotNull(r_name), EqualTo(r_name,AMERICA)" in p
    # lineitem is read with the four columns the view needs
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double,l_returnflag:string>" in p
    assert "BroadcastHashJoin" in p


def test_top5_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in plan(catalog.csv_flight_top5_sql(spark, SF_SMALL))


def test_no_python_on_builtin_paths(spark):
    for q in ("rfm_score", "word_count", "macd_window", "stats_flatten", "cdc_apply"):
        p = plan(catalog.QUERIES[q](spark, SF_SMALL))
        assert "EvalPython" not in p and "PythonUDF" not in p, q


def test_aggregations_are_partial(spark):
    p = plan(catalog.word_count_q(spark, SF_SMALL))
    assert p.count("HashAggregate") >= 2  # partial + final
    # MACD never collects tick values: the only list is each bucket's m windows
    collected = set(re.findall(r"collect_list\((\w+)#", plan(catalog.macd_window(spark, SF_SMALL))))
    assert collected <= {"w"}, collected


def test_schema_and_conf(spark):
    assert "|-- RFMScore: string" in schema_text(E.entry(spark))
    spark.conf.set("spark.sql.shuffle.partitions", "5")  # K11
    assert spark.conf.get("spark.sql.shuffle.partitions") == "5"
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == [
        "CustomerID", "Recency", "Frequency", "Monetary", "R_Quartile", "F_Quartile", "M_Quartile", "RFMScore"
    ]


def test_registry_complete():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert set(catalog.QUERIES) == set(catalog.ORACLES)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF_SMALL, t)}')")
    return con


# Spark type name -> DuckDB type name, for the schema comparison.
TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "timestamp": "TIMESTAMP",
         "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    rel = duck.sql(E.oracle_sql()[name])
    stypes = {c.lower(): TYPES.get(t, t) for c, t in df.dtypes}
    dtypes = {c.lower(): str(t) for c, t in zip(rel.columns, rel.types)}
    assert stypes == dtypes
    a, ac = rows_of(df.columns, srows)
    b, bc = rows_of(rel.columns, rel.fetchall())
    assert ac == bc
    assert len(a) == len(b)
    assert a == b
