"""Flattening of dimension-coded statistics messages into table rows (B8,
J2, U7, X16-X19, D14, D19).

A message is a (key, value) pair: the key carries a query string whose first
``dbcode`` names the column; the value is JSON with ``returndata.datanodes``
(one measurement each, with dimension codes in ``wds``) and
``returndata.wdnodes`` (per dimension, a code -> name dictionary). A message is
parsed once, to a VARIANT. Each of its dictionaries becomes a map, built once, in
which the first entry of a code wins; measurements look their names up in it
before the explode, so a dictionary is never copied onto the output rows. The
same function serves a batch read and a stream (D14).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.lookup import first_match, first_wins_map, query_param
from quire.functions.variant import parsed

NODES_SCHEMA = "array<struct<data: struct<hasdata: boolean, data: double>, wds: array<struct<wdcode: string, valuecode: string>>>>"
DICTIONARIES_SCHEMA = "array<struct<wdcode: string, nodes: array<struct<code: string, cname: string>>>>"

QUOTA_COLUMNS = ["value", "quotaName", "quotaType", "object", "period", "date", "columnName", "source"]

# Output constants of the reference's statistics table.
SOURCE = "data.stats.gov.cn"
OBJECT_NATIONAL = "全国"
OBJECT_OTHER = "TODO"
PERIOD_MONTH = "月度"
PERIOD_QUARTER = "季度"
PERIOD_YEAR = "年度"


def column_name(key: Column) -> Column:
    """Value of the first ``dbcode`` parameter of the key's query part
    (the text after the first ``+``)."""
    return query_param(F.get(F.split(key, r"\+", -1), 1), "dbcode")


def object_of(col_name: Column) -> Column:
    """X16."""
    return F.when(col_name.contains("hg"), F.lit(OBJECT_NATIONAL)).otherwise(F.lit(OBJECT_OTHER))


def period_of(col_name: Column) -> Column:
    """Monthly for ``yd``, else quarterly for ``jd``, else yearly."""
    return (
        F.when(col_name.contains("yd"), F.lit(PERIOD_MONTH))
        .when(col_name.contains("jd"), F.lit(PERIOD_QUARTER))
        .otherwise(F.lit(PERIOD_YEAR))
    )


def _dictionary(wdnodes: Column, wdcode: str) -> Column:
    """The first dimension entry with ``wdcode`` -> its map of code to name."""
    nodes = first_match(wdnodes, lambda n: n["wdcode"] == F.lit(wdcode))["nodes"]
    return first_wins_map(nodes, "code", "cname")


def _name_of(dictionary: Column, wds: Column, wdcode: str) -> Column:
    """X19 + J2: the name of the node's code for ``wdcode``; null without one."""
    code = first_match(wds, lambda w: w["wdcode"] == F.lit(wdcode))["valuecode"]
    return F.try_element_at(dictionary, code)


def parsed_messages(messages: DataFrame, key_col: str = "key", value_col: str = "value") -> DataFrame:
    """(columnName, datanodes, zb, sj): a message's measurements and its two
    dictionaries, each computed once."""
    name = column_name(F.col(key_col).cast("string"))
    docs = parsed(messages, {"doc": F.col(value_col)}, keep={"columnName": name})
    rd = lambda part, kind: F.try_variant_get("doc", f"$.returndata.{part}", kind)
    docs = docs.select("columnName", rd("datanodes", NODES_SCHEMA).alias("datanodes"), rd("wdnodes", DICTIONARIES_SCHEMA).alias("wdnodes"))
    built = F.struct("columnName", "datanodes", _dictionary(F.col("wdnodes"), "zb").alias("zb"), _dictionary(F.col("wdnodes"), "sj").alias("sj"))
    return docs.select(F.explode(F.array(built)).alias("m")).select("m.*")


def flatten_statistics(messages: DataFrame, key_col: str = "key", value_col: str = "value") -> DataFrame:
    """Messages to Quota rows (value, quotaName, quotaType, object,
    period, date, columnName, source). Measurements without data, or whose
    indicator has no (or an empty) name, are dropped (D19)."""
    read = parsed_messages(messages, key_col, value_col)
    rows = F.transform(
        F.col("datanodes"),
        lambda d: F.struct(
            d["data"]["hasdata"].alias("hasdata"),
            d["data"]["data"].alias("value"),
            _name_of(F.col("zb"), d["wds"], "zb").alias("quotaName"),
            _name_of(F.col("sj"), d["wds"], "sj").alias("date"),
        ),
    )
    flat = read.select("columnName", F.explode(rows).alias("q")).filter(
        F.coalesce(F.col("q.hasdata"), F.lit(False))
        & F.col("q.quotaName").isNotNull()
        & (F.col("q.quotaName") != F.lit(""))
    )
    return flat.select(
        F.col("q.value").alias("value"),
        F.col("q.quotaName").alias("quotaName"),
        F.array().cast("array<string>").alias("quotaType"),
        object_of(F.col("columnName")).alias("object"),
        period_of(F.col("columnName")).alias("period"),
        F.col("q.date").alias("date"),
        "columnName",
        F.lit(SOURCE).alias("source"),
    )


# Hive/Parquet table for the rows (K2).
QUOTA_DDL = (
    "value DOUBLE, quotaName STRING, quotaType ARRAY<STRING>, `object` STRING, "
    "period STRING, date STRING, columnName STRING, source STRING"
)
