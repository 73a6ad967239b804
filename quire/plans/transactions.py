"""The retail-transactions view ``tx`` over the driver tables (stands in for the
retail CSV files; mapping of SURVEY §7.2).

Join order is chosen for scale: orders are first enriched with the customer's
region (customer is keyed like orders' foreign key; nation and region are tiny
dimensions that Spark broadcasts unaided), then lineitem meets orders once on
the order key and part once on the part key. A Country filter on ``tx`` is
pushed by Catalyst down to the region scan, and a date filter to the orders
scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.sources.tables import load

TX_COLUMNS = [
    "InvoiceNo",
    "StockCode",
    "Description",
    "Quantity",
    "InvoiceDate",
    "UnitPrice",
    "CustomerID",
    "Country",
]


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = load(spark, sf_dir, "region").select("r_regionkey", "r_name")
    nation = load(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    geo = (
        nation.join(region, nation.n_regionkey == region.r_regionkey).select(
            F.col("n_nationkey").alias("c_nationkey"), "r_name"
        )
    )
    customer = load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    orders_geo = orders.join(customer, orders.o_custkey == customer.c_custkey).join(geo, "c_nationkey")
    lineitem = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_returnflag")
    part = load(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    joined = lineitem.join(orders_geo, lineitem.l_orderkey == orders_geo.o_orderkey).join(
        part, lineitem.l_partkey == part.p_partkey
    )
    return joined.select(
        F.col("o_orderkey").cast("string").alias("InvoiceNo"),
        F.col("l_partkey").cast("string").alias("StockCode"),
        F.col("p_name").alias("Description"),
        F.when(F.col("l_returnflag") == "R", -F.col("l_quantity"))
        .otherwise(F.col("l_quantity"))
        .cast("int")
        .alias("Quantity"),
        F.col("o_orderdate").alias("InvoiceDate"),
        F.col("p_retailprice").alias("UnitPrice"),
        F.when(F.col("o_orderkey") % 20 == 0, F.lit(None))
        .otherwise(F.col("o_custkey"))
        .alias("CustomerID"),
        F.col("r_name").alias("Country"),
    )


# The same view for DuckDB oracles (tables pre-registered as views).
TX_SQL = """
SELECT CAST(o.o_orderkey AS VARCHAR) AS InvoiceNo,
       CAST(l.l_partkey AS VARCHAR) AS StockCode,
       p.p_name AS Description,
       CAST(CASE WHEN l.l_returnflag = 'R' THEN -l.l_quantity ELSE l.l_quantity END AS INTEGER) AS Quantity,
       o.o_orderdate AS InvoiceDate,
       p.p_retailprice AS UnitPrice,
       CASE WHEN o.o_orderkey % 20 = 0 THEN NULL ELSE o.o_custkey END AS CustomerID,
       r.r_name AS Country
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN part p ON l.l_partkey = p.p_partkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
"""
