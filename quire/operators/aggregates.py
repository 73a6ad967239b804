"""The everyday aggregates, as the reference's aggregate chapter lists them
(A1-A12), in DataFrame form; each has a SQL twin in ``quire.plans.catalog``.

All of them are hash aggregates with a partial (map-side) step, except that
distinct aggregates are planned by Spark as an expand + two-level aggregate
and collected lists are only ever built per bounded group (an invoice).
Floating variances are rounded so results do not depend on the order in
which partial states are merged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def basic_aggs(df: DataFrame, col: str = "Quantity", key: str = "StockCode", time_col: str = "InvoiceDate") -> DataFrame:
    """A1, A2, A5, A6, A7, A8 in one pass."""
    return df.agg(
        F.count(key).alias("count_stockcode"),
        F.count(F.lit(1)).alias("count_rows"),
        F.min(col).alias("min_quantity"),
        F.max(col).alias("max_quantity"),
        F.sum(col).alias("sum_quantity"),
        F.sum_distinct(F.col(col)).alias("sum_distinct_quantity"),
        F.avg(col).alias("avg_quantity"),
        F.expr(f"mean({col})").alias("mean_quantity"),
        (F.sum(col) / F.count(col)).alias("purchases_per_transaction"),
        F.max(time_col).alias("last_date"),
    )


def spread_aggs(df: DataFrame, col: str = "Quantity", digits: int = 4) -> DataFrame:
    """A9, A10."""
    return df.agg(
        F.round(F.var_pop(col), digits).alias("var_pop"),
        F.round(F.var_samp(col), digits).alias("var_samp"),
        F.round(F.stddev_pop(col), digits).alias("stddev_pop"),
        F.round(F.stddev_samp(col), digits).alias("stddev_samp"),
    )


def distinct_counts(df: DataFrame) -> DataFrame:
    """A3: distinct invoices, products and customers."""
    return df.agg(
        *[F.count_distinct(c).alias(name) for c, name in (("InvoiceNo", "invoices"), ("StockCode", "products"), ("CustomerID", "customers"))]
    )


def approx_distinct(df: DataFrame, col: str = "StockCode", rsd: float = 0.1) -> DataFrame:
    """A4: HyperLogLog++ distinct count with relative standard deviation
    ``rsd`` (fixed-size sketches, merged across tasks)."""
    return df.agg(F.approx_count_distinct(col, rsd).alias("approx_distinct_stockcode"))


def approx_distinct_checked(df: DataFrame, col: str = "StockCode", rsd: float = 0.1) -> DataFrame:
    """A4 beside the exact count, and whether the sketch lies within three
    relative standard deviations of it (one pass per distinct value)."""
    exact = F.count_distinct(col)
    near = F.abs(F.approx_count_distinct(col, rsd) - exact) <= 3 * rsd * exact
    return df.agg(exact.alias("exact"), near.alias("within"))


def collect_aggs(df: DataFrame, key: str = "InvoiceNo") -> DataFrame:
    """Per invoice, the set of countries and the list of products, as
    sorted text (stable output). Lists are only collected per invoice, a group
    bounded by the lines of one order."""
    return df.groupBy(key).agg(
        F.array_join(F.sort_array(F.collect_set("Country")), ",").alias("countries"),
        F.array_join(F.sort_array(F.collect_list("StockCode")), ",").alias("stock_codes"),
        F.count(F.lit(1)).alias("lines"),
    )


def collect_set_global(df: DataFrame, col: str = "Country") -> DataFrame:
    """A11 in the reference's global form, for a column of few distinct
    values (the partial step dedups in every task)."""
    return df.agg(F.array_join(F.sort_array(F.collect_set(col)), ",").alias("countries"))


def group_two_keys(df: DataFrame) -> DataFrame:
    """Rows per (InvoiceNo, CustomerId); column names resolve
    case-insensitively as in the reference."""
    return df.groupBy("InvoiceNo", "CustomerId").count()
