"""Functions defined in SQL text (U2, U7): a scalar one and one that returns rows.

Both are expanded into the calling query's plan, so they are as fast as the same
expressions written out, and any SQL client of the session can call them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quire.operators.stats_json import DICTIONARIES_SCHEMA, NODES_SCHEMA, OBJECT_NATIONAL, OBJECT_OTHER, PERIOD_MONTH, PERIOD_QUARTER, PERIOD_YEAR, SOURCE

SCORE_SQL = """
CREATE OR REPLACE TEMPORARY FUNCTION quartile_score(v DOUBLE, q1 DOUBLE, q2 DOUBLE, q3 DOUBLE, low_is_good BOOLEAN)
RETURNS INT
RETURN CASE WHEN low_is_good THEN 5 ELSE 0 END + CASE WHEN low_is_good THEN -1 ELSE 1 END
     * CASE WHEN v <= q1 THEN 1 WHEN v <= q2 THEN 2 WHEN v <= q3 THEN 3 ELSE 4 END
"""

# one name per dimension code: of the entries in order of (code, place) the first of a code
_NAMES = """get(transform(array(array_sort(filter(transform({nodes}, (x, i) -> struct(x.code AS code, i AS i, x.cname AS cname)), x -> x.code IS NOT NULL))),
  o -> map_from_entries(transform(filter(o, (x, i) -> coalesce(get(o, i - 1).code <> x.code, true)), x -> struct(x.code, x.cname)))), 0)"""
_NODES = "get(filter(dicts, w -> w.wdcode = '{code}'), 0).nodes"
_CODE = "get(filter(d.wds, w -> w.wdcode = '{code}'), 0).valuecode"

QUOTA_SQL = f"""
CREATE OR REPLACE TEMPORARY FUNCTION quota_rows(message_key STRING, message STRING)
RETURNS TABLE(value DOUBLE, quotaName STRING, object STRING, period STRING, date STRING, columnName STRING, source STRING)
RETURN
  SELECT d.data.data, quota, CASE WHEN name LIKE '%hg%' THEN '{OBJECT_NATIONAL}' ELSE '{OBJECT_OTHER}' END,
         CASE WHEN name LIKE '%yd%' THEN '{PERIOD_MONTH}' WHEN name LIKE '%jd%' THEN '{PERIOD_QUARTER}' ELSE '{PERIOD_YEAR}' END,
         day, name, '{SOURCE}'
  FROM (SELECT name, d, try_element_at(zb, {_CODE.format(code="zb")}) AS quota, try_element_at(sj, {_CODE.format(code="sj")}) AS day
        FROM (SELECT name, explode(nodes) AS d, zb, sj
              FROM (SELECT name, nodes, {_NAMES.format(nodes=_NODES.format(code="zb"))} AS zb, {_NAMES.format(nodes=_NODES.format(code="sj"))} AS sj
                    FROM (SELECT substring(get(filter(split(get(split(message_key, '[+]', -1), 1), '&', -1), p -> startswith(p, 'dbcode=')), 0), 8) AS name,
                                 try_variant_get(try_parse_json(message), '$.returndata.datanodes', '{NODES_SCHEMA}') AS nodes,
                                 try_variant_get(try_parse_json(message), '$.returndata.wdnodes', '{DICTIONARIES_SCHEMA}') AS dicts))))
  WHERE d.data.hasdata AND quota <> ''
"""


def create_sql_functions(spark: SparkSession) -> None:
    """U2 + U7: ``quartile_score`` and the table function ``quota_rows`` in the
    session's SQL."""
    spark.sql(SCORE_SQL)
    spark.sql(QUOTA_SQL)


def rfm_score_sql(spark: SparkSession, rfm: DataFrame, cuts: dict[str, list[float]]) -> DataFrame:
    """B4 in SQL text: the quartile scores by ``quartile_score``."""
    create_sql_functions(spark)
    score = lambda c, low: f"quartile_score(CAST({c} AS DOUBLE), {', '.join(f'{x!r}D' for x in cuts[c])}, {low})"
    scores = f"{score('Recency', 'true')} AS R_Quartile, {score('Frequency', 'false')} AS F_Quartile, {score('Monetary', 'false')} AS M_Quartile"
    return spark.sql(f"SELECT *, concat(R_Quartile, F_Quartile, M_Quartile) AS RFMScore FROM (SELECT *, {scores} FROM {{rfm}})", rfm=rfm)


def flatten_statistics_sql(spark: SparkSession, messages: DataFrame) -> DataFrame:
    """B8 in SQL text: a message's rows by the lateral table function."""
    create_sql_functions(spark)
    return spark.sql("SELECT q.* FROM {m} m, LATERAL quota_rows(m.key, m.value) q", m=messages)
