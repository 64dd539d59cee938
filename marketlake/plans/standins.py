"""How the driver tables stand in for market data (shared by queries and jobs).

* ``events``   long statistics: TIME = day of ``ts``, ITEM_NAME1 = ``event_type``,
               DATA_VALUE = ``value``, input order = ``event_id``
* ``orders``   price history of code ``o_custkey``: date ``o_orderdate``,
               price ``o_totalprice``, unique row key ``o_orderkey``
* ``customer`` companies: code ``c_custkey``, name ``c_name``, ranked by
               ``c_acctbal`` desc then ``c_custkey``; exchange = ``c_mktsegment``
* ``lineitem`` dense price series per ``l_suppkey`` (one per day after pre-aggregation)
* ``part``     names and codes
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.functions import json_field, stat_time
from marketlake.session import read_table

# Fixed values of the stand-in data domain.
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
ORDER_STATUSES = ["F", "O", "P"]
ORDER_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
MARKET_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]

# Split between stored history and newer incoming rows.
CUTOFF = "1996-01-01"
# A statistic value is missing when the source marks it (props.k below this).
MISSING_BELOW_K = 10


def missing_value(value: str = "value", props: str = "props") -> Column:
    """DATA_VALUE with the source's missing marks turned into NULL."""
    return F.when(json_field(props, "$.k", "bigint") < MISSING_BELOW_K, F.lit(None)).otherwise(F.col(value))


MISSING_VALUE_SQL = (
    "CASE WHEN TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) < 10 THEN NULL ELSE value END"
)


def stat_long(spark: SparkSession, sf_dir: str, with_missing: bool = False) -> DataFrame:
    """``events`` as a long statistics table (TIME, ITEM_NAME1, DATA_VALUE, event_id)."""
    ev = read_table(spark, sf_dir, "events")
    value = missing_value() if with_missing else F.col("value")
    return ev.select(
        stat_time("ts").alias("TIME"),
        F.col("event_type").alias("ITEM_NAME1"),
        value.alias("DATA_VALUE"),
        "event_id",
    )


def price_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as per-code price history: code, date, price, row_key, status."""
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_custkey").alias("code"),
        F.to_date("o_orderdate").alias("date"),
        F.col("o_totalprice").alias("price"),
        F.col("o_orderkey").alias("row_key"),
        F.col("o_orderstatus").alias("status"),
    )


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer`` as the company list: code, name, metric, exchange, nation."""
    c = read_table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("code"),
        F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("metric"),
        F.col("c_mktsegment").alias("exchange"),
        F.col("c_nationkey").alias("nation"),
    )


def pivot_sql(index_sql: str, key_col: str, value_sql: str, order_sql: str, values: list[str], source: str,
              where: str = "TRUE") -> str:
    """DuckDB pivot-first: one ``arg_min ... FILTER`` per listed key."""
    cols = ",\n  ".join(
        f"arg_min({value_sql}, {order_sql}) FILTER (WHERE {key_col} = '{v}') AS \"{v}\"" for v in values
    )
    return (
        f"SELECT {index_sql} AS \"TIME\",\n  {cols}\nFROM {source}\n"
        f"WHERE ({value_sql}) IS NOT NULL AND {key_col} IS NOT NULL AND ({where})\nGROUP BY 1"
    )
