"""The published series as whole jobs (E1, E2), large responses (S1) and pivots of any width (A3)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from marketlake.functions import json_field, map_lookup, stat_time
from marketlake.operators.reshape import block_values, pivot_blocks
from marketlake.plans import series
from marketlake.plans.catalog import register
from marketlake.plans.jobs import series_job
from marketlake.plans.macro_queries import DAY_SQL
from marketlake.plans.standins import EVENT_TYPES, MISSING_VALUE_SQL, pivot_sql, stat_long
from marketlake.session import cut_lineage, read_table, scratch_path
from marketlake.sinks.files import write_partitioned
from marketlake.sources.files import read_csv
from marketlake.sources.statistics import read_large_statistics, to_stat_long

# Fixed values of the stand-in: market segment -> file name of a country's response; the others have none.
GDP_FILES = {"AUTOMOBILE": "KOR", "BUILDING": "JPN", "FURNITURE": "USA", "MACHINERY": "China"}
GDP_NAMES = {"AUTOMOBILE": "Korea", "BUILDING": "Japan", "FURNITURE": "USA", "MACHINERY": "China"}


def _publish(spark, long, shape, sort_by, evolve=False):
    """The whole job: raw landing, processed CSV, table; the CSV must hold the table's rows."""
    processed = scratch_path(spark, "processed")
    table = f"ml_series_{uuid.uuid4().hex[:10]}"
    out = series_job(long, shape, scratch_path(spark, "raw"), processed, table, scratch_path(spark, "tables"), sort_by, evolve)
    if read_csv(spark, processed, schema=out.schema, check_header=True).exceptAll(out).count():
        raise RuntimeError("the processed CSV and the table differ")
    return out


@register("series_kospi", pivot_sql(DAY_SQL, "event_type", MISSING_VALUE_SQL, "event_id", EVENT_TYPES, "events", "ts IS NOT NULL"))
def series_kospi(spark, sf_dir):
    """E1 of the index series: all items found become columns; missing values never win "first"."""
    return _publish(spark, stat_long(spark, sf_dir, with_missing=True), lambda raw: series.kospi(raw, ["event_id"]), ["TIME"], evolve=True)


@register("series_news_sentiment", f"""SELECT {DAY_SQL} AS "TIME", {MISSING_VALUE_SQL} AS "NewsSentiment" FROM events""")
def series_news_sentiment(spark, sf_dir):
    """E1 of the news sentiment: every row, one value renamed."""
    return _publish(spark, stat_long(spark, sf_dir, with_missing=True), series.news_sentiment, ["TIME"])


_GDP_CASE = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in GDP_NAMES.items())


@register(
    "series_gdp",
    f"""SELECT CASE c_mktsegment {_GDP_CASE} END AS country, strftime(o_orderdate, '%Y') AS "Date",
  CAST(COALESCE(SUM(CAST(o_orderkey AS DOUBLE)), 0) AS DOUBLE) AS "GDP"
FROM orders JOIN customer ON o_custkey = c_custkey
WHERE c_mktsegment IN ({", ".join(f"'{k}'" for k in GDP_NAMES)}) AND o_orderdate IS NOT NULL GROUP BY 1, 2""",
)
def series_gdp(spark, sf_dir):
    """E1 of the national accounts: yearly sums of whole numbers per country, which the response's file name tells."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey", map_lookup("c_mktsegment", GDP_FILES).alias("file")).where(F.col("file").isNotNull())
    o = read_table(spark, sf_dir, "orders")
    long = o.join(c, F.col("o_custkey") == F.col("c_custkey")).select(
        F.concat(F.lit("landing/"), F.col("file"), F.lit(".json")).alias("source_file"), stat_time("o_orderdate", "A").alias("TIME"), F.col("o_orderkey").cast("double").alias("DATA_VALUE"))
    return _publish(spark, long, lambda raw: series.gdp(series.country_from_file(raw)), ["country", "Date"])


STATEMENT_VALUES = [(s, f, n) for s in ("F", "O") for f in ("A", "N", "R") for n in ("1", "2", "7")]
STATEMENT_ORDER = ["l_orderkey", "l_partkey", "l_extendedprice"]
_STATEMENT_CELLS = ",\n  ".join(
    f"""arg_min(l_extendedprice, (l_orderkey, l_partkey, l_extendedprice)) FILTER (WHERE l_linestatus = '{s}' AND l_returnflag = '{f}' AND l_linenumber = {n}) AS "{s}|{f}|{n}\""""
    for s, f, n in STATEMENT_VALUES)


@register(
    "series_statements",
    f"""SELECT make_date(CAST(year(l_shipdate) AS INTEGER), 1, 1) AS "Date",
  {_STATEMENT_CELLS}
FROM lineitem WHERE l_linestatus IS NOT NULL AND l_linenumber IS NOT NULL AND l_returnflag IS NOT NULL AND l_shipdate IS NOT NULL
  AND l_extendedprice IS NOT NULL GROUP BY 1""",
)
def series_statements(spark, sf_dir):
    """E2 with its three-part key: yearly rows -> one column per (name 1, name 2, name 3), first by input order."""
    long = read_table(spark, sf_dir, "lineitem").select(
        stat_time("l_shipdate", "A").alias("TIME"), F.col("l_linestatus").alias("ITEM_NAME1"), F.col("l_returnflag").alias("ITEM_NAME2"), F.col("l_linenumber").cast("string").alias("ITEM_NAME3"),
        F.col("l_extendedprice").alias("DATA_VALUE"), *STATEMENT_ORDER)
    return _publish(spark, long, lambda raw: series.financial_statements(raw, STATEMENT_ORDER, STATEMENT_VALUES), ["Date"])


@register(
    "json_large",
    f"""SELECT row_number() OVER (ORDER BY event_id) - 1 AS row_pos, event_type || ' "}}{{[,\\' AS "STAT_NAME", event_type AS "ITEM_NAME1",
  CAST(NULL AS VARCHAR) AS "WGT", {DAY_SQL} AS "TIME", value AS "DATA_VALUE" FROM events""",
)
def json_large(spark, sf_dir):
    """S1 on one document with a record per event: read record by record in pieces of 256 KB, with each
    record's position; names hold quotes, braces and backslashes."""
    ev = read_table(spark, sf_dir, "events")
    record = F.to_json(F.struct(
        F.concat("event_type", F.lit(' "}{[,\\')).alias("STAT_NAME"), F.col("event_type").alias("ITEM_NAME1"), stat_time("ts").alias("TIME"),
        F.col("value").cast("string").alias("DATA_VALUE"), json_field("props", "$.k", "string").alias("EXTRA_FIELD")))
    # Sorted and numbered by many tasks; the one that writes the document's single file only copies.
    lines = ev.select("event_id", record.alias("record")).orderBy(F.col("event_id").asc_nulls_first())
    lines = cut_lineage(lines.select(F.monotonically_increasing_id().alias("n"), "record"))
    count, first, last = lines.agg(F.count(F.lit(1)), F.min("n"), F.max("n")).first()
    head = f'{{"StatisticSearch": {{"list_total_count": {count}, "row": [\n'
    n = F.col("n")
    value = F.concat(F.when(n == first, F.lit(head)).otherwise(F.lit("")), "record", F.when(n < last, F.lit(",")).otherwise(F.lit("]}}")))
    path = scratch_path(spark, "response")
    lines.select(value.alias("value")).coalesce(1).write.text(path)
    piece = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(piece)
    spark.conf.set(piece, str(256 << 10))
    try:
        rows = to_stat_long(read_large_statistics(spark, path)).select("row_pos", "STAT_NAME", "ITEM_NAME1", "WGT", "TIME", "DATA_VALUE")
        rows.write.parquet(parsed := scratch_path(spark, "parsed"))
    finally:
        spark.conf.set(piece, before)
    return spark.read.parquet(parsed)


FOLDER_BLOCKS = 64


@register(
    "pivot_sparse",
    """SELECT l_returnflag AS "TIME", CAST(l_orderkey AS VARCHAR) AS item, arg_min(l_extendedprice, (l_linenumber, l_partkey, l_extendedprice)) AS value
FROM lineitem WHERE l_returnflag IS NOT NULL AND l_orderkey IS NOT NULL AND l_extendedprice IS NOT NULL GROUP BY 1, 2""",
)
def pivot_sparse(spark, sf_dir):
    """A3, A4 with an item per order (15,000 at sf0.01): blocks of 1,000 places instead of columns, written
    (a folder holds FOLDER_BLOCKS of them, not one) and read as rows again."""
    long = read_table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("TIME"), F.col("l_orderkey").cast("string").alias("ITEM_NAME1"), F.col("l_extendedprice").alias("DATA_VALUE"), "l_linenumber", "l_partkey", "l_extendedprice")
    layout, cells = pivot_blocks(long, "TIME", "ITEM_NAME1", "DATA_VALUE", ["l_linenumber", "l_partkey", "l_extendedprice"])
    write_partitioned(cells.withColumn("blocks", F.floor(F.col("block") / FOLDER_BLOCKS)), path := scratch_path(spark, "blocks"), ["blocks"])
    return block_values(layout, spark.read.schema(cells.schema).parquet(path), "TIME")
