"""Ranking queries: top-N with ranks, parallel-list zip, exchange codes, name/code cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlake.functions import file_stem, int_code, object_path, strip_quotes, uri_bucket, uri_key, zfill
from marketlake.operators.ranking import exchange_code, rank_top, zip_lists
from marketlake.plans.catalog import register
from marketlake.plans.standins import companies
from marketlake.session import read_table

TOP_N = 100
# Fixed values of the stand-in: market segment -> exchange code (two mapped, the rest unknown).
SEGMENT_CODES = {"AUTOMOBILE": "AUT", "BUILDING": "BLD"}

RANK_SQL = (
    "CAST(row_number() OVER (ORDER BY c_acctbal DESC NULLS LAST, c_custkey) AS INTEGER)"
)


def ranked_companies(spark, sf_dir, n: int = TOP_N):
    return rank_top(companies(spark, sf_dir), n, "metric", "code")


@register(
    "rank_top100",
    f"""SELECT ranking, code, name FROM (
  SELECT {RANK_SQL} AS ranking, c_custkey AS code, c_name AS name FROM customer) t
WHERE ranking <= 100""",
)
def rank_top100(spark, sf_dir):
    """W1 + L2: the 100 largest companies with ranking 1..100 (ties by code)."""
    return ranked_companies(spark, sf_dir).select("ranking", "code", "name")


@register(
    "zip_lists",
    f"""SELECT ranking AS pos, name, code FROM (
  SELECT {RANK_SQL} AS ranking, c_name AS name, CAST(c_custkey AS VARCHAR) AS code FROM customer) t
WHERE ranking <= 100""",
)
def zip_lists_q(spark, sf_dir):
    """The ranking page as two parallel lists (names, codes), zipped back by position.

    The lists are built from the top-100 only (a bounded group of 100 rows).
    """
    top = ranked_companies(spark, sf_dir)
    page = top.agg(F.sort_array(F.collect_list(F.struct("ranking", "name", F.col("code").cast("string").alias("code"))))
                   .alias("items"))
    lists = page.select(
        F.transform("items", lambda x: x["name"]).alias("names"),
        F.transform("items", lambda x: x["code"]).alias("codes"),
    )
    return zip_lists(lists, "names", "codes", ("name", "code"), "pos")


@register(
    "exchange_map",
    """SELECT c_custkey AS code, c_mktsegment AS exchange,
  CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'AUT' WHEN 'BUILDING' THEN 'BLD' ELSE 'baddata' END AS excode
FROM customer""",
)
def exchange_map(spark, sf_dir):
    """X13 + J4 mapping step: exchange -> code, anything unmapped -> 'baddata'."""
    c = companies(spark, sf_dir)
    return c.select("code", "exchange", exchange_code("exchange", SEGMENT_CODES).alias("excode"))


@register(
    "clean_name",
    """SELECT p_partkey AS code, replace(replace('''' || p_name || '"', '''', ''), '"', '') AS name,
  '''' || p_name || '"' AS raw_name FROM part""",
)
def clean_name(spark, sf_dir):
    """Quotes removed from scraped names (names arrive wrapped in ' and ")."""
    p = read_table(spark, sf_dir, "part")
    raw = F.concat(F.lit("'"), F.col("p_name"), F.lit('"'))
    return p.select(F.col("p_partkey").alias("code"), strip_quotes(raw).alias("name"), raw.alias("raw_name"))


@register(
    "pad_code",
    """SELECT p_partkey,
  CASE WHEN length(CAST(p_partkey AS VARCHAR)) < 6 THEN lpad(CAST(p_partkey AS VARCHAR), 6, '0')
       ELSE CAST(p_partkey AS VARCHAR) END AS code_zfill,
  CASE WHEN length(CAST(p_partkey * 1000 + p_size AS VARCHAR)) < 6
       THEN lpad(CAST(p_partkey * 1000 + p_size AS VARCHAR), 6, '0')
       ELSE CAST(p_partkey * 1000 + p_size AS VARCHAR) END AS long_zfill,
  printf('%06d', p_partkey) AS code_fmt
FROM part""",
)
def pad_code(spark, sf_dir):
    """X7 + X8: zero-fill to 6 without truncating longer codes; int -> %06d."""
    p = read_table(spark, sf_dir, "part")
    longer = F.col("p_partkey") * 1000 + F.col("p_size")  # 7+ digits for most parts
    return p.select(
        "p_partkey",
        zfill("p_partkey").alias("code_zfill"),
        zfill(longer).alias("long_zfill"),
        int_code("p_partkey").alias("code_fmt"),
    )


@register(
    "uri_parts",
    """SELECT c_custkey, 's3://lake-' || lower(c_mktsegment) || '/history/' || CAST(c_custkey AS VARCHAR) || '.csv' AS uri,
  'lake-' || lower(c_mktsegment) AS bucket,
  'history/' || CAST(c_custkey AS VARCHAR) || '.csv' AS key,
  CAST(c_custkey AS VARCHAR) AS stem
FROM customer""",
)
def uri_parts(spark, sf_dir):
    """X10-X12 + X15: build the object URI of each code, split it back into bucket / key / stem."""
    c = read_table(spark, sf_dir, "customer")
    uri = F.concat(F.lit("s3://lake-"), F.lower("c_mktsegment"), object_path("/history/", "c_custkey", ".csv"))
    u = c.select("c_custkey", uri.alias("uri"))
    return u.select("c_custkey", "uri", uri_bucket("uri").alias("bucket"), uri_key("uri").alias("key"),
                    file_stem("uri").alias("stem"))
