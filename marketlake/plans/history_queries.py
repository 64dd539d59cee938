"""Price-history queries: known/new split, latest date/row, increments, retention, volatility."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlake.operators.history import (
    append_incremental,
    attach,
    history_of,
    latest_date,
    latest_row,
    retention_split,
    since,
    split_known,
)
from marketlake.operators.ranking import first_k_codes
from marketlake.operators.volatility import daily_first_price, high_volatility
from marketlake.plans.catalog import register
from marketlake.plans.ranking_queries import RANK_SQL, ranked_companies
from marketlake.plans.standins import CUTOFF, companies, price_history
from marketlake.session import read_table
from marketlake.sources.warehouse import distinct_projection

HISTORY_SQL = """SELECT o_custkey AS code, CAST(o_orderdate AS DATE) AS date, o_totalprice AS price,
  o_orderkey AS row_key, o_orderstatus AS status FROM orders"""
TOP100_SQL = f"""SELECT c_custkey AS code, c_name AS name FROM (
  SELECT {RANK_SQL} AS ranking, c_custkey, c_name FROM customer) t WHERE ranking <= 100"""
COLS = ["code", "date", "price", "row_key"]


def stored_history(spark, sf_dir):
    """What the lake already holds: settled ('F') rows before the cut-off."""
    h = price_history(spark, sf_dir)
    return h.where((F.col("date") < F.lit(CUTOFF).cast("date")) & (F.col("status") == "F")).select(*COLS)


@register(
    "known_codes",
    f"""SELECT c_custkey AS code, c_name AS name FROM customer c WHERE EXISTS (
  SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderdate < DATE '{CUTOFF}')""",
)
def known_codes(spark, sf_dir):
    """J2 (semi): companies that already have stored history -> incremental path."""
    stored = price_history(spark, sf_dir).where(F.col("date") < F.lit(CUTOFF).cast("date"))
    known, _ = split_known(companies(spark, sf_dir).select("code", "name"), stored)
    return known


@register(
    "new_codes",
    f"""SELECT c_custkey AS code, c_name AS name FROM customer c WHERE NOT EXISTS (
  SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderdate < DATE '{CUTOFF}')""",
)
def new_codes(spark, sf_dir):
    """J2 (anti): companies without stored history -> full backfill path."""
    stored = price_history(spark, sf_dir).where(F.col("date") < F.lit(CUTOFF).cast("date"))
    _, new = split_known(companies(spark, sf_dir).select("code", "name"), stored)
    return new


@register(
    "latest_date",
    "SELECT o_custkey AS code, max(CAST(o_orderdate AS DATE)) AS last_date FROM orders GROUP BY 1",
)
def latest_date_q(spark, sf_dir):
    """A5 / L3: newest stored date per code, one aggregate for all codes."""
    return latest_date(price_history(spark, sf_dir))


@register(
    "latest_row",
    f"""SELECT code, date, price, row_key FROM (
  SELECT *, row_number() OVER (PARTITION BY code ORDER BY date DESC, row_key DESC) AS rn
  FROM ({HISTORY_SQL}) h) t WHERE rn = 1""",
)
def latest_row_q(spark, sf_dir):
    """The whole newest row per code (ties: larger row key)."""
    return latest_row(price_history(spark, sf_dir).select(*COLS), "code", ["date", "row_key"])


@register(
    "incremental_append",
    f"""WITH h AS ({HISTORY_SQL}),
stored AS (SELECT code, date, price, row_key FROM h WHERE date < DATE '{CUTOFF}' AND status = 'F'),
last AS (SELECT code, max(date) AS last_date FROM stored GROUP BY code)
SELECT * FROM stored
UNION ALL
SELECT h.code, h.date, h.price, h.row_key FROM h LEFT JOIN last ON h.code = last.code
WHERE last.last_date IS NULL OR h.date > last.last_date""",
)
def incremental_append(spark, sf_dir):
    """F3 + U3: stored history plus incoming rows newer than the code's last stored
    day (or of an unknown code). Stale incoming rows (not newer) are rejected."""
    incoming = price_history(spark, sf_dir).select(*COLS)
    return append_incremental(stored_history(spark, sf_dir), incoming)


@register(
    "history_since",
    f"""SELECT h.code, h.date, h.price, h.row_key FROM ({HISTORY_SQL}) h
WHERE h.date >= DATE '1998-01-01' AND h.code IN (SELECT code FROM ({TOP100_SQL}) t)""",
)
def history_since(spark, sf_dir):
    """S11 + F2: rows of the top-100 codes from a start date on."""
    top = ranked_companies(spark, sf_dir)
    return since(price_history(spark, sf_dir).select(*COLS), top, "1998-01-01")


@register(
    "retention_keep",
    f"""SELECT h.code, h.date, h.price, h.row_key FROM ({HISTORY_SQL}) h
WHERE h.code IN (SELECT code FROM ({TOP100_SQL}) t)""",
)
def retention_keep(spark, sf_dir):
    """History of codes still in the top 100 (survivors)."""
    kept, _ = retention_split(price_history(spark, sf_dir).select(*COLS), ranked_companies(spark, sf_dir))
    return kept


@register(
    "retention_drop",
    f"""SELECT h.code, h.date, h.price, h.row_key FROM ({HISTORY_SQL}) h
WHERE h.code NOT IN (SELECT code FROM ({TOP100_SQL}) t)""",
)
def retention_drop(spark, sf_dir):
    """J3 + U4: history of codes that left the top 100 (to be deleted)."""
    _, dropped = retention_split(price_history(spark, sf_dir).select(*COLS), ranked_companies(spark, sf_dir))
    return dropped


@register(
    "history_attach",
    f"""SELECT h.code, c.c_name AS name, h.date, h.price, h.row_key
FROM ({HISTORY_SQL}) h JOIN customer c ON h.code = c.c_custkey""",
)
def history_attach(spark, sf_dir):
    """J6 + P4: company name on every history row."""
    return attach(price_history(spark, sf_dir).select(*COLS), companies(spark, sf_dir), "code", ["name"])


@register(
    "topk_history",
    f"""SELECT h.code, h.date, h.price, h.row_key FROM ({HISTORY_SQL}) h
WHERE h.code IN (SELECT code FROM (
  SELECT {RANK_SQL} AS ranking, c_custkey AS code FROM customer) t WHERE ranking <= 3)""",
)
def topk_history(spark, sf_dir):
    """L1 + J1: history of the first three ranked codes (a literal IN filter on
    the three codes, pushed into the scan)."""
    top3 = first_k_codes(ranked_companies(spark, sf_dir), 3)
    return history_of(price_history(spark, sf_dir).select(*COLS), top3, 3)


@register(
    "distinct_pairs",
    "SELECT DISTINCT p_brand, p_type FROM part",
)
def distinct_pairs(spark, sf_dir):
    """S7 + A6: distinct (brand, type) pairs (map-side de-dup, then shuffle)."""
    return distinct_projection(read_table(spark, sf_dir, "part"), ["p_brand", "p_type"])


VOLATILITY_SQL = """WITH d AS (
  SELECT l_suppkey AS code, CAST(l_shipdate AS DATE) AS date,
    arg_min(l_extendedprice, struct_pack(a := l_orderkey, b := l_linenumber, c := l_partkey, d := l_extendedprice)) AS price
  FROM lineitem WHERE l_shipdate IS NOT NULL AND l_extendedprice IS NOT NULL GROUP BY 1, 2),
s AS (SELECT code, date, price, lag(price) OVER (PARTITION BY code ORDER BY date) AS prev_price FROM d)
SELECT code, date, price, prev_price, (price / prev_price - 1.0) * 100.0 AS change FROM s
WHERE prev_price IS NOT NULL AND abs((price / prev_price - 1.0) * 100.0) >= 5.0"""


@register("high_volatility", VOLATILITY_SQL)
def high_volatility_q(spark, sf_dir):
    """Daily first price per supplier code, rows whose change is >= 5 % in absolute value."""
    li = read_table(spark, sf_dir, "lineitem")
    series = daily_first_price(li, "l_suppkey", "l_shipdate", "l_extendedprice",
                               ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"])
    return high_volatility(series, 5.0)


@register(
    "per_key_upsert",
    f"""WITH h AS ({HISTORY_SQL}), top AS ({TOP100_SQL}),
stored AS (SELECT code, date, price, row_key FROM h
           WHERE date < DATE '{CUTOFF}' AND status = 'F' AND code IN (SELECT code FROM top)),
last AS (SELECT code, max(date) AS last_date FROM stored GROUP BY code)
SELECT * FROM stored
UNION ALL
SELECT h.code, h.date, h.price, h.row_key FROM h LEFT JOIN last ON h.code = last.code
WHERE h.code IN (SELECT code FROM top) AND (last.last_date IS NULL OR h.date > last.last_date)""",
)
def per_key_upsert(spark, sf_dir):
    """One directory per code (the top-100 only); the stored history is
    laid down, then the incoming rows are upserted twice (the rerun adds
    nothing): only rows newer than each code's last stored day are appended."""
    from pyspark.sql.types import StructType

    from marketlake.session import scratch_path
    from marketlake.sinks.files import upsert_per_key

    schema = StructType.fromDDL("code bigint, date date, price double, row_key bigint")
    top = ranked_companies(spark, sf_dir).select("code")
    path = scratch_path(spark, "per_code_history")
    stored = stored_history(spark, sf_dir).join(top, "code", "left_semi")
    incoming = price_history(spark, sf_dir).select(*COLS).join(top, "code", "left_semi")
    upsert_per_key(spark, path, stored, schema)
    upsert_per_key(spark, path, incoming, schema)
    upsert_per_key(spark, path, incoming, schema)
    return spark.read.schema(schema).parquet(path).select(*COLS)
