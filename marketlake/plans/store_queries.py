"""Queries of the history store: increments, refresh, retention on two stores, volatility by parts, stream."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marketlake.operators.common import bounded_values
from marketlake.operators.volatility import daily_first_price
from marketlake.plans import job_queries, store_jobs  # noqa: F401  job_queries registers the SQL that is used here
from marketlake.plans.catalog import ORACLE, register
from marketlake.plans.history_queries import COLS, HISTORY_SQL, TOP100_SQL, VOLATILITY_SQL, stored_history
from marketlake.plans.jobs import top_listing
from marketlake.plans.ranking_queries import ranked_companies
from marketlake.plans.standins import companies, price_history
from marketlake.session import read_table, scratch_path
from marketlake.sinks.files import write_parquet, write_partitioned
from marketlake.sinks.history_store import HistoryStore
from marketlake.sources.price_lookup import price_lookup
from marketlake.streaming.keyed import stream_into_store

PRICES = "code bigint, date date, price double, row_key bigint"


def new_store(spark, schema: str, **kw) -> HistoryStore:
    return HistoryStore(spark, scratch_path(spark, "history_store"), StructType.fromDDL(schema), buckets=4, **kw)


@register("store_upsert", ORACLE["incremental_append"])
def store_upsert(spark, sf_dir):
    """The stored history as one load, then everything the source
    offers, twice; what is newer is told by the index of last days alone."""
    store = new_store(spark, PRICES)
    store.add(stored_history(spark, sf_dir))
    incoming = price_history(spark, sf_dir).select(*COLS)
    store.add(incoming)
    if store.add(incoming).stored:
        raise RuntimeError("a repeated load stored rows")
    return store.read()


@register(
    "store_lookup",
    f"""SELECT h.code, h.date, h.price, h.row_key FROM ({HISTORY_SQL}) h
WHERE h.date >= DATE '1997-01-01' AND h.code IN (SELECT code FROM ({TOP100_SQL}) t)""",
)
def store_lookup(spark, sf_dir):
    """S11, J1 on the store: the top 100's rows from a day on; load, bucket and year are partition filters."""
    store = new_store(spark, PRICES)
    store.add(price_history(spark, sf_dir).select(*COLS))
    return store.read(codes=ranked_companies(spark, sf_dir).select("code"), since="1997-01-01")


@register("store_refresh", ORACLE["job_history_refresh"])
def store_refresh(spark, sf_dir):
    """E3 on the store: settled rows before the cut-off, refreshed for the current top 100, twice."""
    store = new_store(spark, "code bigint, name string, date date, price double, row_key bigint")
    comp = companies(spark, sf_dir)
    store.add(stored_history(spark, sf_dir).join(comp.select("code", "name"), "code"))
    prices = price_history(spark, sf_dir).select(*COLS)
    manifest = scratch_path(spark, "manifest")
    listing = top_listing(comp, 100)
    store_jobs.refresh_store_job(listing, prices, store, manifest)
    if store_jobs.refresh_store_job(listing, prices, store, manifest).stored:
        raise RuntimeError("a repeated refresh stored rows")
    return store.read()


NATION_SQL = """SELECT c.c_nationkey AS code, CAST(o.o_orderdate AS DATE) AS date, o.o_totalprice AS price, o.o_orderkey AS row_key
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey"""


@register(
    "store_retention",
    f"""WITH kept AS (SELECT * FROM ({NATION_SQL}) h WHERE code IN (
  SELECT c_nationkey FROM customer GROUP BY 1 ORDER BY count(*) DESC, c_nationkey LIMIT 10))
SELECT 'rows' AS store, * FROM kept UNION ALL SELECT 'objects' AS store, * FROM kept""",
)
def store_retention(spark, sf_dir):
    """E7 on two stores: orders by the customer's nation, as rows of the store and in one folder per
    code beside it; codes that are not among the ten with the most customers go from
    both. The first run "crashes" between the two; the rerun ends it."""
    customers = read_table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").cast("long").alias("nation"))
    history = price_history(spark, sf_dir).join(customers, F.col("code") == F.col("c_custkey")).select(F.col("nation").alias("code"), *COLS[1:])
    store = new_store(spark, PRICES)
    store.add(history)
    objects, intents = scratch_path(spark, "objects"), scratch_path(spark, "intents")
    write_partitioned(history, objects, ["code"])
    listed = customers.groupBy("nation").count().orderBy(F.desc("count"), "nation").limit(10).select(F.col("nation").alias("code"))
    leaving = store.index().select(F.col("code").cast("string")).join(listed.select(F.col("code").cast("string")), "code", "left_anti")
    leaving.write.parquet(f"{intents}/gone-crashed")
    store.delete(leaving)  # "crash" before the objects
    store_jobs.retention_stores_job(store, objects, listed, intents)
    left = spark.read.schema(StructType.fromDDL(PRICES)).parquet(objects).select(*COLS)
    return store.read().select(F.lit("rows").alias("store"), *COLS).unionByName(left.select(F.lit("objects").alias("store"), *COLS))


@register("store_volatility", VOLATILITY_SQL)
def store_volatility(spark, sf_dir):
    """W3, E6 by parts: three runs over ranges of days, one repeated; each reads its new days and the boundary prices."""
    li = read_table(spark, sf_dir, "lineitem")
    store = new_store(spark, "code bigint, date date, price double, prev_price double, change double", carry=("price",))
    day = F.to_date("l_shipdate")
    for lo, hi in ((None, "1994-03-01"), ("1994-03-01", "1996-09-15"), ("1994-03-01", "1996-09-15"), ("1996-09-15", None)):
        part = li.where((F.lit(True) if lo is None else day >= F.lit(lo).cast("date")) & (F.lit(True) if hi is None else day < F.lit(hi).cast("date")))
        store_jobs.extend_changes(store, daily_first_price(part, "l_suppkey", "l_shipdate", "l_extendedprice", ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]))
    return store_jobs.volatile_days(store, 5.0)


@register("stream_store", ORACLE["incremental_append"])
def stream_store(spark, sf_dir):
    """T2 with state per code: drop 1 = the stored history, drop 2 = everything the source now
    offers, in micro-batches of one file; an extra run adds nothing."""
    store = new_store(spark, PRICES)
    src, ckpt = scratch_path(spark, "landing"), scratch_path(spark, "ckpt")
    write_parquet(stored_history(spark, sf_dir), f"{src}/drop-1", mode="errorifexists")
    stream_into_store(spark, src, store, ckpt, maxFilesPerTrigger=1)
    incoming = price_history(spark, sf_dir).select(*COLS)
    early = F.col("date") < F.lit("1997-06-01").cast("date")
    write_parquet(incoming.where(early), f"{src}/drop-2", mode="errorifexists")
    write_parquet(incoming.where(~early | F.col("date").isNull()), f"{src}/drop-3", mode="errorifexists")
    stream_into_store(spark, src, store, ckpt, maxFilesPerTrigger=1)
    stream_into_store(spark, src, store, ckpt, maxFilesPerTrigger=1)
    return store.read()


@register("price_lookup", ORACLE["history_since"])
def price_lookup_q(spark, sf_dir):
    """The landed prices of the top 100 (one folder per code), looked up by code and from a day on
    through a data source of its own, which takes both filters."""
    top = ranked_companies(spark, sf_dir).select("code")
    landed = scratch_path(spark, "landed")
    write_partitioned(price_history(spark, sf_dir).select(*COLS).join(top, "code", "left_semi"), landed, ["code"])
    return price_lookup(spark, landed, PRICES, bounded_values(top, "code", 100), "1998-01-01")
