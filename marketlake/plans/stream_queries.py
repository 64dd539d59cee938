"""Streaming queries: history files arrive in two drops; each run loads only what is new."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marketlake.plans.catalog import register
from marketlake.plans.history_queries import COLS, stored_history
from marketlake.plans.standins import CUTOFF, price_history
from marketlake.session import read_table, scratch_path
from marketlake.sinks.files import write_parquet
from marketlake.sinks.tables import create_if_absent
from marketlake.streaming.files import ingest_new_files, upsert_new_files


@register(
    "stream_new_files",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
  o_orderpriority FROM orders""",
)
def stream_new_files(spark, sf_dir):
    """Drop 1 (before the cut-off) -> run; drop 2 -> run; an extra run adds nothing."""
    o = read_table(spark, sf_dir, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))
    src, sink, ckpt = (scratch_path(spark, n) for n in ("landing", "stream_sink", "stream_ckpt"))
    cut = F.lit(CUTOFF).cast("date")
    write_parquet(o.where(F.col("o_orderdate") < cut), f"{src}/drop-1", mode="errorifexists")
    ingest_new_files(spark, src, o.schema, sink, ckpt)
    write_parquet(o.where(~(F.col("o_orderdate") < cut) | F.col("o_orderdate").isNull()), f"{src}/drop-2",
                  mode="errorifexists")
    ingest_new_files(spark, src, o.schema, sink, ckpt)
    ingest_new_files(spark, src, o.schema, sink, ckpt)
    return spark.read.parquet(sink)


@register(
    "stream_upsert",
    f"""WITH h AS (SELECT o_custkey AS code, CAST(o_orderdate AS DATE) AS date, o_totalprice AS price,
  o_orderkey AS row_key, o_orderstatus AS status FROM orders),
stored AS (SELECT code, date, price, row_key FROM h WHERE date < DATE '{CUTOFF}' AND status = 'F'),
last AS (SELECT code, max(date) AS last_date FROM stored GROUP BY code)
SELECT * FROM stored
UNION ALL
SELECT h.code, h.date, h.price, h.row_key FROM h LEFT JOIN last ON h.code = last.code
WHERE last.last_date IS NULL OR h.date > last.last_date""",
)
def stream_upsert(spark, sf_dir):
    """Drop 1 = the stored history, drop 2 = everything the source now offers
    (including stale rows). foreachBatch appends only rows newer than each
    code's last stored day; a rerun appends nothing."""
    schema = StructType.fromDDL("code bigint, date date, price double, row_key bigint")
    src, root, ckpt = (scratch_path(spark, n) for n in ("landing", "tables", "upsert_ckpt"))
    name = f"ml_stream_history_{uuid.uuid4().hex[:10]}"
    create_if_absent(spark, name, schema, root)
    write_parquet(stored_history(spark, sf_dir), f"{src}/drop-1", mode="errorifexists")
    upsert_new_files(spark, src, schema, name, ckpt)
    write_parquet(price_history(spark, sf_dir).select(*COLS), f"{src}/drop-2", mode="errorifexists")
    upsert_new_files(spark, src, schema, name, ckpt)
    upsert_new_files(spark, src, schema, name, ckpt)
    return spark.table(name)
