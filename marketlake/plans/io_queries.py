"""Source / sink queries: every writer is followed by the matching reader.

Scratch output goes under the session's checkpoint directory (shared storage
on a cluster); each call uses fresh paths and table names, so reruns and
concurrent runs never collide, and the returned frames stay readable.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from marketlake.functions import zfill
from marketlake.operators.conform import conform, typed_history
from marketlake.operators.history import split_known
from marketlake.plans.catalog import register
from marketlake.plans.jobs import load_listed_codes
from marketlake.plans.ranking_queries import RANK_SQL, ranked_companies
from marketlake.plans.standins import CUTOFF, companies, price_history
from marketlake.schemas import AVRO_HISTORY
from marketlake.session import read_table, scratch_path
from marketlake.sinks.files import write_csv, write_gzip_csv, write_orc, write_parquet, write_partitioned
from marketlake.sinks.jdbc import reload_jdbc
from marketlake.sinks.tables import (
    append_rows,
    create_if_absent,
    guarded_replace,
    replace_table,
    truncate_reload,
    with_run_date,
)
from marketlake.sources.files import drop_row_index, existing_keys, read_csv, read_parts
from marketlake.sources.warehouse import list_tables, read_jdbc, table_row_counts

DERBY_DRIVER = "org.apache.derby.iapi.jdbc.AutoloadedDriver"


def _table_name(prefix: str) -> str:
    return f"ml_{prefix}_{uuid.uuid4().hex[:10]}"


def _local_path(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


# ----------------------------------------------------------------- file formats


@register("csv_roundtrip", "SELECT * FROM customer")
def csv_roundtrip(spark, sf_dir):
    """K1 + S2: CSV with header written, read back with the explicit schema and a header check."""
    c = read_table(spark, sf_dir, "customer")
    path = scratch_path(spark, "csv")
    write_csv(c, path)
    return read_csv(spark, path, schema=c.schema, check_header=True)


@register("parquet_roundtrip", "SELECT * FROM part")
def parquet_roundtrip(spark, sf_dir):
    """K5."""
    p = read_table(spark, sf_dir, "part")
    path = scratch_path(spark, "parquet")
    write_parquet(p, path)
    return spark.read.parquet(path)


@register(
    "orc_roundtrip",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
  o_orderpriority FROM orders""",
)
def orc_roundtrip(spark, sf_dir):
    """K4."""
    o = read_table(spark, sf_dir, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))
    path = scratch_path(spark, "orc")
    write_orc(o, path)
    return spark.read.orc(path)


@register("drop_row_index", "SELECT * FROM supplier")
def drop_row_index_q(spark, sf_dir):
    """A CSV saved with an unnamed leading index column is read without it."""
    s = read_table(spark, sf_dir, "supplier")
    path = scratch_path(spark, "indexed_csv")
    write_csv(s.select(F.col("s_suppkey").cast("string").alias(""), *s.columns), path)
    schema = StructType([StructField("_c0", StringType(), True)] + s.schema.fields)
    return drop_row_index(read_csv(spark, path, schema=schema))


@register(
    "raw_partitioned",
    "SELECT * FROM customer",
)
def raw_partitioned(spark, sf_dir):
    """K2: raw zone copy partitioned by an attribute (salted writers), read back by partition."""
    c = read_table(spark, sf_dir, "customer")
    path = scratch_path(spark, "raw")
    write_partitioned(c, path, ["c_mktsegment"], files_per_value=4)
    return spark.read.schema(c.schema).parquet(path).select(*c.columns)


@register("csv_parts", "SELECT * FROM orders")
def csv_parts(spark, sf_dir):
    """One CSV part per order status, read as one table in a single scan, header held against the schema."""
    o = read_table(spark, sf_dir, "orders")
    paths = []
    for status in ("F", "O", None):
        paths.append(scratch_path(spark, "part"))
        rest = ~F.col("o_orderstatus").isin("F", "O") | F.col("o_orderstatus").isNull()
        write_csv(o.where(rest if status is None else F.col("o_orderstatus") == status), paths[-1])
    return read_parts(spark, paths, "csv", o.schema)


@register("load_by_position", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def load_by_position(spark, sf_dir):
    """A load whose columns have other names fills the table's by position; another number of columns raises."""
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    root, name = scratch_path(spark, "tables"), _table_name("supplier")
    create_if_absent(spark, name, s.schema, root)
    try:
        truncate_reload(s.drop("s_name"), name, root, by_position=True)
    except ValueError:
        return truncate_reload(s.toDF("a", "b", "c", "d"), name, root, by_position=True)
    raise RuntimeError("a load of three columns filled a table of four")


@register(
    "keys_from_paths",
    """SELECT DISTINCT CASE WHEN length(CAST(c_nationkey AS VARCHAR)) < 6
  THEN lpad(CAST(c_nationkey AS VARCHAR), 6, '0') ELSE CAST(c_nationkey AS VARCHAR) END AS code FROM customer""",
)
def keys_from_paths(spark, sf_dir):
    """S6 + F4 + X10/X11: one CSV directory per code; codes recovered from object names only."""
    c = read_table(spark, sf_dir, "customer").withColumn("code", zfill("c_nationkey"))
    path = scratch_path(spark, "per_code")
    write_partitioned(c, path, ["code"], files_per_value=2, fmt="csv")
    return existing_keys(spark, path, ".csv")


@register(
    "avro_conform",
    """SELECT strftime(l_shipdate, '%Y-%m-%d') AS "Date", CAST(l_extendedprice AS FLOAT) AS "Open",
  CAST(l_quantity AS FLOAT) AS "High", CAST(l_discount AS FLOAT) AS "Low", CAST(l_tax AS FLOAT) AS "Close",
  CAST(NULL AS FLOAT) AS "Volume", CAST(NULL AS FLOAT) AS "Change", l_returnflag AS name,
  CASE WHEN length(CAST(l_suppkey AS VARCHAR)) < 6 THEN lpad(CAST(l_suppkey AS VARCHAR), 6, '0')
       ELSE CAST(l_suppkey AS VARCHAR) END AS code
FROM lineitem""",
)
def avro_conform(spark, sf_dir):
    """P8 (+ K3 when the Avro module is present): frame -> declared Avro record
    (Date as text, prices float32 nullable, absent fields NULL, extras dropped)."""
    li = read_table(spark, sf_dir, "lineitem")
    hist = li.select(
        F.col("l_shipdate").alias("Date"),
        F.col("l_extendedprice").alias("Open"),
        F.col("l_quantity").alias("High"),
        F.col("l_discount").alias("Low"),
        F.col("l_tax").alias("Close"),
        F.col("l_returnflag").alias("name"),
        zfill("l_suppkey").alias("code"),
        "l_orderkey",  # not in the record: dropped
    )
    return conform(hist, AVRO_HISTORY)


# ----------------------------------------------------------------- typed loads / manifests


def price_text(price: str, digit: str | None = None):
    """Price as landed text built from integer cents (exact in every engine),
    optionally with one more decimal digit taken from ``digit``."""
    cents = F.round(F.col(price) * 100).cast("bigint")
    parts = [
        F.expr(f"CAST(ROUND({price} * 100) AS BIGINT) div 100").cast("string"), F.lit("."),
        F.lpad((cents % 100).cast("string"), 2, "0"),
    ]
    if digit is not None:
        parts.append((F.col(digit) % 10).cast("string"))
    return F.concat(*parts)


PRICE_TEXT_SQL = """CAST(CAST(round({p} * 100) AS BIGINT) // 100 AS VARCHAR) || '.'
    || lpad(CAST(CAST(round({p} * 100) AS BIGINT) % 100 AS VARCHAR), 2, '0')"""


TYPED_LOAD_SQL = """SELECT TRY_CAST(CASE WHEN l_returnflag = 'R' THEN 'not a date'
    ELSE strftime(l_shipdate, '%Y-%m-%d') END AS DATE) AS date,
  'S' || CAST(l_suppkey AS VARCHAR) AS name,
  CASE WHEN length(CAST(l_suppkey AS VARCHAR)) < 6 THEN lpad(CAST(l_suppkey AS VARCHAR), 6, '0')
       ELSE CAST(l_suppkey AS VARCHAR) END AS code,
  TRY_CAST(CAST(CAST(round(l_extendedprice * 100) AS BIGINT) // 100 AS VARCHAR) || '.'
    || lpad(CAST(CAST(round(l_extendedprice * 100) AS BIGINT) % 100 AS VARCHAR), 2, '0')
    || CAST(l_linenumber % 10 AS VARCHAR) AS DECIMAL(8,2)) AS open_value
FROM lineitem"""


@register("typed_load", TYPED_LOAD_SQL)
def typed_load(spark, sf_dir):
    """S3 + S4 + P5 (X3, X4): landed all-text history CSV (with an unnamed index
    column and a 3-decimal price) -> date, name, code, DECIMAL(8,2) HALF_UP;
    unparsable dates become NULL."""
    li = read_table(spark, sf_dir, "lineitem")
    text = li.select(
        F.col("l_orderkey").cast("string").alias(""),
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("Name"),
        zfill("l_suppkey").alias("Code"),
        F.when(F.col("l_returnflag") == "R", F.lit("not a date"))
        .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("Date"),
        price_text("l_extendedprice", "l_linenumber").alias("OpenValue"),
    )
    path = scratch_path(spark, "history_text")
    write_csv(text, path)
    landed = drop_row_index(read_csv(spark, path))  # every column text, nothing inferred
    return typed_history(landed)


HISTORY_COLS = ["code", "date", "price", "row_key"]
HISTORY_SCHEMA = "code bigint, date date, price double, row_key bigint"


@register(
    "manifest_load",
    f"""SELECT o_custkey AS code, CAST(o_orderdate AS DATE) AS date, o_totalprice AS price, o_orderkey AS row_key
FROM orders o WHERE NOT EXISTS (
  SELECT 1 FROM orders e WHERE e.o_custkey = o.o_custkey AND e.o_orderdate < DATE '{CUTOFF}')""",
)
def manifest_load(spark, sf_dir):
    """S10 + K14 + E4: backfilled codes are listed in a manifest; the loader loads
    exactly those codes, then deletes the manifest *after* the commit. The
    load skips codes already in the table, so a crash between load and delete
    followed by a rerun adds nothing twice; a second run finds no manifest."""
    stored = price_history(spark, sf_dir).where(F.col("date") < F.lit(CUTOFF).cast("date"))
    _, new = split_known(companies(spark, sf_dir).select("code"), stored)
    mpath = scratch_path(spark, "manifest")
    write_csv(new.select(F.col("code").cast("string").alias("code")), mpath)

    root = scratch_path(spark, "tables")
    name = _table_name("history")
    schema = StructType.fromDDL(HISTORY_SCHEMA)
    create_if_absent(spark, name, schema, root)
    history = price_history(spark, sf_dir).select(*HISTORY_COLS)
    load_listed_codes(spark, mpath, history, name, delete_manifest=False)  # "crash" before the delete
    load_listed_codes(spark, mpath, history, name)  # rerun: nothing twice, manifest deleted
    if load_listed_codes(spark, mpath, history, name):  # no manifest: nothing to do
        raise RuntimeError("manifest still present after a completed load")
    return spark.table(name)


# ----------------------------------------------------------------- catalog tables


@register(
    "snapshot_with_date",
    f"""SELECT DATE '2024-01-02' AS date, name, CAST(code AS VARCHAR) AS code FROM (
  SELECT {RANK_SQL} AS ranking, c_custkey AS code, c_name AS name FROM customer) t WHERE ranking <= 100""",
)
def snapshot_with_date(spark, sf_dir):
    """P6 + K10: the day's top-100 list stamped with the run date, replace-loaded."""
    top = ranked_companies(spark, sf_dir).select("name", F.col("code").cast("string").alias("code"))
    snap = with_run_date(top, "2024-01-02")
    root, name = scratch_path(spark, "tables"), _table_name("top100")
    truncate_reload(snap, name, root)
    return truncate_reload(snap, name, root)  # rerun of the same day: same table


@register("truncate_reload", "SELECT * FROM supplier")
def truncate_reload_q(spark, sf_dir):
    """K7: loading twice equals loading once (no doubled rows)."""
    s = read_table(spark, sf_dir, "supplier")
    root, name = scratch_path(spark, "tables"), _table_name("supplier")
    truncate_reload(s, name, root)
    return truncate_reload(s, name, root)


@register("atomic_replace", "SELECT * FROM part")
def atomic_replace(spark, sf_dir):
    """K8: v1 -> v2 succeeds; a v3 of other rows whose writer fails midway must raise and leaves v2 readable."""
    p = read_table(spark, sf_dir, "part")
    root, name = scratch_path(spark, "tables"), _table_name("part")
    replace_table(p.where(F.col("p_size") <= 25), name, root)
    replace_table(p, name, root)
    failing = p.withColumn(
        "p_name", F.when(F.col("p_size") == 1, F.raise_error(F.lit("simulated writer failure")))
        .otherwise(F.concat(F.lit("v3 "), F.col("p_name"))))
    try:
        replace_table(failing, name, root)
    except Exception as e:
        if "simulated writer failure" in str(e):
            return spark.table(name)
        raise
    raise RuntimeError("a version whose writer failed was published")


@register("create_if_absent", "SELECT * FROM customer")
def create_if_absent_q(spark, sf_dir):
    """K9 + K10: create with the declared DDL (second call is a no-op), then append."""
    c = read_table(spark, sf_dir, "customer")
    root, name = scratch_path(spark, "tables"), _table_name("customer")
    create_if_absent(spark, name, c.schema, root)
    create_if_absent(spark, name, c.schema, root)
    return append_rows(c, name)


@register("empty_guard", "SELECT * FROM customer")
def empty_guard(spark, sf_dir):
    """an empty input does not replace (empty) the table."""
    c = read_table(spark, sf_dir, "customer")
    root, name = scratch_path(spark, "tables"), _table_name("customer")
    replace_table(c, name, root)
    return guarded_replace(c.where(F.lit(False)), name, root)


# ----------------------------------------------------------------- replication


LIST_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
               "pages", "benchmark", "labels", "conversations"]


@register(
    "list_tables",
    "\nUNION ALL\n".join(f"SELECT '{t}' AS tablename, COUNT(*) AS n_rows FROM {t}" for t in LIST_TABLES),
)
def list_tables_q(spark, sf_dir):
    """Tables of one catalog database (external tables over the data files), with row counts."""
    db = _table_name("lake")
    spark.sql(f"CREATE DATABASE {db} LOCATION '{scratch_path(spark, 'db')}'")
    for t in LIST_TABLES:
        spark.catalog.createTable(f"{db}.{t}", path=f"{sf_dir.rstrip('/')}/{t}.parquet", source="parquet")
    names = [r["tablename"] for r in list_tables(spark, db).collect()]  # catalog metadata only
    return table_row_counts(spark, sorted(names), db)


@register("table_copy", "SELECT * FROM customer")
def table_copy(spark, sf_dir):
    """S8 + K6 + K12 (E8): table -> gzip CSV export -> reloaded twice into a JDBC
    database with truncate (idempotent) -> partitioned JDBC read.

    The database here is embedded Derby inside this JVM (tests only); on a
    cluster ``url`` names a database server reachable from every executor.
    """
    c = read_table(spark, sf_dir, "customer")
    export = scratch_path(spark, "export")
    write_gzip_csv(c, export)
    staged = read_csv(spark, export, schema=c.schema)
    url = f"jdbc:derby:{_local_path(scratch_path(spark, 'derby'))};create=true"
    props = {"driver": DERBY_DRIVER}
    reload_jdbc(staged, url, "APP.CUSTOMER_COPY", props)
    reload_jdbc(staged, url, "APP.CUSTOMER_COPY", props)
    bounds = c.agg(F.min("c_custkey"), F.max("c_custkey")).first()
    back = read_jdbc(spark, url, "APP.CUSTOMER_COPY", props, "c_custkey", int(bounds[0]), int(bounds[1]) + 1, 4)
    actual = {col.lower(): col for col in back.columns}  # whatever case the database reports
    return back.select(*[F.col(f"`{actual[f.name.lower()]}`").cast(f.dataType).alias(f.name)
                         for f in c.schema.fields])
