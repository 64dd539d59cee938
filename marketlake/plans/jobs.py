"""End-to-end jobs (what the scheduled runs compute), each one Spark plan per step.

E1 macro series -> wide table      E5 ranking publish
E2 yearly statements (composite)   E6 top-k volatility
E3 history refresh                 E7 retention
E4 manifest-driven history load    E8 schema replication
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.functions import int_code, parse_year, strip_quotes
from marketlake.operators.conform import typed_history
from marketlake.operators.common import filter_by_keys, join_materialized, materialize_per_key
from marketlake.operators.history import history_of, incremental_rows, retention_split, split_known
from marketlake.operators.ranking import EXCHANGE_CODES, attach_exchange, first_k_codes, rank_top, zip_lists
from marketlake.operators.reshape import filter_in, pivot_composite, pivot_first, union_all, union_first_wins
from marketlake.operators.volatility import DEFAULT_THRESHOLD_PCT, daily_first_price, high_volatility
from marketlake.sinks.files import write_csv, write_manifest, write_parquet
from marketlake.sinks.jdbc import publish_jdbc, replicate_tables
from marketlake.sinks.tables import append_rows, replace_table, truncate_reload
from marketlake.sources.files import delete_path, drop_row_index, list_objects, read_csv, read_manifest
from marketlake.session import cut_lineage
from marketlake.sources.warehouse import list_tables


def macro_wide_job(
    long: DataFrame,
    raw_path: str | None,
    processed_path: str,
    table: str,
    root: str,
    order: str | Sequence[str],
    items: Sequence[str] | None = None,
    columns: Mapping[str, str] | None = None,
    index: str = "TIME",
    key: str = "ITEM_NAME1",
    value: str = "DATA_VALUE",
) -> DataFrame:
    """Land raw (K2) -> [filter items (F1)] -> pivot-first (A3) -> [select +
    rename (P1/P3)] -> processed CSV sorted by TIME (K1) -> reload table (K7).

    ``columns`` maps item -> output name and fixes the output columns; without
    it the listed ``items`` become the columns, and without both the items found; then an item that
    vanishes stays a column of the table, all NULL. ``raw_path=None`` skips the
    landing (re-running from the raw zone itself: ``long`` already is it).
    """
    values = list(columns) if columns else (list(items) if items else None)

    def shape(raw: DataFrame) -> DataFrame:
        wide = pivot_first(filter_in(raw, key, items) if items else raw, index, key, value, order, values)
        return wide.select(index, *[F.col(f"`{k}`").alias(v) for k, v in columns.items()]) if columns else wide

    return series_job(long, shape, raw_path, processed_path, table, root, [index], evolve=values is None)


def series_job(long: DataFrame, shape: Callable[[DataFrame], DataFrame], raw_path: str | None, processed_path: str | None,
               table: str, root: str, sort_by: Sequence[str], evolve: bool = False) -> DataFrame:
    """E1 for any series: land raw (K2) -> ``shape`` -> processed CSV sorted by ``sort_by`` (K1) -> reload table (K7).

    Each step reads what the one before has written. Without a path a step is left out. ``evolve``: the
    columns come from the data; one that vanished stays in the table, all NULL.
    """
    spark = long.sparkSession
    if raw_path is not None:
        write_parquet(long, raw_path)
        long = spark.read.parquet(raw_path)
    wide = shape(long)
    if processed_path is not None:
        write_csv(wide, processed_path, sort_by=list(sort_by))
        wide = read_csv(spark, processed_path, schema=wide.schema, check_header=True)
    return truncate_reload(wide, table, root, evolve=evolve)


def statements_job(parts: Sequence, keys: Sequence[str], values: Sequence[Sequence[str]] | None,
                   order: str | Sequence[str], table: str, root: str, drop: Sequence[str] = ()) -> DataFrame:
    """Overlapping yearly parts (U2) -> year -> date (X1) -> composite pivot (A4) -> table.

    Without ``values`` the columns are the keys found; one that vanished stays, all NULL. ``parts`` are DataFrames (overlaps collapse in the pivot's "first"), or
    ``(df, condition)`` pairs, in which case overlaps are removed at the scans
    (first fetch wins). The reference only printed this result; here it is stored.
    """
    if parts and isinstance(parts[0], tuple):
        merged = union_first_wins(parts)
    else:
        merged = union_all(parts)
    stmts = merged.drop(*drop).withColumn("Date", parse_year("TIME"))
    wide = pivot_composite(stmts, "Date", keys, "DATA_VALUE", order, values)
    return truncate_reload(wide, table, root, evolve=values is None)


def history_refresh_job(
    listing: DataFrame,
    prices: DataFrame,
    history_table: str,
    manifest_path: str,
    start: str | None = None,
) -> DataFrame:
    """For the listed codes (``listing``: code, name — the day's top-N
    snapshot, de-duplicated like ``SELECT DISTINCT name, code``), split known /
    new codes against the stored history (J2), take every price row that is
    newer than the code's last stored day or belongs to a new code (S11/A5/F3;
    ``start`` bounds the backfill), attach the name (J6), append (U3/K15) and
    list the new codes in a manifest (K14).

    ``prices``: code, date, price, row_key. Rerunning with the same inputs
    appends nothing.
    """
    spark = listing.sparkSession
    # The listing is materialised and counted once; the name join broadcasts
    # it after that size check (or splits hot codes beyond the bound).
    # A code listed under several names keeps the smallest, so no price row is doubled.
    top, rows = materialize_per_key(listing.groupBy("code").agg(F.min("name").alias("name")))
    codes = top.select("code")
    # Only the listed codes' rows matter: a short list is a literal IN filter
    # on both scans (pruned code partitions, pushed-down Parquet filter).
    stored_top = filter_by_keys(spark.table(history_table).select("code", "date"), codes, "code")
    _, new = split_known(top, stored_top)
    candidates = join_materialized(filter_by_keys(prices, codes, "code"), top, rows, "code", "inner")
    if start is not None:
        candidates = candidates.where(F.col("date") >= F.lit(start).cast("date"))
    # The new codes and the increment are fixed before the append changes the stored history. The
    # manifest goes first: a crash in between leaves the codes new for the next run. Codes
    # of a manifest that was not loaded yet stay listed.
    rows = cut_lineage(incremental_rows(stored_top, candidates))
    listed = new.select(F.col("code").cast("string").alias("code"))
    pending = read_manifest(spark, manifest_path)
    if pending is not None:
        listed = listed.unionByName(pending.select("code")).distinct()
    write_manifest(cut_lineage(listed), manifest_path)
    if not rows.isEmpty():
        append_rows(rows, history_table)
    return spark.table(history_table)


def top_listing(companies: DataFrame, n: int = 100) -> DataFrame:
    """The top-``n`` listing (code, name) by ``metric`` (ties by code)."""
    return rank_top(companies, n, "metric", "code").select("code", "name")


def load_listed_codes(spark: SparkSession, manifest_path: str, history: DataFrame, table: str,
                      key: str = "code", delete_manifest: bool = True) -> bool:
    """S10 core: append to ``table`` the ``history`` rows of the codes listed in
    the manifest that the table does not hold yet, then delete the manifest
    (after the commit). A rerun after a crash between the two adds nothing
    twice; without a manifest there is nothing to do. Returns whether a
    manifest was found.
    """
    manifest = read_manifest(spark, manifest_path, key)
    if manifest is None:
        return False
    codes = manifest.select(F.col(key).cast(history.schema[key].dataType).alias(key)).distinct()
    present = spark.table(table).select(key).distinct()
    wanted = codes.join(present, key, "left_anti")  # listed and not loaded yet
    rows = filter_by_keys(history, wanted, key)
    if not rows.isEmpty():  # F5
        append_rows(rows, table)
    if delete_manifest:
        delete_path(spark, manifest_path)
    return True


def manifest_load_job(spark: SparkSession, manifest_path: str, history_csv_dir: str, table: str) -> DataFrame:
    """The landed all-text history (S3) typed (P5), loaded for the manifest's
    codes only (S10, F5, append)."""
    typed = typed_history(drop_row_index(read_csv(spark, history_csv_dir)))
    load_listed_codes(spark, manifest_path, typed, table)
    return spark.table(table)


#: Fixed text widths of the warehouse's history table: databases join and compare these, not large objects.
WAREHOUSE_TYPES = "name VARCHAR(256), code VARCHAR(64)"


def manifest_load_id(spark: SparkSession, manifest_path: str) -> str:
    """The name of the load that a manifest asks for: the same for a rerun, another once it is written anew."""
    files = list_objects(spark, manifest_path).select(F.concat_ws("|", "path", "length", F.col("modificationTime").cast("double").cast("string")).alias("f"))
    return files.agg(F.sha2(F.concat_ws(",", F.array_sort(F.collect_list("f"))), 256)).first()[0]  # a manifest has a few files


def manifest_jdbc_load_job(
    spark: SparkSession,
    manifest_path: str,
    history_csv_dir: str,
    url: str,
    table: str,
    properties: Mapping[str, str],
    delete_manifest: bool = True,
) -> bool:
    """E4 into a warehouse: manifest codes -> all-text history (S3) -> typed
    date / name / code / DECIMAL(8,2) (P5) -> staged JDBC publish (K11).

    All listed codes' histories appear in one transaction, in place of whatever an
    interrupted load left of these codes. The manifest's load is on record from then on: a
    crash before the manifest is deleted adds nothing twice. The target is created with the typed
    schema if absent. Returns whether a manifest was found.
    """
    manifest = read_manifest(spark, manifest_path)
    if manifest is None:
        return False
    typed = typed_history(drop_row_index(read_csv(spark, history_csv_dir)))
    publish_jdbc(filter_by_keys(typed, manifest, "code"), url, table, manifest_load_id(spark, manifest_path), properties,
                 replace_key="code", column_types=WAREHOUSE_TYPES)
    if delete_manifest:
        delete_path(spark, manifest_path)
    return True


def rank_publish_job(
    page: DataFrame,
    metadata: DataFrame,
    csv_path: str,
    table: str,
    root: str,
    mapping: Mapping[str, str] = EXCHANGE_CODES,
    names_col: str = "names",
    codes_col: str = "codes",
) -> DataFrame:
    """E5: parallel lists (J5) -> names without quotes (X9) -> exchange code via
    metadata + map, 'baddata' otherwise (J4) -> ranking = position (W1) -> CSV
    (K1) -> transactional replace (K8; an empty or failed result keeps the old table)."""
    rows = zip_lists(page, names_col, codes_col, ("name", "code"), "pos")
    return rank_publish_rows(rows, metadata, csv_path, table, root, mapping)


def rank_publish_rows(rows: DataFrame, metadata: DataFrame, csv_path: str, table: str, root: str,
                      mapping: Mapping[str, str] = EXCHANGE_CODES, pos_col: str = "pos") -> DataFrame:
    """E5 from a listing that already has one row per company (pos, name, code)."""
    rows = rows.withColumn("name", strip_quotes("name"))
    rows = attach_exchange(rows, metadata, "code", "exchange", mapping)
    ranked = rows.select(F.col(pos_col).cast("int").alias("ranking"), "name", "code", "excode")
    write_csv(ranked, csv_path, sort_by=["ranking"])
    return replace_table(ranked, table, root, verify=lambda staged: not staged.isEmpty())


def top_volatility_job(
    ranked: DataFrame,
    history: DataFrame,
    table: str,
    root: str,
    k: int = 3,
    threshold_pct: float = DEFAULT_THRESHOLD_PCT,
    order: Sequence[str] = ("row_key",),
    code_width: int | None = 6,
) -> DataFrame:
    """First ``k`` ranked codes (L1) -> their history (J1, a literal IN
    filter on the k codes: pruned code partitions / pushed-down Parquet
    filter) -> zero-padded code text (X8) -> one price per day ->
    high-volatility rows (W3) -> reload (K7).

    ``ranked``: ranking, code. ``history``: code, date, price + ``order`` columns.
    ``code_width=None`` leaves codes untouched (ticker symbols).
    """
    top = first_k_codes(ranked, k).select("code")
    mine = history_of(history, top, k)
    if code_width is not None:  # numeric KR codes -> 6-digit text; tickers stay as they are
        mine = mine.withColumn("code", int_code("code", code_width))
    series = daily_first_price(mine, "code", "date", "price", list(order))
    return truncate_reload(high_volatility(series, threshold_pct), table, root)


def retention_job(history_table: str, keep: DataFrame, root: str, key: str = "code") -> DataFrame:
    """Delete the history of codes that are no longer listed (J3 -> K13).

    The survivors are published as the table's new version in one pass: the
    history is semi-joined with the (bounded, broadcast) list of listed codes.
    An empty list is taken for a failed listing: the history stays as it is.
    """
    spark = keep.sparkSession
    if keep.isEmpty():
        return spark.table(history_table)
    survivors, _ = retention_split(spark.table(history_table), keep, key)
    return replace_table(survivors, history_table, root)


def replicate_schema_job(spark: SparkSession, database: str, url: str, properties: Mapping[str, str],
                         target_prefix: str = "", max_parallel: int = 4, staging_dir: str | None = None) -> list[str]:
    """Every table of ``database`` (S9) -> [gzip CSV staging (K6)] -> JDBC
    target, truncate + reload (K12)."""
    names = [r["tablename"] for r in list_tables(spark, database).collect()]  # catalog metadata
    sources = {n: spark.table(f"`{database}`.`{n}`") for n in names}
    return replicate_tables(sources, url, properties, target_prefix, max_parallel, staging_dir)
