"""Jobs on a ``HistoryStore``: refresh (E3), retention on two stores (E7), volatility day by day.

None of them reads the stored rows to find out what is new or what is to go: the
store's index of last days tells it.
"""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from itertools import islice

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketlake.functions.scalars import unescape_path_name
from marketlake.operators.common import filter_by_keys, join_materialized, materialize_per_key
from marketlake.operators.volatility import DEFAULT_THRESHOLD_PCT
from marketlake.session import cut_lineage
from marketlake.sinks.files import NULL_DIR, write_manifest
from marketlake.sinks.history_store import Added, HistoryStore
from marketlake.sources.files import child_names, delete_path, path_exists, read_manifest

DELETERS = 16  # objects deleted at once


def refresh_store_job(listing: DataFrame, prices: DataFrame, store: HistoryStore, manifest_path: str, start: str | None = None) -> Added:
    """The listed codes' new days -> store, the new codes -> manifest.

    ``listing``: code, name (a code of several names keeps the smallest). ``prices``: code, date and the store's other
    columns. Known codes get the days after their last one, new codes all [from ``start`` on].
    If every listed code is known, the scan of the prices starts at the earliest of their last days.
    The manifest is written first, with what an earlier one still lists: a crash in between leaves the codes
    new for the next run. Rerunning with the same inputs stores nothing.
    """
    spark = listing.sparkSession
    key, date = store.key, store.date
    top, rows = materialize_per_key(listing.where(F.col(key).isNotNull()).groupBy(key).agg(F.min("name").alias("name")))
    last = store.index().select(key, "last")
    known = top.join(last, key, "left")
    floor = known.agg(F.min("last").alias("floor"), F.count_if(F.col("last").isNull()).alias("new")).first()
    listed = known.where(F.col("last").isNull()).select(F.col(key).cast("string").alias("code"))
    pending = read_manifest(spark, manifest_path)
    if pending is not None:
        listed = listed.unionByName(pending.select("code")).distinct()
    write_manifest(cut_lineage(listed), manifest_path)
    wanted = filter_by_keys(prices, top.select(key), key)
    if start is not None:
        wanted = wanted.where(F.col(date) >= F.lit(start).cast("date"))
    if floor["new"] == 0 and floor["floor"] is not None:
        wanted = wanted.where(F.col(date) > F.lit(floor["floor"]))
    return store.add(join_materialized(wanted, top, rows, key, "inner"))


# ---------------------------------------------------------------- retention


def object_codes(spark: SparkSession, path: str, key: str = "code") -> DataFrame:
    """The codes that have a ``<key>=...`` folder under ``path``: code, folder (its escaped name)."""
    names = [n for n in child_names(spark, path) if n.startswith(f"{key}=") and n != f"{key}={NULL_DIR}"]
    folders = spark.createDataFrame([(n,) for n in names], "folder string")
    return folders.select(unescape_path_name(F.substring("folder", len(key) + 2, 1_000_000)).alias(key), "folder")


def _batches(rows: Iterator, size: int) -> Iterator[list]:
    while batch := list(islice(rows, size)):
        yield batch


def apply_intent(spark: SparkSession, intent: str, store: HistoryStore, objects: str) -> None:
    """Delete an intent's codes from both stores, then the intent. Any part may have been done before."""
    key = store.key
    codes = spark.read.parquet(intent)
    store.delete(codes)
    folders = object_codes(spark, objects, key).join(codes, key, "left_semi").select("folder")
    with ThreadPoolExecutor(max_workers=DELETERS) as pool:
        for batch in _batches(folders.toLocalIterator(), 1000):  # names of folders, a thousand at a time
            list(pool.map(lambda r: delete_path(spark, f"{objects.rstrip('/')}/{r['folder']}"), batch))
    delete_path(spark, intent)


def retention_stores_job(store: HistoryStore, objects: str, keep: DataFrame, intents: str) -> list[str]:
    """Codes that are no longer listed go from the store (rows) and from ``objects`` (one folder per code).

    What is to go is written down first, under ``intents``: every code of the store's index
    and of the objects' folders that ``keep`` lacks. The list is applied to the rows in one commit that touches only
    the buckets concerned, then to the objects, then it is removed. A run that
    finds a list that was not removed applies it before anything else, so both stores lose the same codes whatever
    was interrupted. An empty ``keep`` is taken for a failed listing: nothing new goes. Returns the intents applied.
    """
    spark, key = store.spark, store.key
    done = []
    for name in child_names(spark, intents):
        if path_exists(spark, f"{intents}/{name}/_SUCCESS"):
            apply_intent(spark, f"{intents}/{name}", store, objects)
            done.append(name)
        else:
            delete_path(spark, f"{intents}/{name}")  # its writing was interrupted, nothing was deleted by it
    if keep.isEmpty():
        return done
    held = store.index().select(F.col(key).cast("string").alias(key)).unionByName(object_codes(spark, objects, key).select(key)).distinct()
    leaving = held.join(keep.select(F.col(key).cast("string").alias(key)).where(F.col(key).isNotNull()).distinct(), key, "left_anti")
    name = f"gone-{store.version():012d}-{len(done)}"
    intent = f"{intents}/{name}"
    leaving.write.parquet(intent)
    if spark.read.schema(leaving.schema).parquet(intent).isEmpty():
        delete_path(spark, intent)
        return done
    apply_intent(spark, intent, store, objects)
    return [*done, name]


# ---------------------------------------------------------------- volatility


def extend_changes(store: HistoryStore, days: DataFrame) -> Added:
    """Store the new days of each code with prev_price and change, reading no stored row.

    ``days``: code, date, price, one row per code and day (``daily_first_price``). ``store`` has the columns code, date,
    price, prev_price, change and carries ``price``: its index holds each code's last day and
    price, the boundary that a code's first new day is held against. Days up to the boundary are settled and
    left out, so day-by-day runs and one run over all days store the same rows.
    """
    last = store.index().select("code", F.col("last").alias("__last"), F.col("price").alias("__price"))
    new = join_materialized(days, last, last.count(), "code", "left")
    new = new.where(F.col("__last").isNull() | (F.col("date") > F.col("__last")))
    before = F.lag("price").over(Window.partitionBy("code").orderBy("date"))
    new = new.withColumn("prev_price", F.coalesce(before, "__price")).drop("__last", "__price")
    change = (F.try_divide(F.col("price"), F.col("prev_price")) - F.lit(1.0)) * F.lit(100.0)
    return store.add(new.withColumn("change", change), newer_only=False)


def volatile_days(store: HistoryStore, threshold_pct: float = DEFAULT_THRESHOLD_PCT) -> DataFrame:
    """Stored days whose absolute change is at least ``threshold_pct`` percent."""
    change = F.col("change")
    return store.read().where(F.col("prev_price").isNotNull() & ~F.isnan(change) & ((change >= float(threshold_pct)) | (change <= -float(threshold_pct))))
