"""Catalog tables with idempotent, all-or-nothing loads on plain Parquet.

A table is an external catalog table whose location points at one committed
version directory. A load writes a *new* version directory (Spark's commit
protocol makes it appear only when the whole job succeeded), verifies it,
then repoints the table with one catalog update (``ALTER TABLE ... SET
LOCATION``). Readers see the old or the new version, never a half-written
or doubled one; a failed load leaves the old version in place; re-running a
load gives the same table. The old directory is never overwritten while it
may still be read.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def table_location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where(F.col("col_name") == "Location").collect()
    return rows[0]["data_type"]


def _version_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name.replace('.', '/')}/v-{int(time.time() * 1000)}-{uuid.uuid4().hex[:8]}"


def create_if_absent(spark: SparkSession, name: str, schema: StructType, root: str, fmt: str = "parquet") -> DataFrame:
    """K9: ``CREATE TABLE IF NOT EXISTS`` with a declared schema (no-op when present)."""
    if not table_exists(spark, name):
        loc = _version_path(root, name)
        spark.createDataFrame([], schema).write.format(fmt).mode("errorifexists").save(loc)
        spark.catalog.createTable(name, path=loc, source=fmt, schema=schema)
    return spark.table(name)


def align_to(df: DataFrame, target: StructType, by_position: bool = False) -> DataFrame:
    """Shape ``df`` like the target table.

    By name (default): target columns in target order, cast to target types,
    extra columns dropped, a missing column is an error. By position (the
    warehouse COPY behaviour): the column counts must match.
    """
    if by_position:
        if len(df.columns) != len(target.fields):
            raise ValueError(f"{len(df.columns)} columns for a {len(target.fields)}-column table")
        df = df.toDF(*[f.name for f in target.fields])
    missing = [f.name for f in target.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing for the target table: {missing}")
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in target.fields])


def add_new_columns(df: DataFrame, name: str) -> None:
    """Columns of ``df`` that the table lacks are added to it (a reload never drops a column of its input)."""
    spark = df.sparkSession
    known = {c.lower() for c in spark.table(name).columns}
    new = [f for f in df.schema.fields if f.name.lower() not in known]
    if new:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in new)})")


def with_table_columns(df: DataFrame, name: str) -> DataFrame:
    """``df`` with a NULL column for every column of the table that it lacks (an item that vanished)."""
    known = {c.lower() for c in df.columns}
    gone = [f for f in df.sparkSession.table(name).schema.fields if f.name.lower() not in known]
    return df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in gone])


def replace_table(
    df: DataFrame,
    name: str,
    root: str,
    fmt: str = "parquet",
    verify: Callable[[DataFrame], bool] | None = None,
) -> DataFrame:
    """K7 / K8: all-or-nothing replace of a table's contents.

    Raises (and leaves the current version untouched) when the write fails or
    ``verify(staged)`` returns False. Tables replaced this way are
    unpartitioned: a partitioned catalog table keeps one location per
    partition, which a single location swap cannot move atomically (use
    ``sinks.files.write_partitioned`` with dynamic overwrite for those).
    """
    staged, loc = _stage(df, name, root, fmt)
    if verify is not None and not verify(staged):
        raise RuntimeError(f"verification of the new version of {name} failed; {name} unchanged")
    return _publish(staged, name, loc, fmt)


def _stage(df: DataFrame, name: str, root: str, fmt: str) -> tuple[DataFrame, str]:
    """A new version of ``name``, written but not published, and its path."""
    spark = df.sparkSession
    if table_exists(spark, name):
        new = [f for f in df.schema.fields if f.name.lower() not in {c.lower() for c in spark.table(name).columns}]
        df = align_to(df, StructType([*spark.table(name).schema.fields, *new]))
    loc = _version_path(root, name)
    df.write.format(fmt).mode("errorifexists").save(loc)
    return spark.read.schema(df.schema).format(fmt).load(loc), loc


def _publish(staged: DataFrame, name: str, loc: str, fmt: str) -> DataFrame:
    """Point the table at its new version, in one catalog update."""
    spark = staged.sparkSession
    if table_exists(spark, name):
        add_new_columns(staged, name)
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{loc}'")
        spark.sql(f"REFRESH TABLE {name}")
    else:
        spark.catalog.createTable(name, path=loc, source=fmt)
    return spark.table(name)


def truncate_reload(df: DataFrame, name: str, root: str, by_position: bool = False, fmt: str = "parquet",
                    evolve: bool = False) -> DataFrame:
    """K7: replace the table with ``df`` (idempotent: loading twice = once; errors raise).

    A column that the table lacks is added to it. A column of the table that ``df``
    lacks raises, or with ``evolve`` (pivots whose columns come from the data) becomes NULL.
    """
    spark = df.sparkSession
    if table_exists(spark, name):
        if by_position:
            df = align_to(df, spark.table(name).schema, by_position)
        elif evolve:
            df = with_table_columns(df, name)
    return replace_table(df, name, root, fmt)


def guarded_replace(df: DataFrame, name: str, root: str, fmt: str = "parquet") -> DataFrame:
    """F5 + K7: an empty input keeps the current table instead of emptying it.

    The input is evaluated once, by the write; whether it had rows is read from the
    written version, which is deleted if it had none.
    """
    from marketlake.sources.files import delete_path

    spark = df.sparkSession
    if not table_exists(spark, name):
        return replace_table(df, name, root, fmt)
    staged, loc = _stage(df, name, root, fmt)
    if staged.isEmpty():
        delete_path(spark, loc)
        return spark.table(name)
    return _publish(staged, name, loc, fmt)


def append_rows(df: DataFrame, name: str) -> DataFrame:
    """K10 (append form): set-based INSERT of all rows, aligned by name."""
    spark = df.sparkSession
    align_to(df, spark.table(name).schema).write.insertInto(name)
    return spark.table(name)


def with_run_date(df: DataFrame, as_of, col: str = "date") -> DataFrame:
    """Constant run-date column in front (an explicit date, never ``current_date()``)."""
    return df.select(F.lit(as_of).cast("date").alias(col), *[c for c in df.columns if c != col])


def delete_keys(name: str, keys: DataFrame, root: str, key: str = "code", spark: SparkSession | None = None) -> DataFrame:
    """Remove every row whose ``key`` is in ``keys`` by publishing the survivors
    as a new version (plain Parquet has no DELETE)."""
    from marketlake.operators.common import join_per_key

    spark = spark or keys.sparkSession
    current = spark.table(name)
    survivors = join_per_key(current, keys.select(key).distinct(), key, "left_anti")
    return replace_table(survivors, name, root)


def vacuum_versions(spark: SparkSession, name: str, root: str, keep_previous: int = 1) -> list[str]:
    """Delete old version directories of ``name``.

    Keeps the current version and the ``keep_previous`` newest older ones
    (readers that planned against them may still be scanning); versions newer
    than the current one (unpublished loads) are never touched. Only directory
    names are listed on the driver. Returns the deleted paths.
    """
    from marketlake.sources.files import delete_path

    current = table_location(spark, name).rstrip("/")
    base = f"{root.rstrip('/')}/{name.replace('.', '/')}"
    jvm = spark._jvm
    base_path = jvm.org.apache.hadoop.fs.Path(base)
    fs = base_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(base_path):
        return []
    def stamp(p: str) -> int:
        return int(p.rstrip("/").rsplit("/v-", 1)[1].split("-")[0])

    versions = sorted(
        (st.getPath().toString() for st in fs.listStatus(base_path)
         if st.isDirectory() and st.getPath().getName().startswith("v-")),
        key=stamp,
    )
    now = stamp(current)
    # Only versions older than the current one; a newer one is a load that has
    # not been published (yet, or ever) and is left alone.
    older = [v for v in versions if stamp(v) < now]
    doomed = older[:-keep_previous] if keep_previous > 0 else older
    for v in doomed:
        delete_path(spark, v)
    return doomed
