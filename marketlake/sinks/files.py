"""File sinks: CSV (plain / gzip), Parquet, ORC, Avro, partitioned and per-key layouts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.functions.scalars import unescape_path_name

CSV_WRITE_OPTIONS = {"escape": '"'}


NULL_DIR = "__HIVE_DEFAULT_PARTITION__"


def write_csv(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    header: bool = True,
    compression: str | None = None,
    sort_by: Sequence[str] | None = None,
    **options,
) -> None:
    """K1 / K6: CSV with a header, no index column; fields quoted only when needed,
    quotes doubled (RFC 4180, what pandas and warehouse COPY expect); NULL is
    an unquoted empty field, the empty string is "".

    ``sort_by`` orders the output across part files (a range shuffle) for
    consumers that expect the pandas sorted-index layout. No BOM is written.
    """
    if sort_by:
        df = df.orderBy(*sort_by)
    w = df.write.mode(mode).option("header", header).options(**CSV_WRITE_OPTIONS)
    if compression:
        w = w.option("compression", compression)
    for k, v in options.items():
        w = w.option(k, v)
    w.csv(path)


def write_gzip_csv(df: DataFrame, path: str, mode: str = "overwrite", **options) -> None:
    """K6: gzip CSV export with header (not splittable on read: keep parts moderate)."""
    write_csv(df, path, mode=mode, compression="gzip", **options)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] | None = None) -> None:
    """K5."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_orc(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] | None = None) -> None:
    """K4."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.orc(path)


def avro_available(spark: SparkSession) -> bool:
    """Whether the spark-avro module is on the classpath.

    Resolves the ``avro`` format against a path that does not exist: a missing
    module fails with "Failed to find data source", a present one with a
    path error.
    """
    import uuid

    try:
        spark.read.format("avro").load(f"/nonexistent-{uuid.uuid4().hex}")
    except Exception as e:  # noqa: BLE001
        text = str(e)
        return not ("Failed to find data source" in text or "DATA_SOURCE_NOT_FOUND" in text)
    return True


def write_avro(df: DataFrame, path: str, avro_schema: str | None = None, mode: str = "overwrite") -> None:
    """K3: Avro with a declared record schema (conform the frame first, see ``conform``)."""
    if not avro_available(df.sparkSession):
        raise RuntimeError(
            "Avro sink unavailable: add the spark-avro module matching this Spark version "
            "(spark.jars.packages=org.apache.spark:spark-avro_2.13:<version>) to the session."
        )
    w = df.write.format("avro").mode(mode)
    if avro_schema:
        w = w.option("avroSchema", avro_schema)
    w.save(path)


def write_partitioned(
    df: DataFrame,
    path: str,
    by: Sequence[str],
    files_per_value: int = 4,
    fmt: str = "parquet",
    mode: str = "overwrite",
    max_records_per_file: int | None = None,
    dynamic: bool = False,
) -> None:
    """K2: Hive-style ``by=value/`` layout without small-file or hot-value blow-ups.

    With AQE on, rows are rebalanced on the partition columns: AQE coalesces
    small shuffle partitions and splits a skewed one (a value holding a third
    of the data) into advisory-size pieces written by many tasks, so files
    come out near ``spark.sql.adaptive.advisoryPartitionSizeInBytes``
    whatever the skew. Without AQE, rows are hash-distributed on (values, a
    row-hash salt), so each value is written by at most ``files_per_value``
    tasks. ``dynamic=True`` replaces only the partitions present in ``df``.
    """
    aqe = df.sparkSession.conf.get("spark.sql.adaptive.enabled", "true").lower() == "true"
    if aqe:
        out = df.hint("rebalance", *by)
    else:
        salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(files_per_value))
        out = df.repartition(*[F.col(c) for c in by], salt)
    w = out.write.format(fmt).mode(mode).partitionBy(*by)
    if dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    if fmt == "csv":
        w = w.option("header", True).options(**CSV_WRITE_OPTIONS)
    w.save(path)


def write_per_key(df: DataFrame, path: str, key: str = "code", fmt: str = "csv", files_per_key: int = 4) -> None:
    """One directory per code, replaced as a whole; untouched codes survive.

    Dynamic partition overwrite: only the codes present in ``df`` are rewritten.
    A code with a large share of the rows is split over several writers (see
    ``write_partitioned``). Meant for bounded key sets
    (a top-N list); for unbounded keys partition by a coarser column and sort
    by the key inside files instead.
    """
    write_partitioned(df, path, [key], files_per_value=files_per_key, fmt=fmt, mode="overwrite", dynamic=True)


def write_manifest(codes: DataFrame, path: str, key: str = "code") -> bool:
    """Write the manifest of newly backfilled codes, only if there are any."""
    if codes.isEmpty():
        return False
    write_csv(codes.select(key).distinct(), path, mode="overwrite")
    return True


def upsert_per_key(
    spark: SparkSession,
    path: str,
    incoming: DataFrame,
    schema,
    key: str = "code",
    date: str = "date",
    fmt: str = "parquet",
    rewrite: bool = False,
) -> None:
    """K15 + U3: add incoming rows that are newer than each code's stored last
    day to the per-code layout under ``path``.

    Default: the new rows are appended as new files under each code's
    directory. Nothing stored is re-read or rewritten, the job commit makes
    the append all-or-nothing, and a rerun recomputes an empty increment.
    ``rewrite=True`` keeps one set of files per code instead (the
    replace-the-object behaviour): the touched codes' stored rows plus their
    new rows are checkpointed to the shared checkpoint directory, then those
    code directories alone are overwritten. ``compact_per_key`` does the same
    later for codes that accumulated many appended files.
    """
    from marketlake.operators.history import incremental_rows
    from marketlake.session import cut_lineage
    from marketlake.sources.files import path_exists

    cols = [f.name for f in schema.fields]
    exists = path_exists(spark, path)
    if exists:
        stored = spark.read.schema(schema).format(fmt).load(path).select(*cols)
    else:
        stored = spark.createDataFrame([], schema)
    # incoming rows take the declared types (a text CSV landing becomes typed)
    typed = incoming.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])
    delta = incremental_rows(stored, typed, key, date)
    if not rewrite:
        write_partitioned(delta, path, [key], fmt=fmt, mode="append")
        return
    touched = delta.select(key).distinct()
    replacement = stored.join(touched, key, "left_semi").unionByName(delta)
    if exists:  # the write replaces files this plan reads: materialise it first
        replacement = cut_lineage(replacement)
    if not replacement.isEmpty():
        write_per_key(replacement, path, key, fmt=fmt)


def compact_per_key(spark: SparkSession, path: str, schema, key: str = "code", fmt: str = "parquet",
                    min_files: int = 8) -> list[str]:
    """Rewrite the directories of codes that hold at least ``min_files`` files
    into a few files each. Only file names are listed on the driver; the rows
    are checkpointed before their directories are overwritten. Returns the
    compacted codes."""
    from marketlake.session import cut_lineage
    from marketlake.sources.files import list_objects

    suffix = {"parquet": ".parquet", "orc": ".orc", "csv": ".csv"}.get(fmt)
    files = list_objects(spark, path, None).select(
        unescape_path_name(F.regexp_extract("path", rf"/{key}=([^/]+)/[^/]*$", 1)).alias(key), "path").where(F.col(key) != "")
    if suffix:
        files = files.where(F.col("path").endswith(suffix))
    busy = [r[key] for r in files.groupBy(key).count().where(F.col("count") >= min_files).collect()]
    if not busy:
        return []
    cols = [f.name for f in schema.fields]
    rows = spark.read.schema(schema).format(fmt).load(path).select(*cols)
    rows = rows.where(F.col(key).cast("string").isin(busy))
    write_per_key(cut_lineage(rows), path, key, fmt=fmt)
    return sorted(busy)


def drop_key_dirs(spark: SparkSession, path: str, keep: DataFrame, key: str = "code") -> list[str]:
    """K13 on the per-key layout: delete the ``key=<code>`` directories of codes
    not in ``keep`` (the objects of codes that left the listing).

    Only directory names travel to the driver (a listing, like the object
    listing it replaces); the rows themselves are never read.
    """
    from marketlake.sources.files import delete_path, list_objects

    if keep.isEmpty():
        raise ValueError("the keep list is empty; nothing is deleted")
    # Directory names are escaped (``^`` is ``%5E``): compared decoded, deleted as they are. The
    # directory of NULL keys is not a code and stays.
    listing = list_objects(spark, path, None).select(
        F.regexp_extract("path", rf"/{key}=([^/]+)/[^/]*$", 1).alias("__dir")).where(
        ~F.col("__dir").isin("", NULL_DIR)).distinct().withColumn(key, unescape_path_name("__dir"))
    leaving = listing.join(keep.select(F.col(key).cast("string").alias(key)).distinct(), key, "left_anti")
    gone = []
    for row in leaving.select("__dir", key).toLocalIterator():
        delete_path(spark, f"{path.rstrip('/')}/{key}={row['__dir']}")
        gone.append(row[key])
    return sorted(gone)
