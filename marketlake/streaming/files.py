"""Run-once streaming ingestion of landed files.

The reference keeps its own list of known files and a manifest to load each
new history file once. Structured Streaming's file source does this with a
checkpoint: every run (``trigger(availableNow=True)``) processes exactly the
files that arrived since the last run and then stops, so it can be scheduled
like a batch job. Never a query that keeps running.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marketlake.operators.common import filter_by_keys, join_per_key
from marketlake.operators.history import incremental_rows, latest_date
from marketlake.session import cut_lineage
from marketlake.sources.files import CSV_READ_OPTIONS, delete_path, path_exists
from marketlake.sinks.tables import append_rows


def file_stream(spark: SparkSession, source_dir: str, schema: StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = None, clean_source: str | None = None,
                archive_dir: str | None = None, **options) -> DataFrame:
    """Streaming scan of every file under ``source_dir`` (any depth) with an explicit schema.

    ``max_files_per_trigger`` bounds each micro-batch (a backlog is worked off
    in several batches). ``clean_source="archive"`` (with ``archive_dir``) or
    ``"delete"`` moves processed files out of the landing directory, so its
    listing stays small however long the job runs.
    """
    reader = spark.readStream.schema(schema).format(fmt).option("recursiveFileLookup", "true")
    if fmt == "csv":
        reader = reader.option("header", True).options(**CSV_READ_OPTIONS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if clean_source:
        reader = reader.option("cleanSource", clean_source)
        if archive_dir:
            reader = reader.option("sourceArchiveDir", archive_dir)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(source_dir)


def ingest_new_files(
    spark: SparkSession,
    source_dir: str,
    schema: StructType,
    sink_dir: str,
    checkpoint_dir: str,
    fmt: str = "parquet",
    sink_fmt: str = "parquet",
    partition_by: Sequence[str] | None = None,
    **source_options,
) -> None:
    """Copy every not-yet-seen file of ``source_dir`` into ``sink_dir``, once.

    The file sink's commit log makes the output exactly-once: rerunning after
    a failure neither loses nor duplicates a file's rows.
    """
    w = (
        file_stream(spark, source_dir, schema, fmt, **source_options)
        .writeStream.format(sink_fmt)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
    )
    if partition_by:
        w = w.partitionBy(*partition_by)
    q = w.start(sink_dir)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def upsert_batch(batch: DataFrame, table: str, key: str = "code", date: str = "date", last: DataFrame | None = None) -> bool:
    """Append the rows of ``batch`` that are newer than the last day of their code and not stored yet.

    ``last`` (key, __last): the last days from before the run, so that the batches of one run do not
    shut each other's rows out; without it, ``table``'s own. Only the batch's codes are looked up in the table.

    Identical rows inside the batch (the same record delivered by two
    overlapping files) are kept once. Applying the same batch twice appends
    nothing the second time. Returns whether rows were appended.
    """
    stored = batch.sparkSession.table(table)
    rows = cut_lineage(batch.dropDuplicates())
    stored = filter_by_keys(stored, rows.select(key), key)
    if last is None:
        delta = incremental_rows(stored, rows, key, date)
    else:
        known = join_per_key(rows, last, key, "left")
        newer = known.where(F.col("__last").isNull() | (F.col(date) > F.col("__last"))).drop("__last")
        had = stored.select([F.col(c).alias(f"__s_{c}") for c in rows.columns])
        same = [F.col(c).eqNullSafe(F.col(f"__s_{c}")) for c in rows.columns]
        delta = newer.join(had, reduce(lambda a, b: a & b, same), "left_anti")
    delta = cut_lineage(delta)
    if delta.isEmpty():
        return False
    append_rows(delta, table)
    return True


def upsert_new_files(
    spark: SparkSession,
    source_dir: str,
    schema: StructType,
    table: str,
    checkpoint_dir: str,
    key: str = "code",
    date: str = "date",
    fmt: str = "parquet",
    **source_options,
) -> None:
    """Each micro-batch appends only rows newer than the stored last date of
    their code (or of an unknown code) to catalog table ``table``.

    A replayed batch (crash after the append, before the checkpoint commit)
    finds its rows already stored and appends nothing, so the sink is
    idempotent even though ``foreachBatch`` is at-least-once.
    """

    # The last days from before the run. They are kept beside the checkpoint until the run ends, so a run
    # that crashed goes on with the ones it began with, and the size of the micro-batches changes nothing.
    before = f"{checkpoint_dir.rstrip('/')}-last-days"
    if not path_exists(spark, f"{before}/_SUCCESS"):
        latest_date(spark.table(table), key, date, "__last").write.mode("overwrite").parquet(before)

    def upsert(batch: DataFrame, epoch_id: int) -> None:
        upsert_batch(batch, table, key, date, batch.sparkSession.read.parquet(before))

    q = (
        file_stream(spark, source_dir, schema, fmt, **source_options)
        .writeStream.foreachBatch(upsert)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    delete_path(spark, before)
    # Batches run in a cloned session; drop this session's cached file listing.
    spark.catalog.refreshTable(table)
