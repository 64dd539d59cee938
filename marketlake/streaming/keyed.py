"""T2 with keyed state: new files reach a ``HistoryStore`` without a look at its rows.

A row counts if it is newer than the last day that the store's index held for its code
when the run began, so the size of the micro-batches changes nothing. What a run has taken
already is state of the stream, keyed by run and row (``dropDuplicatesWithinWatermark``, in the JVM),
and forgotten after a week. Each micro-batch is one load of the store, tagged with its
number: a replayed batch finds its tag and adds nothing.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marketlake.sinks.history_store import HistoryStore
from marketlake.sources.files import child_names, delete_path, path_exists
from marketlake.streaming.files import file_stream

# The state's settings while a stream runs. With a changelog a micro-batch writes what it changed; snapshots follow in the background.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
PARTITIONS = "spark.sql.shuffle.partitions"
FORGET = "7 days"  # a run is expected to end within this time


def _run_record(spark: SparkSession, checkpoint_dir: str, version: int) -> tuple[str, int]:
    """(name, store version) of the present run; a run that crashed goes on under its own."""
    folder = f"{checkpoint_dir.rstrip('/')}-run"
    for name in child_names(spark, folder):
        if path_exists(spark, f"{folder}/{name}/_SUCCESS"):
            run, _, began = name.partition("-")
            return run, int(began)
    run = uuid.uuid4().hex[:12]
    spark.range(0).write.parquet(f"{folder}/{run}-{version}")
    return run, version


def stream_into_store(spark: SparkSession, source_dir: str, store: HistoryStore, checkpoint_dir: str, fmt: str = "parquet", schema: StructType | None = None, state_partitions: int | None = None, **source_options) -> None:
    """The files of ``source_dir`` that no run has read yet -> the rows newer than their code's last day -> store.

    Equal rows of one run, in one file or several, are stored once. Rows without a code or a
    date are put aside by the store. Micro-batches join the store's index (one row per code) and the state; the stored
    rows are not read. ``schema`` is that of the files (default: the store's).

    Every micro-batch opens and commits all partitions of the state, however few its rows. Their number is fixed
    by the first run: ``state_partitions``, by default two per core but no more than the shuffle partitions.
    """
    schema = schema or store.schema
    run, began = _run_record(spark, checkpoint_dir, store.version())
    stream_id = hashlib.sha256(checkpoint_dir.encode()).hexdigest()[:12]
    columns = store.schema.names
    last = store.index(began).select(store.key, F.col("last").alias("__last"))
    rows = file_stream(spark, source_dir, schema, fmt, **source_options)
    rows = rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in store.schema.fields])
    newer = rows.join(last, store.key, "left").where(F.col("__last").isNull() | F.col(store.date).isNull() | (F.col(store.date) > F.col("__last"))).drop("__last")
    now = newer.withColumns({"__run": F.lit(run), "__seen": F.current_timestamp()}).withWatermark("__seen", FORGET)
    once = now.dropDuplicatesWithinWatermark(["__run", *columns]).select(*columns)

    def load(batch: DataFrame, number: int) -> None:
        own, tag = replace(store, spark=batch.sparkSession), f"{stream_id}-{number}"
        if own.committed(tag):  # a replay: only the state has still to see the rows
            batch.write.format("noop").mode("overwrite").save()
        else:
            own.add(batch, tag=tag, newer_only=False)

    parts = state_partitions or min(int(spark.conf.get(PARTITIONS)), 2 * spark.sparkContext.defaultParallelism)
    settings = STATE | {PARTITIONS: str(parts)}
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        query = once.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint_dir).outputMode("append").trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    delete_path(spark, f"{checkpoint_dir.rstrip('/')}-run")
