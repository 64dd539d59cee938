"""Sharding by a two-pass external shuffle (operator 10).

Pass 1 scatters the records with a seeded hash uniformly into buckets, as many as
make each small enough for a task's memory, and writes the buckets. Pass 2
shuffles each bucket by Fisher-Yates (Spark's ``shuffle``) and lays the buckets end
to end: a record's place in this order decides its shard and its slot, so the shards'
row counts differ by one at most. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.text import Scratch, fresh, remove, written
from marketlake.session import scratch_path

BUCKET_BYTES = 32 << 20
BROADCAST_BUCKETS = 1_000_000  # 16 bytes each


def record_size(text: str):
    """UTF-8 bytes of the text (null: none) plus 8."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long")


def assign_shards(df: DataFrame, shards: int, seed: int, bucket_bytes: int = BUCKET_BYTES, text: str | None = None, path: str | None = None) -> DataFrame:
    """All rows and columns of ``df`` with shard (int) and slot (long, gapless from 0 in a shard) appended.

    ``text`` names the column by whose bytes the buckets are sized; without it
    every row counts 64 bytes. ``path`` is where the buckets are written (default: a new scratch folder). A row's bucket is a seeded hash of its number in
    pass 1, not of its contents, so equal rows, equal keys and nulls spread like
    any others. The written buckets fix the scatter, and a bucket is shuffled inside one
    task, so lost executors repeat work without losing or doubling rows.
    Columns named shard or slot are replaced. An empty table gives an empty one;
    with fewer rows than shards, the last shards stay empty.
    """
    spark = df.sparkSession
    df = df.drop("shard", "slot")
    size = record_size(text) if text else F.lit(64).cast("long")
    total = df.agg(F.sum(size)).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes), spark.sparkContext.defaultParallelism)
    bucket, row, at = fresh("bucket"), fresh("row"), fresh("at")
    path = path or scratch_path(spark, "buckets")
    (df.withColumn(bucket, F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.lit(seed)), F.lit(buckets)).cast("int"))
     .withColumn(row, F.monotonically_increasing_id())
     .write.parquet(path, compression="zstd"))
    scattered = spark.read.parquet(path)
    # One row per bucket, so the running count over them is as short as the bucket list, whose length is known here.
    counts = scattered.groupBy(bucket).agg(F.count(F.lit(1)).alias("n"))
    begin = counts.select(bucket, (F.sum("n").over(Window.orderBy(bucket)) - F.col("n")).alias(at))
    if buckets <= BROADCAST_BUCKETS:
        begin = F.broadcast(begin)
    record = F.struct(row, *[f"`{c}`" for c in df.columns])
    # Rows in the order of their numbers and buckets in theirs: a repeated task draws the same permutations.
    gathered = scattered.groupBy(bucket).agg(F.array_sort(F.collect_list(record)).alias("rows")).sortWithinPartitions(bucket)
    gathered = gathered.select(bucket, F.shuffle("rows", seed).alias("rows"))
    placed = gathered.join(begin, bucket).select(F.posexplode("rows").alias("pos", "r"), at)
    place = F.col("pos") + F.col(at)
    return placed.select(*[F.col("r")[c].alias(c) for c in df.columns], F.pmod(place, F.lit(shards)).cast("int").alias("shard"), ((place - F.pmod(place, F.lit(shards))) / shards).cast("long").alias("slot"))


def write_shards(df: DataFrame, path: str, shards: int, seed: int, text: str | None = None, bucket_bytes: int = BUCKET_BYTES) -> None:
    """Writes ``path/shard=N`` as Parquet, each shard's rows in the order of their slots.

    Slots are dealt by range, so a shard larger than a task's memory is written
    by several tasks, each a run of slots in files that sort by name. The buckets
    and their shuffle files are given up before the shards are dealt.
    """
    with Scratch(df.sparkSession) as steps:
        buckets = f"{steps.path}/buckets"
        placed = written(assign_shards(df, shards, seed, bucket_bytes, text, buckets), f"{steps.path}/placed", "zstd")
        remove(df.sparkSession, buckets)
        written(placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot"), path, "zstd", ["shard"])
