"""Streaming: replayed micro-batches are harmless; new files are picked up once."""

import datetime as dt
import uuid

from pyspark.sql.types import DateType, DoubleType, LongType, StringType, StructField, StructType

from marketlake.sinks.files import write_parquet
from marketlake.sinks.tables import create_if_absent
from marketlake.streaming.files import ingest_new_files, upsert_batch, upsert_new_files

SCHEMA = StructType([
    StructField("code", StringType()), StructField("date", DateType()),
    StructField("price", DoubleType()), StructField("row_key", LongType()),
])


def test_replayed_batch_appends_nothing(spark, scratch):
    name = f"s_{uuid.uuid4().hex[:8]}"
    create_if_absent(spark, name, SCHEMA, scratch("tables"))
    batch = spark.createDataFrame([("005930", dt.date(2024, 1, 2), 1.0, 1), ("005930", dt.date(2024, 1, 3), 2.0, 2)],
                                  SCHEMA)
    assert upsert_batch(batch, name) is True
    assert upsert_batch(batch, name) is False  # replay after a crash before the checkpoint commit
    spark.catalog.refreshTable(name)
    assert spark.table(name).count() == 2


def test_new_files_once_and_upsert_run_twice(spark, scratch):
    src, sink, ckpt = scratch("landing"), scratch("sink"), scratch("ckpt")
    d1 = spark.createDataFrame([("A", dt.date(2024, 1, 2), 1.0, 1)], SCHEMA)
    d2 = spark.createDataFrame([("A", dt.date(2024, 1, 2), 1.0, 1), ("A", dt.date(2024, 1, 3), 2.0, 2)], SCHEMA)
    write_parquet(d1, f"{src}/drop-1")
    ingest_new_files(spark, src, SCHEMA, sink, ckpt)
    ingest_new_files(spark, src, SCHEMA, sink, ckpt)  # nothing new
    assert spark.read.parquet(sink).count() == 1
    write_parquet(d2, f"{src}/drop-2")
    ingest_new_files(spark, src, SCHEMA, sink, ckpt)
    assert spark.read.parquet(sink).count() == 3  # the file source copies files, it does not de-duplicate

    name = f"s_{uuid.uuid4().hex[:8]}"
    create_if_absent(spark, name, SCHEMA, scratch("tables"))
    upsert_new_files(spark, src, SCHEMA, name, scratch("ckpt"))
    upsert_new_files(spark, src, SCHEMA, name, scratch("ckpt"))  # fresh checkpoint = full replay
    assert sorted(r.row_key for r in spark.table(name).collect()) == [1, 2]


def test_bounded_batches_and_archived_sources(spark, scratch):
    import glob

    src, sink, ckpt, archive = scratch("landing"), scratch("sink"), scratch("ckpt"), scratch("archive")
    for i in range(3):
        write_parquet(spark.createDataFrame([("A", dt.date(2024, 1, 2 + i), 1.0, i)], SCHEMA), f"{src}/drop-{i}")
    ingest_new_files(spark, src, SCHEMA, sink, ckpt, max_files_per_trigger=1, clean_source="archive",
                     archive_dir=archive)
    assert spark.read.parquet(sink).count() == 3
    ingest_new_files(spark, src, SCHEMA, sink, ckpt, max_files_per_trigger=1, clean_source="archive",
                     archive_dir=archive)  # a later run sees nothing new
    assert spark.read.parquet(sink).count() == 3
    local = archive[len("file:"):] if archive.startswith("file:") else archive
    assert len(glob.glob(local + "/**/*.parquet", recursive=True)) >= 1  # processed files moved out


def test_csv_landing_partitioned_sink(spark, scratch):
    import os

    src, sink, ckpt = scratch("landing_csv"), scratch("sink_csv"), scratch("ckpt_csv")
    local = src[len("file:"):] if src.startswith("file:") else src
    os.makedirs(local + "/d1")
    with open(local + "/d1/a.csv", "w") as f:
        f.write('code,date,price,row_key\n005930,2024-01-02,1.5,1\n"AA,PL",2024-01-03,2.5,2\n')
    ingest_new_files(spark, src, SCHEMA, sink, ckpt, fmt="csv", partition_by=["date"])
    got = sorted((r.code, str(r.date), r.price) for r in spark.read.parquet(sink).collect())
    assert got == [("005930", "2024-01-02", 1.5), ("AA,PL", "2024-01-03", 2.5)]
