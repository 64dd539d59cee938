"""Work and files that grow no faster than the input: pivots in blocks, large responses, keyed streams."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marketlake.operators.reshape import block_values, pivot_blocks
from marketlake.plans import series_queries
from marketlake.sinks.history_store import HistoryStore
from marketlake.sources.files import child_names
from marketlake.sources.statistics import read_large_statistics
from marketlake.streaming.keyed import stream_into_store


@pytest.mark.parametrize("width", [1, 7, 400])
def test_cells_of_a_block_are_laid_out_in_one_pass(spark, width):
    rnd = random.Random(width)
    want = {(f"t{rnd.randrange(3)}", f"i{rnd.randrange(500):03d}"): rnd.random() for _ in range(300)}
    long = spark.createDataFrame([(t, k, v, 1) for (t, k), v in want.items()], "TIME string, k string, v double, o int")
    layout, cells = pivot_blocks(long, "TIME", "k", "v", "o", width)
    assert {len(r.cells) for r in cells.collect()} == {width}
    assert {(r.TIME, r.item): r.value for r in block_values(layout, cells, "TIME").collect()} == want
    place = {r["item"]: (r["block"], r["place"]) for r in layout.collect()}
    got = {(r.TIME, r.block, p): v for r in cells.collect() for p, v in enumerate(r.cells) if v is not None}
    assert got == {(t, *place[k]): v for (t, k), v in want.items()}
    assert "element_at(__m" not in cells._jdf.queryExecution().analyzed().toString()  # a search per place is quadratic in the width


def test_pivot_sparse_writes_folders_of_many_blocks(spark, scratch, monkeypatch):
    tables, made = scratch("tables"), []
    rows = spark.range(0, 9000).select(
        F.element_at(F.array(F.lit("A"), F.lit("N"), F.lit(None)), (F.col("id") % 3 + 1).cast("int")).alias("l_returnflag"), (F.col("id") % 4500).alias("l_orderkey"),
        F.when(F.col("id") % 11 != 0, F.col("id") * 1.5).alias("l_extendedprice"), F.lit(1).alias("l_linenumber"), F.col("id").alias("l_partkey"))
    rows.write.parquet(f"{tables}/lineitem.parquet")
    path = series_queries.scratch_path
    monkeypatch.setattr(series_queries, "scratch_path", lambda *a: made.append(path(*a)) or made[-1])
    out = series_queries.pivot_sparse(spark, tables)
    want = {(r.l_returnflag, str(r.l_orderkey)): r.l_extendedprice for r in rows.orderBy(F.desc("l_partkey")).collect() if r.l_returnflag and r.l_extendedprice is not None}
    assert {(r.TIME, r["item"]): r.value for r in out.collect()} == want
    assert [n for n in child_names(spark, made[0]) if "=" in n] == ["blocks=0"]  # five blocks, not a folder each


@pytest.fixture()
def settings(spark):
    """Session settings for one test."""
    before = {}

    def put(name, value):
        before.setdefault(name, spark.conf.get(name, None))
        spark.conf.set(name, value)

    yield put
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_records_of_one_document_stay_in_many_tasks(spark, scratch, settings):
    settings("spark.sql.autoBroadcastJoinThreshold", "-1")
    settings("spark.sql.adaptive.coalescePartitions.enabled", "false")
    settings("spark.sql.files.maxPartitionBytes", "4000")
    rows = ",".join(f'{{"TIME": "{i}", "DATA_VALUE": "{i}"}}' for i in range(2000))
    path = scratch("one")
    spark.createDataFrame([('{"StatisticSearch": {"row": [' + rows + "]}}",)], "value string").coalesce(1).write.text(path)
    got = read_large_statistics(spark, path).select("row_pos", "TIME", F.spark_partition_id().alias("task")).collect()
    assert sorted((r.row_pos, r.TIME) for r in got) == [(i, str(i)) for i in range(2000)]
    assert len({r.task for r in got}) > 1


def test_json_large_sorts_by_many_tasks(spark, scratch):
    ids = [*range(500, 0, -1), 7, 7]
    tables = scratch("tables")
    for folder, chosen in ((tables, ids), (empty := scratch("empty"), [])):
        rows = [(i, None, 1, f"t{i % 3}", i / 4, '{"k": 1}') for i in chosen]
        spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double, props string").repartition(3).write.parquet(f"{folder}/events.parquet")
    got = series_queries.json_large(spark, tables).orderBy("row_pos").collect()
    assert [r.row_pos for r in got] == [*range(502)] and [r.DATA_VALUE for r in got] == [i / 4 for i in sorted(ids)]
    assert [r.STAT_NAME for r in got] == [f't{i % 3} "}}{{[,\\' for i in sorted(ids)]
    assert series_queries.json_large(spark, empty).count() == 0
    assert not hasattr(series_queries, "_by_id")  # a window over the whole table is one task


def test_a_stream_keeps_its_state_in_few_partitions(spark, scratch, settings):
    settings("spark.sql.shuffle.partitions", "64")
    schema = "code string, date date, price double, row_key long"
    store = HistoryStore(spark, scratch("store"), StructType.fromDDL(schema), buckets=2)
    landing, checkpoint = scratch("in"), scratch("ckpt")
    days = [dt.date(2024, 1, d) for d in (1, 2, 3)]
    parts = (lambda: {n for n in child_names(spark, f"{checkpoint}/state/0") if n.isdigit()})
    for i, day in enumerate(days):
        spark.createDataFrame([("A", day, 1.0, i), ("A", day, 1.0, i), ("B", day, 2.0, i)], schema).coalesce(1).write.parquet(f"{landing}/{i}")
        stream_into_store(spark, landing, store, checkpoint, maxFilesPerTrigger=1)
        assert len(parts()) <= 2 * spark.sparkContext.defaultParallelism  # every micro-batch opens all of them
    assert sorted((r.code, r.date, r.row_key) for r in store.read().collect()) == [(c, d, i) for c in "AB" for i, d in enumerate(days)]
    assert spark.conf.get("spark.sql.shuffle.partitions") == "64"
    assert spark.conf.get("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", None) is None
