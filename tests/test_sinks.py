"""Sinks: atomic replace, idempotent reloads, guards, partitioned writes, Avro, JDBC."""

import glob
import uuid

import pytest
from pyspark.sql import functions as F

from marketlake.operators.conform import conform, typed_history
from marketlake.schemas import AVRO_HISTORY
from marketlake.sinks.files import avro_available, write_avro, write_manifest, write_partitioned, write_per_key
from marketlake.sinks.jdbc import reload_jdbc
from marketlake.sinks.tables import (
    align_to,
    create_if_absent,
    delete_keys,
    guarded_replace,
    replace_table,
    truncate_reload,
    with_run_date,
)
from marketlake.sources.warehouse import read_jdbc


def _name():
    return f"t_{uuid.uuid4().hex[:10]}"


def _local(p):
    return p[len("file:"):] if p.startswith("file:") else p


@pytest.fixture()
def top(spark):
    return spark.createDataFrame([(1, "삼성전자", "005930"), (2, "SK하이닉스", "000660")],
                                 "ranking int, name string, code string")


def test_failed_replace_keeps_old_version(spark, scratch, top):
    name, root = _name(), scratch("tables")
    replace_table(top, name, root)
    bad = top.withColumn("name", F.raise_error(F.lit("boom")))
    with pytest.raises(Exception):
        replace_table(bad, name, root)
    assert sorted(r.code for r in spark.table(name).collect()) == ["000660", "005930"]
    with pytest.raises(RuntimeError):
        replace_table(top.limit(1), name, root, verify=lambda staged: staged.count() == 2)
    assert spark.table(name).count() == 2


def test_reload_twice_equals_once(spark, scratch, top):
    name, root = _name(), scratch("tables")
    truncate_reload(top, name, root)
    assert truncate_reload(top, name, root).count() == 2


def test_reload_by_position_and_by_name(spark, scratch, top):
    name, root = _name(), scratch("tables")
    truncate_reload(top, name, root)
    shuffled = top.select("code", "ranking", "name")
    assert sorted(map(tuple, truncate_reload(shuffled, name, root).collect())) == sorted(map(tuple, top.collect()))
    with pytest.raises(ValueError):
        align_to(top.select("code"), spark.table(name).schema, by_position=True)


def test_empty_input_keeps_table(spark, scratch, top):
    name, root = _name(), scratch("tables")
    replace_table(top, name, root)
    assert guarded_replace(top.where(F.lit(False)), name, root).count() == 2


def test_create_if_absent_is_noop_when_present(spark, scratch, top):
    name, root = _name(), scratch("tables")
    create_if_absent(spark, name, top.schema, root)
    replace_table(top, name, root)
    assert create_if_absent(spark, name, top.schema, root).count() == 2


def test_delete_keys(spark, scratch, top):
    name, root = _name(), scratch("tables")
    replace_table(top, name, root)
    gone = spark.createDataFrame([("000660",)], "code string")
    assert [r.code for r in delete_keys(name, gone, root).collect()] == ["005930"]


def test_run_date_column_first(top):
    out = with_run_date(top.select("name", "code"), "2024-01-02")
    assert out.columns == ["date", "name", "code"] and str(out.first().date) == "2024-01-02"


def test_partitioned_write_bounds_files_per_value(spark, scratch):
    df = spark.range(0, 5000).select(F.when(F.col("id") < 4000, "hot").otherwise("cold").alias("seg"), "id")
    p = scratch("part")
    write_partitioned(df, p, ["seg"], files_per_value=3)
    hot_files = glob.glob(_local(p) + "/seg=hot/*.parquet")
    assert 1 <= len(hot_files) <= 3
    assert spark.read.parquet(p).count() == 5000


def test_per_key_overwrite_keeps_other_keys(spark, scratch):
    p = scratch("perkey")
    a = spark.createDataFrame([("005930", 1.0), ("000660", 2.0)], "code string, v double")
    write_per_key(a, p, fmt="parquet")
    write_per_key(spark.createDataFrame([("005930", 9.0)], "code string, v double"), p, fmt="parquet")
    got = {r.code: r.v for r in spark.read.schema("v double, code string").parquet(p).collect()}
    assert got == {"005930": 9.0, "000660": 2.0}


def test_manifest_only_when_new_codes(spark, scratch):
    p = scratch("manifest")
    assert write_manifest(spark.createDataFrame([], "code string"), p) is False
    assert write_manifest(spark.createDataFrame([("AAPL",)], "code string"), p) is True


def test_conform_and_typed_history(spark):
    import datetime as dt

    df = spark.createDataFrame([(dt.date(2024, 1, 2), 1.5, "삼성전자", "005930", "x")],
                               "Date date, Open double, name string, code string, extra string")
    out = conform(df, AVRO_HISTORY)
    assert out.columns == [f.name for f in AVRO_HISTORY.fields]
    r = out.first()
    assert r.Date == "2024-01-02" and r.Open == 1.5 and r.Close is None
    assert dict(out.dtypes)["Open"] == "float"
    text = spark.createDataFrame([("2024-01-02", "Apple", "AAPL", "12.345"), ("bad", "X", "X", "1234567.891")],
                                 "Date string, Name string, Code string, OpenValue string")
    rows = typed_history(text).collect()
    assert str(rows[0].open_value) == "12.35" and rows[1].date is None and rows[1].open_value is None


def test_avro_sink_reports_missing_module(spark, scratch, top):
    if avro_available(spark):
        p = scratch("avro")
        write_avro(conform(top, AVRO_HISTORY), p)
        assert spark.read.format("avro").load(p).count() == 2
    else:
        with pytest.raises(RuntimeError, match="spark-avro"):
            write_avro(top, scratch("avro"))


def test_jdbc_reload_idempotent(spark, scratch, top):
    url = f"jdbc:derby:{_local(scratch('derby'))};create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    reload_jdbc(top, url, "APP.TOP", props)
    reload_jdbc(top, url, "APP.TOP", props)
    assert read_jdbc(spark, url, "APP.TOP", props).count() == 2


def test_drop_key_dirs_for_codes_that_left(spark, scratch):
    from marketlake.sinks.files import drop_key_dirs

    p = scratch("perkey")
    write_per_key(spark.createDataFrame([("005930", 1.0), ("000660", 2.0), ("035720", 3.0)], "code string, v double"),
                  p, fmt="parquet")
    keep = spark.createDataFrame([("005930",), ("000660",)], "code string")
    assert drop_key_dirs(spark, p, keep) == ["035720"]
    got = sorted(r.code for r in spark.read.schema("v double, code string").parquet(p).collect())
    assert got == ["000660", "005930"]
    assert drop_key_dirs(spark, p, keep) == []


def test_vacuum_keeps_current_and_previous(spark, scratch, top):
    import time

    from marketlake.sinks.tables import vacuum_versions

    name, root = _name(), scratch("tables")
    for _ in range(4):
        replace_table(top, name, root)
        time.sleep(0.01)
    deleted = vacuum_versions(spark, name, root, keep_previous=1)
    assert len(deleted) == 2
    assert spark.table(name).count() == 2
    assert vacuum_versions(spark, name, root, keep_previous=1) == []


def test_list_jdbc_tables_and_staged_replication(spark, scratch, top):
    from marketlake.sinks.jdbc import replicate_tables
    from marketlake.sources.warehouse import list_jdbc_tables

    url = f"jdbc:derby:{_local(scratch('derby'))};create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    copied = replicate_tables({"TOP_A": top, "TOP_B": top.limit(1)}, url, props, "APP.", 2, scratch("staging"))
    assert sorted(copied) == ["TOP_A", "TOP_B"]
    derby_catalog = ("SELECT s.SCHEMANAME AS schemaname, t.TABLENAME AS tablename FROM SYS.SYSTABLES t "
                     "JOIN SYS.SYSSCHEMAS s ON t.SCHEMAID = s.SCHEMAID WHERE s.SCHEMANAME = 'APP'")
    names = sorted(r.TABLENAME for r in list_jdbc_tables(spark, url, "APP", props, derby_catalog).collect())
    assert names == ["TOP_A", "TOP_B"]
    assert read_jdbc(spark, url, "APP.TOP_A", props).count() == 2


def test_partitioned_write_without_aqe_uses_salted_writers(spark, scratch):
    df = spark.range(0, 5000).select(F.when(F.col("id") < 4000, "hot").otherwise("cold").alias("seg"), "id")
    p = scratch("part_noaqe")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        write_partitioned(df, p, ["seg"], files_per_value=3)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert 1 <= len(glob.glob(_local(p) + "/seg=hot/*.parquet")) <= 3
    assert spark.read.parquet(p).count() == 5000


def test_vacuum_leaves_unpublished_newer_versions(spark, scratch, top):
    import time

    from marketlake.sinks.tables import vacuum_versions

    name, root = _name(), scratch("tables")
    replace_table(top, name, root)
    time.sleep(0.01)
    replace_table(top, name, root)
    time.sleep(0.01)
    with pytest.raises(Exception):  # a load that fails before its swap leaves a newer, unpublished directory
        replace_table(top.withColumn("name", F.raise_error(F.lit("boom"))), name, root)
    assert vacuum_versions(spark, name, root, keep_previous=0) != []
    assert spark.table(name).count() == 2


def test_upsert_per_key_append_rewrite_and_compact(spark, scratch):
    import datetime as dt

    from pyspark.sql.types import DateType, DoubleType, StringType, StructField, StructType

    from marketlake.sinks.files import compact_per_key, upsert_per_key

    schema = StructType([StructField("code", StringType()), StructField("date", DateType()),
                         StructField("price", DoubleType())])

    def day(d, code="005930", price=1.0):
        return (code, dt.date(2024, 1, d), price)

    for rewrite in (False, True):
        p = scratch("perkey_upsert")
        upsert_per_key(spark, p, spark.createDataFrame([day(1), day(2), day(1, "000660")], schema), schema,
                       rewrite=rewrite)
        incoming = spark.createDataFrame([day(2), day(3), day(4), day(1, "000660"), day(5, "035720")], schema)
        upsert_per_key(spark, p, incoming, schema, rewrite=rewrite)
        upsert_per_key(spark, p, incoming, schema, rewrite=rewrite)  # rerun: nothing new
        got = sorted((r.code, r.date.day) for r in spark.read.schema(schema).parquet(p).collect())
        assert got == [("000660", 1), ("005930", 1), ("005930", 2), ("005930", 3), ("005930", 4),
                       ("035720", 5)], rewrite
    # appended files pile up per code; compaction rewrites those directories only
    for d in range(6, 12):
        upsert_per_key(spark, p, spark.createDataFrame([day(d)], schema), schema)
    before = sorted(map(tuple, spark.read.schema(schema).parquet(p).collect()))
    assert compact_per_key(spark, p, schema, min_files=4) == ["005930"]
    assert sorted(map(tuple, spark.read.schema(schema).parquet(p).collect())) == before
    assert len(glob.glob(_local(p) + "/code=005930/*.parquet")) < 4


def test_typed_history_raise_mode(spark):
    bad = spark.createDataFrame([("not a date", "A", "X", "1.0")], "Date string, Name string, Code string, OpenValue string")
    assert typed_history(bad).first().date is None  # default: NULL
    with pytest.raises(Exception):
        typed_history(bad, on_error="raise").collect()
