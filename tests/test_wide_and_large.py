"""Pivots beyond Spark's limits, orders with nulls, responses too large for one row, vanished items, staged publish, lookups."""

import datetime as dt
import json
import os
import random
import uuid

import pytest
from pyspark.sql import functions as F

from marketlake.operators.reshape import block_columns, block_values, pivot_blocks, pivot_first
from marketlake.plans import jobs, series
from marketlake.sinks import jdbc
from marketlake.sinks.files import write_manifest, write_per_key
from marketlake.sinks.tables import guarded_replace, replace_table
from marketlake.sources.files import child_names, path_exists
from marketlake.sources.price_lookup import price_lookup, ranges
from marketlake.sources.statistics import LINE_ORDER, read_large_statistics, read_statistics, to_stat_long
from marketlake.sources.warehouse import read_jdbc

D = dt.date


def local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def test_a_null_order_comes_last_and_loses_no_cell(spark):
    rows = [("t", "a", 1.0, None), ("t", "b", 2.0, None), ("t", "b", 3.0, 7), ("t", "b", 4.0, 9), ("u", "a", 6.0, None), ("u", "a", 5.0, None)]
    long = spark.createDataFrame(rows, "TIME string, k string, v double, o long").withColumn("p", F.lit(1))
    for order in ("o", ["o", "p"]):
        got = {r.TIME: (r.a, r.b) for r in pivot_first(long, "TIME", "k", "v", order, ["a", "b"]).collect()}
        assert got["t"] == (1.0, 3.0) and got["u"][0] in (5.0, 6.0) and got["u"][1] is None
        wide = pivot_first(long, "TIME", "k", "v", order, ["a", "b", *[f"x{i}" for i in range(70)]])  # Spark's pivot
        assert {r.TIME: (r.a, r.b) for r in wide.collect()}["t"] == (1.0, 3.0)


def test_twelve_thousand_items_in_blocks(spark):
    rnd = random.Random(2)
    rows = [(f"t{rnd.randrange(3)}", f"i{rnd.randrange(12000)}", rnd.choice([None, 1.5, 2.5, 3.5]), n) for n in range(40000)]
    rows += [("t0", f"i{i}", 9.0, 10**6) for i in range(12000)]
    long = spark.createDataFrame(rows, "TIME string, k string, v double, o long").repartition(5)
    want = {}
    for t, k, v, _ in rows:
        if v is not None:
            want.setdefault((t, k), v)
    layout, cells = pivot_blocks(long, "TIME", "k", "v", "o", width=1000)
    assert [tuple(r) for r in layout.agg(F.count("*"), F.max("block"), F.countDistinct("block", "place")).collect()] == [(12000, 11, 12000)]
    assert [r.item for r in layout.orderBy("block", "place").collect()] == sorted(f"i{i}" for i in range(12000))
    assert {(r.TIME, r.item): r.value for r in block_values(layout, cells, "TIME").collect()} == want
    chosen = ["i7", "i11999", "no such item"]
    got = {r.TIME: (r["i7"], r["i11999"], r["no such item"]) for r in block_columns(layout, cells, "TIME", chosen).collect()}
    assert got == {t: tuple(want.get((t, k)) for k in chosen) for t in ("t0", "t1", "t2") if any((t, k) in want for k in chosen)}


def envelope(rows, indent=None, after="", separators=None):
    text = json.dumps({"StatisticSearch": {"list_total_count": len(rows), "row": rows}}, ensure_ascii=False, indent=indent, separators=separators)
    return text + after


@pytest.mark.parametrize("size", [97, 1000, 1 << 27])
def test_large_documents_equal_whole_ones(spark, scratch, size):
    rnd = random.Random(size)
    odd = ["plain", 'quoted "name"', "brace } and {", '"}', "}}]}", "back\\slash", '\\"}', "원/달러(종가 15:30)", "", ",{", "]", '"row": [', "new\nline", None]
    land = scratch("responses")
    os.makedirs(local(land))
    rows = [{"STAT_CODE": str(i), "STAT_NAME": rnd.choice(odd), "ITEM_NAME1": rnd.choice(odd), "TIME": "2024", "DATA_VALUE": str(i), "OTHER": rnd.choice(odd)} for i in range(300)]
    files = {"a.json": envelope(rows), "b.json": envelope(rows[:70], indent=2, after="\n"), "c.json": envelope([]), "d.json": envelope(rows[:1], separators=(",", ":")),
             "e.json": '{"RESULT": {"CODE": "INFO-200", "MESSAGE": "no data"}}', "f.json": '{"StatisticSearch": {"row": [' + json.dumps(rows[0]) + '], "list_total_count": 1, "more": [{"TIME": "x"}, {"TIME": "y"}]}}'}
    for name, text in files.items():
        with open(os.path.join(local(land), name), "w", encoding="utf-8") as f:
            f.write(text)
    piece = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(piece)
    spark.conf.set(piece, str(size))
    try:
        large = read_large_statistics(spark, land)
        got = sorted((tuple(r) for r in large.collect()), key=str)
        whole = read_statistics(spark, land).select(*large.columns)
        assert got == sorted((tuple(r) for r in whole.collect()), key=str) and len(got) == 372
        with pytest.raises(Exception, match="response without"):
            read_large_statistics(spark, land, strict=True).collect()
        with open(os.path.join(local(land), "g.json"), "w", encoding="utf-8") as f:
            f.write(envelope(rows)[:4000])
        with pytest.raises(Exception, match="breaks off"):
            read_large_statistics(spark, land).collect()
    finally:
        spark.conf.set(piece, before)


def test_json_lines_keep_their_order(spark, scratch):
    land = scratch("lines")
    os.makedirs(local(land))
    with open(os.path.join(local(land), "a.json"), "w", encoding="utf-8") as f:
        for i in range(200):
            f.write(envelope([{"TIME": "2024", "ITEM_NAME1": "x", "DATA_VALUE": str(1000 - i)}, {"TIME": "2024", "ITEM_NAME1": f"y{i}", "DATA_VALUE": "1"}]) + "\n")
    piece = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(piece)
    spark.conf.set(piece, "1500")
    try:
        long = to_stat_long(read_statistics(spark, land, json_lines=True))
        assert [r.x for r in pivot_first(long, "TIME", "ITEM_NAME1", "DATA_VALUE", LINE_ORDER, ["x"]).collect()] == [1000.0]
    finally:
        spark.conf.set(piece, before)


def test_vanished_items_stay_in_the_table(spark, scratch):
    table, root = f"wl_{uuid.uuid4().hex[:8]}", scratch("t")
    long = (lambda *items: spark.createDataFrame([("2024", i, 1.0, n) for n, i in enumerate(items)], "TIME string, ITEM_NAME1 string, DATA_VALUE double, n long"))
    shape = (lambda raw: series.kospi(raw, ["n"]))
    jobs.series_job(long("a", "b"), shape, scratch("raw"), scratch("csv"), table, root, ["TIME"], evolve=True)
    out = jobs.series_job(long("b", "c"), shape, scratch("raw"), scratch("csv"), table, root, ["TIME"], evolve=True)
    assert [r.asDict() for r in out.collect()] == [{"TIME": "2024", "a": None, "b": 1.0, "c": 1.0}]
    wide = f"wl_{uuid.uuid4().hex[:8]}"
    for items in (("a", "b"), ("b",)):
        out = jobs.macro_wide_job(long(*items), None, scratch("csv"), wide, root, "n")
    assert out.columns == ["TIME", "a", "b"]


def test_a_guarded_load_is_evaluated_once(spark, scratch):
    table, root = f"wl_{uuid.uuid4().hex[:8]}", scratch("t")
    replace_table(spark.createDataFrame([(1,), (2,)], "v long"), table, root)
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    rows = spark.createDataFrame([(i,) for i in range(10)], "v long").mapInPandas(count, "v long")
    assert guarded_replace(rows, table, root).count() == 10 and seen.value == 10
    versions = child_names(spark, f"{root}/{table}")
    assert guarded_replace(rows.where("v > 99"), table, root).count() == 10 and seen.value == 20
    assert child_names(spark, f"{root}/{table}") == versions


@pytest.fixture()
def warehouse(scratch):
    """Derby inside this process; no server and no port."""
    return f"jdbc:derby:{local(scratch('derby'))};create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def landed(spark, scratch, codes):
    path = scratch("history")
    os.makedirs(local(path))
    with open(os.path.join(local(path), "all.csv"), "w") as f:
        f.write(",Name,Code,Date,OpenValue\n" + "".join(f"{i},N{c},{c},2024-01-0{d},{d}.50\n" for i, (c, d) in enumerate((c, d) for c in codes for d in (1, 2, 3))))
    return path


def test_an_interrupted_load_is_whole_after_a_rerun(spark, scratch, warehouse, monkeypatch):
    url, props = warehouse
    history, manifest = landed(spark, scratch, ["A", "B", "C"]), scratch("m") + "/new.csv"
    write_manifest(spark.createDataFrame([("A",), ("B",)], "code string"), manifest)
    part = spark.createDataFrame([(D(2024, 1, 2), "NA", "A"), (D(2024, 1, 1), "NC", "C")], "date date, name string, code string").withColumn("open_value", F.lit(2.5).cast("decimal(8,2)"))
    jdbc.write_jdbc(part, url, "APP.H", properties=props, column_types=jobs.WAREHOUSE_TYPES)  # 1 of A's 3 rows
    rows = (lambda: sorted((r.code, r.date.day) for r in read_jdbc(spark, url, "APP.H", props).collect()))
    load = (lambda **kw: jobs.manifest_jdbc_load_job(spark, manifest, history, url, "APP.H", props, **kw))
    run = jdbc._run
    for broken in ("DELETE", "INSERT INTO APP.H ", "INSERT INTO APP.H_loads", "STAGE"):
        def fault(c, sql, *values, broken=broken):
            if sql.startswith(broken):
                raise RuntimeError("lost")
            return run(c, sql, *values)

        with monkeypatch.context() as m:
            m.setattr(jdbc, "_run", fault)
            if broken == "STAGE":
                m.setattr(jdbc, "write_jdbc", lambda *a, w=jdbc.write_jdbc, **k: (_ for _ in ()).throw(RuntimeError("lost")) if "stage" in a[2] else w(*a, **k))
            with pytest.raises(RuntimeError):
                load()
        assert rows() == [("A", 2), ("C", 1)] and path_exists(spark, manifest)  # as it was
    with monkeypatch.context() as m:
        m.setattr(jdbc, "_run", lambda c, sql, *v: (_ for _ in ()).throw(RuntimeError("lost")) if sql.startswith("DROP") else run(c, sql, *v))
        with pytest.raises(RuntimeError):
            load()  # lost after the commit
    whole = [("A", 1), ("A", 2), ("A", 3), ("B", 1), ("B", 2), ("B", 3), ("C", 1)]
    assert rows() == whole
    assert load(delete_manifest=False) and rows() == whole and load() and rows() == whole and not load()


def test_rows_of_a_task_that_ran_twice_are_published_once(spark, warehouse, monkeypatch):
    url, props = warehouse
    rows = spark.createDataFrame([(1, "x"), (1, "x"), (2, "")], "v long, t string").repartition(3)
    write = jdbc.write_jdbc

    def twice(df, url, table, mode="append", properties=None, **kw):
        write(df, url, table, mode, properties, **kw)
        if "stage" in table:
            write(df.limit(2), url, table, "append", properties, **kw)

    monkeypatch.setattr(jdbc, "write_jdbc", twice)
    assert jdbc.publish_jdbc(rows, url, "APP.T", "load_1", props, column_types="t VARCHAR(10)")
    assert not jdbc.publish_jdbc(rows, url, "APP.T", "load_1", props, column_types="t VARCHAR(10)")
    assert sorted(map(str, read_jdbc(spark, url, "APP.T", props).collect())) == sorted(map(str, rows.collect()))
    with pytest.raises(ValueError):
        jdbc.publish_jdbc(rows, url, "APP.T", "x; DROP TABLE y", props)


def test_lookups_open_the_asked_symbols_only(spark, scratch, capsys):
    path = scratch("landed")
    rows = [(c, D(y, 6, 1), float(y), i) for i, c in enumerate(["005930", "^X", "AB C", "Z"]) for y in (1999, 2010, 2024)]
    write_per_key(spark.createDataFrame(rows, "code string, date date, price double, n int"), path, fmt="parquet")
    os.remove(next(os.path.join(d, f) for d, _, fs in os.walk(local(path) + "/code=Z") for f in fs if f.endswith(".parquet")))
    with open(os.path.join(local(path), "code=Z", "broken.parquet"), "w") as f:
        f.write("not a parquet file")
    schema = "date date, code string, price double"
    asked = price_lookup(spark, path, schema, ["005930", "^X", "none"])
    got = asked.where("date > DATE '1999-06-01' AND price < 2020")
    capsys.readouterr()
    got.explain("formatted")
    text = capsys.readouterr().out
    pushed = text[text.index("PushedFilters"):].split("\n")[0]
    assert "In(code" in pushed and "GreaterThan(date" in pushed
    assert sorted((r.code, r.date.year) for r in got.collect()) == [("005930", 2010), ("^X", 2010)]
    # One frame, other filters: none remembers those before it.
    assert asked.where("code = '^X' AND date < DATE '2000-01-01'").count() == 1 and asked.count() == 6
    assert price_lookup(spark, path, schema, ["AB C"], "1990-01-01", "2024-06-01").count() == 3
    whole = price_lookup(spark, path, schema)
    assert whole.where("code = 'AB C'").count() == 3 and whole.where("code = 'none'").count() == 0
    with pytest.raises(Exception):
        whole.count()  # the whole folder holds the broken file
    assert ranges(D(1990, 5, 1), D(2024, 6, 1), 10) == [(D(1990, 5, 1), D(1999, 12, 31)), (D(2000, 1, 1), D(2009, 12, 31)), (D(2010, 1, 1), D(2019, 12, 31)), (D(2020, 1, 1), D(2024, 6, 1))]
