"""The history store and its jobs: interrupted loads, untouched files, day-by-day runs, micro-batches of any size."""

import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, LongType, StringType, StructField, StructType

from marketlake.operators.volatility import high_volatility
from marketlake.plans import store_jobs
from marketlake.sinks import history_store
from marketlake.sinks.files import write_manifest, write_per_key
from marketlake.sinks.history_store import HistoryStore
from marketlake.sources.files import child_names, read_manifest
from marketlake.streaming.keyed import stream_into_store

D = dt.date
PRICES = StructType([StructField("code", StringType()), StructField("date", DateType()), StructField("price", DoubleType()), StructField("row_key", LongType())])


def rows_of(codes, days, price=1.0):
    return [(c, d, price, i) for i, (c, d) in enumerate((c, d) for c in codes for d in days)]


def frame(spark, rows, schema=PRICES):
    return spark.createDataFrame(rows, schema)


@pytest.fixture()
def store(spark, scratch):
    return HistoryStore(spark, scratch("store"), PRICES, buckets=4)


def local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def files_of(store):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(local(store.path) + "/data") for f in fs if f.endswith(".parquet")}


CODES = [f"C{i}" for i in range(12)]
DAYS = [D(2021, 12, 30), D(2022, 1, 3), D(2022, 1, 4)]


def test_loads_add_newer_days_once(spark, store):
    assert store.read().count() == 0 and store.index().count() == 0 and store.version() == 0
    first = frame(spark, rows_of(CODES, DAYS) + [(None, DAYS[0], 1.0, 1), ("C1", None, 2.0, 2)])
    assert store.add(first) == history_store.Added(1, 36, 2)
    assert [(r.code, r.date) for r in store.rejects().orderBy("code").collect()] == [(None, DAYS[0]), ("C1", None)]
    assert store.add(frame(spark, rows_of(CODES, DAYS))).stored == 0 and store.version() == 1
    more = frame(spark, [("C1", DAYS[1], 9.0, 1), ("C1", D(2022, 1, 5), 9.0, 2), ("C1", D(2022, 1, 5), 9.0, 2), ("NEW", D(1999, 1, 1), 9.0, 3)])
    assert store.add(more, tag="s-1") == history_store.Added(2, 3, 0)
    assert store.add(more, tag="s-1", newer_only=False) == history_store.Added(2, 0, 0)  # a replay
    assert store.read().count() == 39 and {r.code: r.last for r in store.index().collect()}["C1"] == D(2022, 1, 5)
    with pytest.raises(ValueError):
        HistoryStore(spark, store.path, StructType.fromDDL("code string, date date, year int"))


def test_an_interrupted_load_is_never_seen(spark, store, monkeypatch):
    store.add(frame(spark, rows_of(CODES, DAYS)))
    more = frame(spark, rows_of(CODES, [D(2022, 2, 1)]))
    with monkeypatch.context() as m:
        m.setattr(HistoryStore, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            store.add(frame(spark, rows_of(["X"], [D(2022, 2, 1), D(2022, 2, 2)])))
        with pytest.raises(RuntimeError):
            store.delete(frame(spark, rows_of(["C1"], DAYS)).select("code"))
    assert store.read().count() == 36 and store.version() == 1
    assert store.add(more).stored == 12 and store.read().count() == 48  # written over what was left
    assert store.read().where("code = 'X'").count() == 0


def test_lookups_prune_partitions_and_increments_read_no_stored_rows(spark, store, capsys, monkeypatch):
    store.add(frame(spark, rows_of(CODES, DAYS)))
    got = store.read(codes=frame(spark, rows_of(["C1", "C2"], DAYS)).select("code"), since="2022-01-01")
    capsys.readouterr()
    got.explain("formatted")
    text = capsys.readouterr().out
    filters = re.search(r"PartitionFilters: \[(.*)\]", text)[1]
    assert "load" in filters and "bucket" in filters and "year" in filters and "In(code" in text and got.count() == 4
    scans = []
    write = HistoryStore._write
    monkeypatch.setattr(HistoryStore, "_write", lambda self, rows, load: (rows.explain("formatted"), scans.append(capsys.readouterr().out), write(self, rows, load)))
    store.add(frame(spark, rows_of(CODES, [D(2023, 1, 1)])))
    assert "/index/" in scans[0] and "/data" not in scans[0]


def test_deletes_touch_only_their_buckets(spark, store):
    store.add(frame(spark, rows_of(CODES, DAYS)))
    store.add(frame(spark, rows_of(CODES, [D(2022, 2, 1)])))
    before = files_of(store)
    gone = frame(spark, rows_of(["C1", "unknown"], DAYS)).select("code")
    bucket = store.index().where("code = 'C1'").first().bucket
    assert store.delete(gone) == 3 and store.delete(gone) == 3
    assert store.read().count() == 44 and store.index().count() == 11
    assert store.read(version=2).count() == 48  # readers of the version before are not disturbed
    after = files_of(store)
    assert before.items() <= after.items() and {re.search(r"bucket=(\d+)", f)[1] for f in set(after) - set(before)} <= {str(bucket)}
    assert store.vacuum(1) > 0 and store.read().count() == 44
    untouched = [f for f in before if f"bucket={bucket}/" not in f]
    assert untouched and all(files_of(store)[f] == before[f] for f in untouched)
    assert store.add(frame(spark, [("C1", D(2000, 1, 1), 1.0, 1)])).stored == 1  # a code that left is new again
    assert store.compact(1) and store.read().count() == 45 and store.vacuum(1) and store.read().count() == 45
    everything = store.index().select("code")
    store.delete(everything)
    assert store.read().count() == 0 and store.add(frame(spark, rows_of(["A"], DAYS))).stored == 3 and store.read().count() == 3


def test_refresh_lists_new_codes_and_reads_new_days_only(spark, scratch):
    store = HistoryStore(spark, scratch("named"), StructType.fromDDL("code string, name string, date date, price double"), buckets=2)
    manifest = scratch("manifest") + "/new.csv"
    prices = frame(spark, rows_of(["A", "B", "Z"], DAYS))
    listing = (lambda *codes: spark.createDataFrame([(c, f"{n} {c}") for c in codes for n in ("the", "a")], "code string, name string"))
    assert store_jobs.refresh_store_job(listing("A"), prices, store, manifest, start="2022-01-01").stored == 2
    assert store_jobs.refresh_store_job(listing("A", "B"), prices, store, manifest).stored == 3
    assert sorted(r.code for r in read_manifest(spark, manifest).collect()) == ["A", "B"]
    assert store_jobs.refresh_store_job(listing("A", "B"), prices, store, manifest).stored == 0
    assert sorted({(r.code, r.name) for r in store.read().collect()}) == [("A", "a A"), ("B", "a B")]


@pytest.mark.parametrize("broken", ["before", "rows", "objects", None])
def test_both_stores_lose_the_same_codes(spark, scratch, store, monkeypatch, broken):
    store.add(frame(spark, rows_of([*CODES, "^X"], DAYS)))
    objects, intents = scratch("objects"), scratch("intents")
    write_per_key(frame(spark, rows_of([*CODES, "^X", "only an object"], DAYS)), objects, fmt="parquet")
    keep = spark.createDataFrame([("C3",), ("^X",), (None,)], "code string")
    fault = lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost"))
    with monkeypatch.context() as m:
        if broken == "before":
            m.setattr(HistoryStore, "delete", fault)
        elif broken == "rows":
            m.setattr(store_jobs, "object_codes", lambda *a, f=store_jobs.object_codes, n=[]: n.append(1) or (fault() if len(n) > 1 else f(*a)))
        elif broken == "objects":
            drop = store_jobs.delete_path
            m.setattr(store_jobs, "delete_path", lambda s, p: fault() if "C7" in p else drop(s, p))
        if broken:
            with pytest.raises(RuntimeError):
                store_jobs.retention_stores_job(store, objects, keep, intents)
            assert len(child_names(spark, intents)) == 1
    applied = store_jobs.retention_stores_job(store, objects, keep, intents)
    assert len(applied) == 1 and child_names(spark, intents) == []
    assert sorted(r.code for r in store.index().collect()) == ["C3", "^X"] and store.read().count() == 6
    assert sorted(r.code for r in store_jobs.object_codes(spark, objects).collect()) == ["C3", "^X"]
    assert store_jobs.retention_stores_job(store, objects, keep, intents) == []
    assert store_jobs.retention_stores_job(store, objects, keep.where("false"), intents) == [] and store.read().count() == 6


def test_changes_by_days_equal_one_run(spark, scratch):
    schema = StructType.fromDDL("code string, date date, price double, prev_price double, change double")
    days = [(c, D(2024, 1, d), float((d * 7 + len(c) * d * d) % 11)) for c in ("A", "BB", "CCC") for d in range(1, 20) if (d + len(c)) % 4]
    series = spark.createDataFrame([*days, ("N", D(2024, 1, 3), None), ("N", D(2024, 1, 4), float("nan"))], "code string, date date, price double")
    whole = sorted(map(tuple, high_volatility(series, 5.0).collect()))
    assert len(whole) > 20
    for cuts in ([D(2024, 1, 31)], [D(2024, 1, 5), D(2024, 1, 9), D(2024, 1, 9), D(2024, 1, 31)], [D(2024, 1, d) for d in range(1, 20, 3)] + [D(2024, 1, 31)]):
        store = HistoryStore(spark, scratch("changes"), schema, buckets=2, carry=("price",))
        for cut in cuts:
            store_jobs.extend_changes(store, series.where(F.col("date") <= F.lit(cut)))
        assert sorted(map(tuple, store_jobs.volatile_days(store, 5.0).collect())) == whole


@pytest.mark.parametrize("cap", [None, 1, 2])
def test_stream_rows_do_not_hang_on_the_batch_size(spark, scratch, store, cap):
    store.add(frame(spark, [("B", D(2024, 1, 9), 1.0, 1)]))
    landing, checkpoint = scratch("in"), scratch("ckpt")
    drops = [[("A", D(2024, 1, 5), 1.0, 1), ("A", D(2024, 1, 5), 1.0, 1), ("B", D(2024, 1, 9), 1.0, 2)], [("A", D(2024, 1, 3), 2.0, 2), ("A", None, 2.0, 2)],
             [("A", D(2024, 1, 5), 1.0, 1), ("A", D(2024, 1, 4), 3.0, 3), (None, D(2024, 1, 4), 3.0, 3)], [("A", D(2024, 1, 5), None, 4), ("B", D(2024, 1, 10), 5.0, 5)]]
    for i, drop in enumerate(drops):
        frame(spark, drop).coalesce(1).write.mode("append").parquet(f"{landing}/{i}")
    options = {"maxFilesPerTrigger": cap} if cap else {}
    for _ in range(2):
        stream_into_store(spark, landing, store, checkpoint, **options)
    want = [("A", 3, 2.0, 2), ("A", 4, 3.0, 3), ("A", 5, None, 4), ("A", 5, 1.0, 1), ("B", 9, 1.0, 1), ("B", 10, 5.0, 5)]
    got = (lambda: sorted(((r.code, r.date.day, r.price, r.row_key) for r in store.read().collect()), key=str))
    assert got() == sorted(want, key=str) and store.rejects().count() == 2
    # Equal to a row that an earlier run took, and newer than none: not stored. A code that left is new again.
    store.delete(frame(spark, [("A", None, None, None)]).select("code"))
    frame(spark, [("A", D(2024, 1, 5), 1.0, 1), ("B", D(2024, 1, 10), 5.0, 5)]).coalesce(1).write.parquet(f"{landing}/again")
    stream_into_store(spark, landing, store, checkpoint, **options)
    assert got() == sorted([("A", 5, 1.0, 1), *want[4:]], key=str)


def test_a_replayed_micro_batch_adds_nothing(spark, scratch, store, monkeypatch):
    landing, checkpoint = scratch("in"), scratch("ckpt")
    frame(spark, rows_of(["A"], DAYS)).coalesce(1).write.parquet(f"{landing}/1")
    add = HistoryStore.add

    def lost(self, batch, **kw):
        add(self, batch, **kw)
        raise RuntimeError("lost after the commit")

    with monkeypatch.context() as m:
        m.setattr(HistoryStore, "add", lost)
        with pytest.raises(Exception):
            stream_into_store(spark, landing, store, checkpoint)
    assert store.read().count() == 3
    stream_into_store(spark, landing, store, checkpoint)
    assert store.read().count() == 3 and store.version() == 1


def test_manifest_is_not_touched_without_new_codes(spark, scratch):
    path = scratch("m") + "/new.csv"
    assert not write_manifest(spark.createDataFrame([], "code string"), path)
    assert read_manifest(spark, path) is None
