"""Job-level fixtures: manifest loads (header-only file, code without history) and
CSV export round-trips of awkward values."""

import os
import uuid

from pyspark.sql.types import DateType, DecimalType, IntegerType, StringType, StructField, StructType

from marketlake.plans.jobs import manifest_load_job
from marketlake.session import scratch_path
from marketlake.sinks.files import write_gzip_csv
from marketlake.sinks.tables import create_if_absent
from marketlake.sources.files import path_exists, read_csv

TYPED = StructType([
    StructField("date", DateType()), StructField("name", StringType()),
    StructField("code", StringType()), StructField("open_value", DecimalType(8, 2)),
])


def _local(p):
    return p[len("file:"):] if p.startswith("file:") else p


def _write(path, name, text):
    os.makedirs(_local(path), exist_ok=True)
    with open(os.path.join(_local(path), name), "w", encoding="utf-8") as f:
        f.write(text)


def test_manifest_load_job(spark):
    hist = scratch_path(spark, "history")
    _write(hist, "AAPL.csv", ",Name,Code,Date,OpenValue\n0,Apple,AAPL,2024-01-02,185.555\n1,Apple,AAPL,bad,1.0\n")
    _write(hist, "MSFT.csv", ",Name,Code,Date,OpenValue\n")  # header only
    _write(hist, "TSLA.csv", ",Name,Code,Date,OpenValue\n0,Tesla,TSLA,2024-01-02,1234567.891\n")  # not listed
    manifest = scratch_path(spark, "manifest")
    _write(manifest, "new_history.csv", ",code\n0,AAPL\n1,MSFT\n2,NVDA\n")  # NVDA: no file at all
    name = f"h_{uuid.uuid4().hex[:8]}"
    create_if_absent(spark, name, TYPED, scratch_path(spark, "tables"))

    out = manifest_load_job(spark, manifest, hist, name)
    rows = sorted((r.code, str(r.date), str(r.open_value)) for r in out.collect())
    assert rows == [("AAPL", "2024-01-02", "185.56"), ("AAPL", "None", "1.00")]
    assert not path_exists(spark, manifest)  # deleted after the commit
    assert manifest_load_job(spark, manifest, hist, name).count() == 2  # no manifest: nothing to do

    _write(manifest, "new_history.csv", ",code\n0,AAPL\n")  # a replayed manifest adds nothing twice
    assert manifest_load_job(spark, manifest, hist, name).count() == 2


AWKWARD = StructType([
    StructField("id", IntegerType()), StructField("s", StringType()),
])


def test_export_roundtrip_of_awkward_values(spark):
    rows = [(1, "a,b"), (2, 'say "hi"'), (3, "two\nlines"), (4, None), (5, ""), (6, "원/달러(종가 15:30)")]
    df = spark.createDataFrame(rows, AWKWARD)
    p = scratch_path(spark, "export")
    write_gzip_csv(df, p)
    back = read_csv(spark, p, schema=AWKWARD, check_header=True, multiLine=True)
    assert sorted(back.collect(), key=lambda r: r.id) == sorted(df.collect(), key=lambda r: r.id)
    empty = scratch_path(spark, "export_empty")
    write_gzip_csv(df.limit(0), empty)
    assert read_csv(spark, empty, schema=AWKWARD).count() == 0
