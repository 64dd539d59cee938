"""Scalar helpers: codes, dates, decimals, paths, maps, JSON."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from marketlake import functions as mf


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_zfill_pads_and_never_truncates(spark):
    r = one(spark, mf.zfill(F.lit("5930")).alias("a"), mf.zfill(F.lit("1234567")).alias("b"),
            mf.zfill(F.lit(5930)).alias("c"), mf.zfill(F.lit("005930")).alias("d"))
    assert (r.a, r.b, r.c, r.d) == ("005930", "1234567", "005930", "005930")


def test_int_code(spark):
    r = one(spark, mf.int_code(F.lit(5930)).alias("a"), mf.int_code(F.lit("660")).alias("b"))
    assert (r.a, r.b) == ("005930", "000660")


def test_strip_quotes(spark):
    assert one(spark, mf.strip_quotes(F.lit("""'Berkshire "B" Hathaway'""")).alias("a")).a == "Berkshire B Hathaway"


def test_year_and_date_parsing(spark):
    r = one(
        spark,
        mf.parse_year(F.lit("1997")).alias("y"),
        mf.parse_year(F.lit("19x7")).alias("bad"),
        mf.to_date_or_null(F.lit("2024-01-02")).alias("d"),
        mf.to_date_or_null(F.lit("not a date")).alias("nd"),
        mf.stat_time(F.lit(dt.date(2024, 1, 2))).alias("t"),
        mf.stat_time(F.lit(dt.date(2024, 1, 2)), "A").alias("ty"),
        mf.date_text(F.lit(dt.date(2024, 1, 2))).alias("dt"),
    )
    assert r.y == dt.date(1997, 1, 1) and r.bad is None
    assert r.d == dt.date(2024, 1, 2) and r.nd is None
    assert (r.t, r.ty, r.dt) == ("20240102", "2024", "2024-01-02")


def test_decimal_half_up_and_overflow_to_null(spark):
    r = one(
        spark,
        mf.to_decimal_or_null(F.lit("12.345")).alias("a"),
        mf.to_decimal_or_null(F.lit("-12.345")).alias("b"),
        mf.to_decimal_or_null(F.lit("1234567.891")).alias("c"),
        mf.to_decimal_or_null(F.lit("abc")).alias("d"),
    )
    assert (r.a, r.b, r.c, r.d) == (Decimal("12.35"), Decimal("-12.35"), None, None)


def test_paths_and_uris(spark):
    r = one(
        spark,
        mf.key_from_path(F.lit("s3://lake/history/AAPL.csv")).alias("flat"),
        mf.key_from_path(F.lit("file:/x/hist/code=005930/part-0000.csv")).alias("hive"),
        mf.key_from_path(F.lit("s3://b/p/readme.txt")).alias("other"),
        mf.uri_bucket(F.lit("s3://my-bucket/raw/rates/daily.csv")).alias("bucket"),
        mf.uri_key(F.lit("s3://my-bucket/raw/rates/daily.csv")).alias("key"),
        mf.file_stem(F.lit("/data/Processed_rates.csv")).alias("stem"),
        mf.strip_prefix(F.lit("Processed_rates"), "Processed_").alias("np"),
        mf.strip_suffix(F.lit("public.t1.csv.gz"), ".csv.gz").alias("ns"),
        mf.object_path("history/", F.lit("AAPL")).alias("obj"),
    )
    assert (r.flat, r.hive, r.other) == ("AAPL", "005930", None)
    assert (r.bucket, r.key) == ("my-bucket", "raw/rates/daily.csv")
    assert (r.stem, r.np, r.ns, r.obj) == ("Processed_rates", "rates", "public.t1", "history/AAPL.csv")


def test_map_lookup_default(spark):
    m = {"NMS": "NAS", "NYQ": "NYS"}
    r = one(spark, mf.map_lookup(F.lit("NMS"), m, "baddata").alias("a"),
            mf.map_lookup(F.lit("PCX"), m, "baddata").alias("b"),
            mf.map_lookup(F.lit(None).cast("string"), m, "baddata").alias("c"))
    assert (r.a, r.b, r.c) == ("NAS", "baddata", "baddata")


def test_json_field(spark):
    r = one(spark, mf.json_field(F.lit('{"k": 69}'), "$.k", "bigint").alias("a"),
            mf.json_field(F.lit("{}"), "$.k", "bigint").alias("b"),
            mf.json_field(F.lit("not json"), "$.k").alias("c"))
    assert (r.a, r.b, r.c) == (69, None, None)


def test_avro_record_schemas_agree():
    import json

    from marketlake.schemas import AVRO_HISTORY, AVRO_HISTORY_JSON, STAT_FIELDS, STAT_LONG, STAT_ROW_TEXT

    avro = json.loads(AVRO_HISTORY_JSON)["fields"]
    kinds = {"string": "string", "float": "float"}
    assert [f["name"] for f in avro] == [f.name for f in AVRO_HISTORY.fields]
    for a, s in zip(avro, AVRO_HISTORY.fields):
        declared = a["type"] if isinstance(a["type"], list) else [a["type"]]
        assert ("null" in declared) == s.nullable
        assert kinds[[t for t in declared if t != "null"][0]] == s.dataType.simpleString()
    assert [f.name for f in STAT_ROW_TEXT.fields] == STAT_FIELDS == [f.name for f in STAT_LONG.fields]
