"""Scans: statistic envelopes, CSV (BOM, Korean, quoting, leading zeros), listings, manifests."""

import json
import os

import pytest
from pyspark.sql.types import StringType, StructField, StructType

from marketlake.schemas import STAT_FIELDS
from marketlake.session import scratch_path
from marketlake.sources.files import drop_row_index, existing_keys, read_csv, read_manifest, read_parts
from marketlake.sources.statistics import parse_statistics, read_statistics, to_stat_long


def _local(p):
    return p[len("file:"):] if p.startswith("file:") else p


def _write(path, name, text, encoding="utf-8"):
    os.makedirs(_local(path), exist_ok=True)
    with open(os.path.join(_local(path), name), "w", encoding=encoding) as f:
        f.write(text)


ROW = {"STAT_CODE": "731Y003", "ITEM_NAME1": "원/달러(종가 15:30)", "TIME": "20240102", "DATA_VALUE": "1300.5",
       "EXTRA": "dropped"}  # no WGT


def test_envelope_rows(spark):
    docs = [
        (1, json.dumps({"StatisticSearch": {"list_total_count": 1, "row": [ROW, ROW]}})),
        (2, json.dumps({"RESULT": {"CODE": "INFO-200", "MESSAGE": "no data"}})),
        (3, "{}"),
        (4, json.dumps({"StatisticSearch": {"row": []}})),
    ]
    df = spark.createDataFrame(docs, "id long, doc string")
    rows = parse_statistics(df, "doc", keep=["id"])
    assert rows.columns == ["id"] + STAT_FIELDS  # exactly the 14 fields, extra dropped
    got = rows.collect()
    assert [r.id for r in got] == [1, 1]
    assert got[0]["WGT"] is None and got[0]["ITEM_NAME1"] == "원/달러(종가 15:30)"
    assert to_stat_long(rows).schema["DATA_VALUE"].dataType.simpleString() == "double"


def test_envelope_strict_raises(spark):
    df = spark.createDataFrame([(1, "{}")], "id long, doc string")
    with pytest.raises(Exception):
        parse_statistics(df, "doc", strict=True).collect()


def test_read_statistics_files(spark):
    d = scratch_path(spark, "responses")
    _write(d, "usd.json", json.dumps({"StatisticSearch": {"row": [ROW]}}, ensure_ascii=False))
    _write(d, "err.json", json.dumps({"RESULT": {"CODE": "ERROR-100"}}))
    rows = read_statistics(spark, d).collect()
    assert len(rows) == 1 and rows[0]["source_file"].endswith("usd.json")


def test_csv_bom_korean_quotes_and_leading_zeros(spark):
    d = scratch_path(spark, "csv")
    _write(d, "top.csv", 'CompanyName,CompanyCode\n삼성전자,005930\n"SK하이닉스, 우",000660\n', encoding="utf-8-sig")
    schema = StructType([StructField("CompanyName", StringType()), StructField("CompanyCode", StringType())])
    rows = read_csv(spark, d, schema=schema, check_header=True).collect()
    assert [tuple(r) for r in rows] == [("삼성전자", "005930"), ("SK하이닉스, 우", "000660")]
    # without a schema everything is text as well: codes keep their zeros
    assert read_csv(spark, d).first()["CompanyCode"] == "005930"


def test_csv_header_check_fails_on_mismatch(spark):
    d = scratch_path(spark, "csv")
    _write(d, "a.csv", "Name,Code\nx,1\n")
    schema = StructType([StructField("Code", StringType()), StructField("Name", StringType())])
    with pytest.raises(Exception):
        read_csv(spark, d, schema=schema, check_header=True).collect()


def test_row_index_column_dropped(spark):
    d = scratch_path(spark, "csv")
    _write(d, "h.csv", ",Date,Open\n0,2024-01-02,1.5\n1,2024-01-03,1.6\n")
    df = drop_row_index(read_csv(spark, d))
    assert df.columns == ["Date", "Open"] and df.count() == 2


def test_existing_keys_from_object_names(spark):
    d = scratch_path(spark, "objects")
    _write(d, "005930.csv", "a\n1\n")
    _write(d, "AAPL.csv", "a\n1\n")
    _write(d, "readme.txt", "skip me")
    assert sorted(r.code for r in existing_keys(spark, d).collect()) == ["005930", "AAPL"]


def test_manifest_absent_and_present(spark):
    d = scratch_path(spark, "manifest")
    assert read_manifest(spark, d) is None
    _write(d, "new_history.csv", ",code\n0,AAPL\n1,MSFT\n")
    assert sorted(r.code for r in read_manifest(spark, d).collect()) == ["AAPL", "MSFT"]


def test_read_parts_fan_in(spark):
    a, b = scratch_path(spark, "p"), scratch_path(spark, "p")
    spark.createDataFrame([(1, "x")], "id long, s string").write.parquet(a)
    spark.createDataFrame([("y", 2)], "s string, id long").write.parquet(b)
    assert sorted(tuple(r) for r in read_parts(spark, [a, b]).select("id", "s").collect()) == [(1, "x"), (2, "y")]


def test_pandas_written_csv_doubled_quotes(spark):
    import pandas as pd

    d = scratch_path(spark, "pandas_csv")
    os.makedirs(_local(d), exist_ok=True)
    pd.DataFrame({"name": ['Berkshire "B"', "a,b", None], "code": ["005930", "000660", "035720"]}).to_csv(
        os.path.join(_local(d), "top.csv"), index=False, encoding="utf-8-sig")
    schema = StructType([StructField("name", StringType()), StructField("code", StringType())])
    rows = [tuple(r) for r in read_csv(spark, d, schema=schema, check_header=True).collect()]
    assert rows == [('Berkshire "B"', "005930"), ("a,b", "000660"), (None, "035720")]


def test_read_statistics_json_lines(spark):
    d = scratch_path(spark, "responses_jsonl")
    lines = [json.dumps({"StatisticSearch": {"row": [ROW]}}, ensure_ascii=False),
             json.dumps({"RESULT": {"CODE": "INFO-200"}}),
             json.dumps({"StatisticSearch": {"row": [ROW, ROW]}}, ensure_ascii=False)]
    _write(d, "day.jsonl", "\n".join(lines) + "\n")
    rows = read_statistics(spark, d, json_lines=True).collect()
    assert len(rows) == 3 and {r.row_pos for r in rows} == {0, 1}
    assert all(r.WGT is None and r.ITEM_NAME1 == "원/달러(종가 15:30)" for r in rows)
    with pytest.raises(Exception):
        read_statistics(spark, d, json_lines=True, strict=True).collect()  # the error line fails strict mode
