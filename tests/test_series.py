"""Macro series presets end to end: landed JSON responses -> wide tables."""

import datetime as dt
import json
import os

from marketlake.plans import series
from marketlake.session import scratch_path
from marketlake.sources.statistics import read_statistics, to_stat_long


def _land(spark, docs):
    d = scratch_path(spark, "responses")
    os.makedirs(d[len("file:"):] if d.startswith("file:") else d, exist_ok=True)
    for name, rows in docs.items():
        with open(os.path.join(d[len("file:"):] if d.startswith("file:") else d, name), "w", encoding="utf-8") as f:
            json.dump({"StatisticSearch": {"list_total_count": len(rows), "row": rows}}, f, ensure_ascii=False)
    return d


def r(time, item, value, item2=None, item3=None):
    row = {"STAT_CODE": "X", "ITEM_NAME1": item, "TIME": time, "DATA_VALUE": value}
    if item2:
        row["ITEM_NAME2"] = item2
    if item3:
        row["ITEM_NAME3"] = item3
    return row


def test_exchange_rate_first_in_response_order(spark):
    rows = [
        r("20240102", "원/달러(종가 15:30)", "1300.5"),
        r("20240102", "원/달러(종가 15:30)", "1301.0"),
        r("20240102", "원/위안(종가)", None),
        r("20240102", "원/위안(종가)", "182.4"),
        r("20240102", "원/엔(기타)", "9.1"),
        r("20240103", "원/100엔(하나은행고시)", "890.0"),
    ]
    long = to_stat_long(read_statistics(spark, _land(spark, {"ExchangeRate.json": rows})))
    out = {x.TIME: x.asDict() for x in series.exchange_rate(long).collect()}
    assert list(series.exchange_rate(long).columns) == ["TIME", "100엔", "달러", "위안"]
    assert out["20240102"] == {"TIME": "20240102", "100엔": None, "달러": 1300.5, "위안": 182.4}
    assert out["20240103"]["100엔"] == 890.0


def test_interest_rates_fixed_columns(spark):
    rows = [r("20240102", "국고채(10년)", "3.4"), r("20240102", "콜금리(1일, 전체거래)", "3.25"),
            r("20240102", "기타금리", "9.9")]
    long = to_stat_long(read_statistics(spark, _land(spark, {"a.json": rows})))
    wide = series.interest_rates(long)
    assert wide.columns == ["TIME"] + series.INTEREST_RATE_ITEMS
    row = wide.first()
    assert row["국고채(10년)"] == 3.4 and row["KOFR(공시 RFR)"] is None


def test_gdp_per_country_from_files(spark):
    d = _land(spark, {"KOR.json": [r("2000", "GDP", "1.5"), r("2001", "GDP", None)],
                      "JPN.json": [r("2000", "GDP", "4.0"), r("2000", "GDP", "1.0")]})
    long = series.country_from_file(to_stat_long(read_statistics(spark, d)))
    got = {(x.country, x.Date): x.GDP for x in series.gdp(long).collect()}
    assert got == {("Korea", "2000"): 1.5, ("Korea", "2001"): 0.0, ("Japan", "2000"): 5.0}


def test_statements_overlapping_fetches(spark):
    part1 = [r("1999", "매출액", "1.0", "제조업", "대기업"), r("2000", "매출액", "2.0", "제조업", "대기업")]
    part2 = [r("2000", "매출액", "2.0", "제조업", "대기업"), r("2001", "매출액", "3.0", "제조업", None)]
    long = to_stat_long(read_statistics(spark, _land(spark, {"p1.json": part1, "p2.json": part2})))
    wide = series.financial_statements(long)
    assert wide.columns == ["Date", "매출액|제조업|대기업"]
    assert {x.Date: x[1] for x in wide.collect()} == {dt.date(1999, 1, 1): 1.0, dt.date(2000, 1, 1): 2.0}


def test_kospi_and_sentiment(spark):
    rows = [r("20240102", "KOSPI", "2600.1"), r("20240102", "KOSDAQ", "870.2"), r("20240103", "KOSPI", "2610.0")]
    long = to_stat_long(read_statistics(spark, _land(spark, {"k.json": rows})))
    assert series.kospi(long).columns == ["TIME", "KOSDAQ", "KOSPI"]
    assert series.news_sentiment(long).columns == ["TIME", "NewsSentiment"]


def test_macro_job_end_to_end_with_punctuated_korean_columns(spark):
    from marketlake.plans import jobs

    rows = [r("20240102", n, str(i + 1.5)) for i, n in enumerate(series.INTEREST_RATE_ITEMS)]
    rows.append(r("20240102", "기타금리", "99.0"))  # not listed: filtered out
    long = to_stat_long(read_statistics(spark, _land(spark, {"rates.json": rows})))
    name = "rates_" + os.urandom(4).hex()
    table = jobs.macro_wide_job(long, scratch_path(spark, "raw"), scratch_path(spark, "csv"), name,
                                scratch_path(spark, "tables"), order=list(series.DEFAULT_ORDER),
                                items=series.INTEREST_RATE_ITEMS)
    assert table.columns == ["TIME"] + series.INTEREST_RATE_ITEMS
    row = table.first()
    assert row["콜금리(1일, 전체거래)"] == 7.5 and row["회사채(3년, BBB-)"] == 10.5
    # a rerun of the same day reloads, it does not append
    again = jobs.macro_wide_job(long, scratch_path(spark, "raw"), scratch_path(spark, "csv"), name,
                                scratch_path(spark, "tables"), order=list(series.DEFAULT_ORDER),
                                items=series.INTEREST_RATE_ITEMS)
    assert again.count() == 1


def test_volatility_job_with_ticker_codes(spark):
    from marketlake.plans import jobs

    ranked = spark.createDataFrame([(1, "AAPL"), (2, "MSFT"), (3, "NVDA"), (4, "TSLA")], "ranking int, code string")
    hist = spark.createDataFrame(
        [("AAPL", dt.date(2024, 1, 2), 100.0, 1), ("AAPL", dt.date(2024, 1, 3), 110.0, 2),
         ("TSLA", dt.date(2024, 1, 2), 10.0, 3), ("TSLA", dt.date(2024, 1, 3), 20.0, 4)],
        "code string, date date, price double, row_key long")
    out = jobs.top_volatility_job(ranked, hist, "vol_" + os.urandom(4).hex(), scratch_path(spark, "tables"),
                                  k=3, threshold_pct=5.0, code_width=None)
    assert [(r.code, round(r.change, 6)) for r in out.collect()] == [("AAPL", 10.0)]  # TSLA is not in the top 3


def test_macro_job_rerun_from_raw_zone(spark):
    from marketlake.plans import jobs

    rows = [r("20240102", "원/달러(종가 15:30)", "1300.5"), r("20240102", "원/위안(종가)", "182.4")]
    long = to_stat_long(read_statistics(spark, _land(spark, {"fx.json": rows})))
    raw = scratch_path(spark, "raw")
    root, name = scratch_path(spark, "tables"), "fx_" + os.urandom(4).hex()
    jobs.macro_wide_job(long, raw, scratch_path(spark, "csv"), name, root, list(series.DEFAULT_ORDER),
                        columns=series.EXCHANGE_RATE_COLUMNS)
    from_raw = spark.read.parquet(raw)  # a later rerun starts from the landed raw zone
    out = jobs.macro_wide_job(from_raw, None, scratch_path(spark, "csv"), name, root, list(series.DEFAULT_ORDER),
                              columns=series.EXCHANGE_RATE_COLUMNS)
    assert [(x["달러"], x["위안"]) for x in out.collect()] == [(1300.5, 182.4)]
