"""Ranking, exchange codes, zip, history maintenance and volatility on fixtures."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketlake.operators.history import (
    append_incremental,
    incremental_rows,
    latest_date,
    latest_row,
    retention_split,
    split_known,
)
from marketlake.operators.ranking import attach_exchange, first_k_codes, rank_top, zip_lists
from marketlake.operators.volatility import daily_first_price, high_volatility

D = dt.date


def test_rank_top_ranks_and_ties(spark):
    df = spark.createDataFrame([("a", 5.0), ("b", 9.0), ("c", 5.0), ("d", 1.0), ("e", None)], "code string, m double")
    r = [tuple(x) for x in rank_top(df, 3, "m", "code").select("ranking", "code").orderBy("ranking").collect()]
    assert r == [(1, "b"), (2, "a"), (3, "c")]
    assert dict(rank_top(df, 3, "m", "code").dtypes)["ranking"] == "int"
    assert [x.code for x in first_k_codes(rank_top(df, 5, "m", "code"), 2).collect()] == ["b", "a"]


def test_rank_top_shorter_list_is_fine(spark):
    df = spark.createDataFrame([("a", 1.0)], "code string, m double")
    assert rank_top(df, 100, "m", "code").count() == 1  # no fixed 1..100


def test_zip_lists(spark):
    page = spark.createDataFrame([(["Apple", "Microsoft"], ["AAPL", "MSFT"])], "names array<string>, codes array<string>")
    rows = [tuple(r) for r in zip_lists(page, "names", "codes").collect()]
    assert rows == [(1, "Apple", "AAPL"), (2, "Microsoft", "MSFT")]
    bad = spark.createDataFrame([(["A", "B"], ["X"])], "names array<string>, codes array<string>")
    with pytest.raises(Exception):
        zip_lists(bad, "names", "codes").collect()


def test_attach_exchange_baddata_cases(spark):
    listing = spark.createDataFrame([(1, "AAPL"), (2, "BRK"), (3, "TSM")], "ranking int, code string")
    meta = spark.createDataFrame([("AAPL", "NMS"), ("BRK", "NYQ"), ("ZZZ", "NMS")], "code string, exchange string")
    meta = meta.union(spark.createDataFrame([("TSM", "PCX")], "code string, exchange string"))
    out = {r.code: r.excode for r in attach_exchange(listing, meta).collect()}
    assert out == {"AAPL": "NAS", "BRK": "NYS", "TSM": "baddata"}
    no_meta = spark.createDataFrame([(4, "NEW")], "ranking int, code string")
    assert attach_exchange(no_meta, meta).first().excode == "baddata"


@pytest.fixture()
def stored(spark):
    return spark.createDataFrame(
        [("005930", D(2024, 1, 2), 1.0, 1), ("005930", D(2024, 1, 3), 2.0, 2), ("000660", D(2024, 1, 2), 3.0, 3)],
        "code string, date date, price double, row_key long",
    )


@pytest.fixture()
def incoming(spark):
    return spark.createDataFrame(
        [
            ("005930", D(2024, 1, 3), 2.0, 2),  # already stored day: rejected (strict >)
            ("005930", D(2024, 1, 4), 2.5, 4),
            ("000660", D(2024, 1, 1), 2.9, 5),  # older than stored: rejected
            ("035720", D(2024, 1, 4), 9.0, 6),  # unknown code: backfilled
        ],
        "code string, date date, price double, row_key long",
    )


def test_incremental_append_is_idempotent(stored, incoming):
    once = append_incremental(stored, incoming)
    twice = append_incremental(once, incoming)
    assert sorted(r.row_key for r in once.collect()) == [1, 2, 3, 4, 6]
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_incremental_order_independent(stored, incoming):
    a = incremental_rows(stored, incoming).collect()
    b = incremental_rows(stored, incoming.orderBy(F.desc("date")).repartition(3)).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_split_known_partitions_candidates(spark, stored):
    cands = spark.createDataFrame([("005930",), ("035720",), ("000660",)], "code string")
    known, new = split_known(cands, stored)
    k, n = {r.code for r in known.collect()}, {r.code for r in new.collect()}
    assert k == {"005930", "000660"} and n == {"035720"} and not (k & n)


def test_latest(stored, spark):
    assert {r.code: r.last_date for r in latest_date(stored).collect()} == {"005930": D(2024, 1, 3),
                                                                            "000660": D(2024, 1, 2)}
    tie = stored.union(spark.createDataFrame([("005930", D(2024, 1, 3), 7.0, 9)], stored.schema))
    row = {r.code: r for r in latest_row(tie, "code", ["date", "row_key"]).collect()}
    assert row["005930"].row_key == 9 and row["005930"].price == 7.0


def test_retention_split_is_a_partition(spark, stored):
    keep = spark.createDataFrame([("005930",)], "code string")
    kept, dropped = retention_split(stored, keep)
    assert kept.count() + dropped.count() == stored.count()
    assert {r.code for r in kept.collect()} == {"005930"} and {r.code for r in dropped.collect()} == {"000660"}


def test_volatility_rule(spark):
    rows = [
        ("A", D(2024, 1, 1), 100.0),  # first day: no change, never kept
        ("A", D(2024, 1, 2), 105.0),  # exactly +5 %: kept
        ("A", D(2024, 1, 5), 104.0),  # gap: compared with the previous stored day
        ("A", D(2024, 1, 6), 93.6),  # -10 %: kept
        ("B", D(2024, 1, 1), 10.0),
    ]
    s = spark.createDataFrame(rows, "code string, date date, price double")
    out = {(r.code, r.date): r.change for r in high_volatility(s, 5.0).collect()}
    assert set(out) == {("A", D(2024, 1, 2)), ("A", D(2024, 1, 6))}
    assert abs(out[("A", D(2024, 1, 6))] + 10.0) < 1e-9


def test_daily_first_price(spark):
    raw = spark.createDataFrame(
        [("A", dt.datetime(2024, 1, 1, 15), 2.0, 2), ("A", dt.datetime(2024, 1, 1, 9), 1.0, 1),
         ("A", dt.datetime(2024, 1, 2, 9), None, 3)],
        "code string, ts timestamp, price double, k long",
    )
    out = [tuple(r) for r in daily_first_price(raw, "code", "ts", "price", ["k"]).collect()]
    assert out == [("A", D(2024, 1, 1), 1.0)]
