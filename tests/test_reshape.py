"""Pivot / group-sum / union semantics on hand-written fixtures (Korean item names)."""

import pytest

from marketlake.operators.reshape import (
    group_sum,
    pivot_composite,
    pivot_first,
    rename_positional,
    select_rename,
    union_all,
    union_dedup,
)

USD = "원/달러(종가 15:30)"
CNY = "원/위안(종가)"
JPY = "원/100엔(하나은행고시)"
CALL = "콜금리(1일, 전체거래)"

LONG = [
    # TIME, ITEM_NAME1, DATA_VALUE, seq
    ("20240102", USD, 1300.5, 1),
    ("20240102", USD, 1301.0, 2),  # duplicate cell: first in order wins
    ("20240102", CNY, None, 3),  # first non-null wins (182.4 later)
    ("20240102", CNY, 182.4, 4),
    ("20240103", JPY, None, 5),  # only value of the day is null: the row vanishes
    ("20240104", CALL, 3.25, 6),
    (None, USD, 1299.0, 7),  # null key: dropped
]


@pytest.fixture()
def long(spark):
    return spark.createDataFrame(LONG, "TIME string, ITEM_NAME1 string, DATA_VALUE double, seq long")


def test_pivot_first_nonnull_in_order(long):
    out = {r["TIME"]: r.asDict() for r in pivot_first(long, "TIME", "ITEM_NAME1", "DATA_VALUE", "seq").collect()}
    assert set(out) == {"20240102", "20240104"}  # all-null day and null key gone
    assert out["20240102"][USD] == 1300.5
    assert out["20240102"][CNY] == 182.4
    assert out["20240104"][CALL] == 3.25


def test_pivot_inferred_columns_sorted_and_all_null_columns_vanish(long):
    wide = pivot_first(long, "TIME", "ITEM_NAME1", "DATA_VALUE", "seq")
    assert wide.columns == ["TIME"] + sorted([USD, CNY, CALL])  # JPY had no value at all


def test_pivot_order_independent_of_input_order(long, spark):
    shuffled = long.orderBy("DATA_VALUE").repartition(3)
    a = pivot_first(long, "TIME", "ITEM_NAME1", "DATA_VALUE", "seq").collect()
    b = pivot_first(shuffled, "TIME", "ITEM_NAME1", "DATA_VALUE", "seq").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_pivot_fixed_values_keep_absent_columns(long):
    wide = pivot_first(long, "TIME", "ITEM_NAME1", "DATA_VALUE", "seq", values=[USD, "국고채(10년)"])
    assert wide.columns == ["TIME", USD, "국고채(10년)"]
    rows = {r["TIME"]: r for r in wide.collect()}
    assert rows["20240104"][USD] is None  # row exists (CALL had a value), selected column empty
    assert all(r["국고채(10년)"] is None for r in rows.values())


def test_select_and_positional_rename(long):
    wide = pivot_first(long, "TIME", "ITEM_NAME1", "DATA_VALUE", "seq", values=[JPY, USD, CNY])
    out = rename_positional(wide, ["TIME", "100엔", "달러", "위안"])
    assert out.columns == ["TIME", "100엔", "달러", "위안"]
    with pytest.raises(ValueError):
        rename_positional(wide, ["TIME", "x"])
    assert select_rename(long, {"TIME": "TIME", "DATA_VALUE": "NewsSentiment"}).columns == ["TIME", "NewsSentiment"]


def test_pivot_composite_drops_rows_with_null_parts(spark):
    rows = [
        ("2000", "매출액", "제조업", "대기업", 1.0, 1),
        ("2000", "매출액", "제조업", None, 2.0, 2),  # null part: dropped
        ("2000", "매출액", "제조업", "대기업", 9.0, 3),  # overlap duplicate: first wins
        ("2010", "매출액", "제조업", "대기업", 3.0, 4),
    ]
    df = spark.createDataFrame(rows, "TIME string, A string, B string, C string, DATA_VALUE double, seq long")
    wide = pivot_composite(df, "TIME", ["A", "B", "C"], "DATA_VALUE", "seq")
    assert wide.columns == ["TIME", "매출액|제조업|대기업"]
    assert {r["TIME"]: r[1] for r in wide.collect()} == {"2000": 1.0, "2010": 3.0}


def test_group_sum_pandas_semantics(spark):
    df = spark.createDataFrame(
        [("2000", 1.5), ("2000", None), ("2001", None), (None, 7.0), ("2002", 0.1), ("2002", 0.2)],
        "TIME string, DATA_VALUE double",
    )
    out = {r["TIME"]: r["GDP"] for r in group_sum(df, "TIME", "DATA_VALUE", "GDP", decimal_scale=4).collect()}
    assert out == {"2000": 1.5, "2001": 0.0, "2002": 0.3}  # exact, all-null -> 0, null key dropped


def test_union_by_name_and_overlap_dedup(spark):
    a = spark.createDataFrame([("1999", 1.0), ("2000", 2.0)], "TIME string, v double")
    b = spark.createDataFrame([(2.0, "2000"), (3.0, "2001")], "v double, TIME string")
    assert union_all([a, b]).count() == 4
    assert sorted(r["TIME"] for r in union_dedup([a, b]).collect()) == ["1999", "2000", "2001"]
    c = spark.createDataFrame([("2002",)], "TIME string")
    assert union_all([a, c]).where("TIME = '2002'").first()["v"] is None


def test_wide_pivot_path_agrees_with_single_pass(spark):
    from pyspark.sql import functions as F

    from marketlake.operators.reshape import SINGLE_PASS_MAX_VALUES

    n = SINGLE_PASS_MAX_VALUES + 6
    df = spark.range(0, 2000).select(
        (F.col("id") % 7).cast("string").alias("TIME"),
        F.concat(F.lit("k"), (F.col("id") % n).cast("string")).alias("ITEM_NAME1"),
        F.when(F.col("id") % 11 == 0, None).otherwise(F.col("id") * 0.5).alias("DATA_VALUE"),
        (2000 - F.col("id")).alias("seq"),
    )
    keys = [f"k{i}" for i in range(n)]
    wide = pivot_first(df, "TIME", "ITEM_NAME1", "DATA_VALUE", "seq", keys)  # Spark pivot path
    narrow = pivot_first(df, "TIME", "ITEM_NAME1", "DATA_VALUE", "seq", keys[:5])  # single pass
    a = sorted(tuple(r) for r in wide.select("TIME", *keys[:5]).collect())
    b = sorted(tuple(r) for r in narrow.collect())
    assert a == b


def test_union_ranges_first_fetch_wins_without_shuffle(spark, capsys):
    from marketlake.operators.reshape import union_ranges

    a = spark.createDataFrame([(1999, 1.0), (2000, 2.0)], "y int, v double")
    b = spark.createDataFrame([(2000, 20.0), (2001, 3.0)], "y int, v double")  # revised 2000 arrives later
    out = union_ranges([(a, 1990, 2000), (b, 2000, 2010)], "y")
    assert sorted(tuple(r) for r in out.collect()) == [(1999, 1.0), (2000, 2.0), (2001, 3.0)]
    out.explain()
    assert "Exchange" not in capsys.readouterr().out


def test_group_sum_large_values_with_wider_decimal(spark):
    df = spark.createDataFrame([("KOR", 2.2e15), ("KOR", 1.25)], "k string, v double")
    got = group_sum(df, "k", "v", "s", decimal_scale=4, decimal_precision=38).first()
    assert got.s == 2.2e15 + 1.25


def test_yearly_queries_keep_early_late_and_missing_dates(spark, scratch):
    from marketlake.plans import catalog

    folder = scratch("sf")
    rows = [(1, "1985-03-01"), (2, "1994-05-01"), (3, "2150-01-01"), (4, None), (5, "1997-07-07")]
    orders = spark.createDataFrame([(k, d, "O", "1-URGENT", 10.0 * k) for k, d in rows], "o_orderkey long, d string, o_orderstatus string, o_orderpriority string, o_totalprice double")
    orders.selectExpr("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice", "cast(d as date) o_orderdate").write.parquet(f"{folder}/orders.parquet")
    for name in ("union_overlap_dedup", "union_overlap_distinct"):
        got = [(r.seq, r.TIME) for r in catalog.queries()[name](spark, folder).collect()]
        assert sorted(got) == [(k, d and d[:4]) for k, d in rows], name
    for name in ("pivot_composite", "job_statements"):
        got = [str(r.Date)[:4] for r in catalog.queries()[name](spark, folder).collect()]
        assert sorted(got) == ["1985", "1994", "1997", "2150"], name
