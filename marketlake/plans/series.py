"""The macro series the jobs publish, as parameterisations of the reshape operators.

Input is a long statistics table (``STAT_LONG`` columns plus an order column,
e.g. ``read_statistics`` -> ``to_stat_long``, whose ``source_file, row_pos``
give the input order). Each function returns the wide table of that series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.functions import parse_year
from marketlake.operators.reshape import (
    filter_in,
    group_sum,
    pivot_composite,
    pivot_first,
    select_rename,
)

# Published item names and output columns of each series.
EXCHANGE_RATE_COLUMNS = {
    "원/100엔(하나은행고시)": "100엔",
    "원/달러(종가 15:30)": "달러",
    "원/위안(종가)": "위안",
}
INTEREST_RATE_ITEMS = [
    "KOFR(공시 RFR)",
    "KORIBOR(12개월)",
    "국고채(10년)",
    "국고채(2년)",
    "국고채(5년)",
    "콜금리(1일, 은행증권금융차입)",
    "콜금리(1일, 전체거래)",
    "콜금리(1일, 중개회사거래)",
    "회사채(3년, AA-)",
    "회사채(3년, BBB-)",
]
GDP_COUNTRIES = {
    "Korea": "KOR",
    "Japan": "JPN",
    "USA": "USA",
    "China": "CHN",
}
STATEMENT_KEYS = ["ITEM_NAME1", "ITEM_NAME2", "ITEM_NAME3"]

DEFAULT_ORDER = ("source_file", "row_pos")


def exchange_rate(long: DataFrame, order: Sequence[str] = DEFAULT_ORDER) -> DataFrame:
    """TIME, 100엔, 달러, 위안: pivot-first of the three rates, renamed."""
    wide = pivot_first(long, "TIME", "ITEM_NAME1", "DATA_VALUE", list(order), list(EXCHANGE_RATE_COLUMNS))
    return wide.select("TIME", *[F.col(f"`{k}`").alias(v) for k, v in EXCHANGE_RATE_COLUMNS.items()])


def interest_rates(long: DataFrame, order: Sequence[str] = DEFAULT_ORDER) -> DataFrame:
    """TIME + the ten listed rates (fixed columns; an absent item is an all-NULL column)."""
    kept = filter_in(long, "ITEM_NAME1", INTEREST_RATE_ITEMS)
    return pivot_first(kept, "TIME", "ITEM_NAME1", "DATA_VALUE", list(order), INTEREST_RATE_ITEMS)


def kospi(long: DataFrame, order: Sequence[str] = DEFAULT_ORDER, items: Sequence[str] | None = None) -> DataFrame:
    """TIME + one column per item (the sorted items present, unless ``items`` fixes them)."""
    return pivot_first(long, "TIME", "ITEM_NAME1", "DATA_VALUE", list(order), items)


def news_sentiment(long: DataFrame) -> DataFrame:
    """TIME, NewsSentiment: the series' values renamed."""
    return select_rename(long, {"TIME": "TIME", "DATA_VALUE": "NewsSentiment"})


def gdp(long: DataFrame, country_col: str = "country") -> DataFrame:
    """country, Date, GDP: yearly sum per country in one aggregation (NULLs
    ignored, an all-NULL year is 0, rows without TIME dropped)."""
    summed = group_sum(long, [country_col, "TIME"], "DATA_VALUE", "GDP")
    return summed.select(country_col, F.col("TIME").alias("Date"), "GDP")


def country_from_file(long: DataFrame, countries=GDP_COUNTRIES, file_col: str = "source_file") -> DataFrame:
    """Country of each GDP row from its response file name (``.../<CODE>.json`` or ``.../<country>.json``).

    A file of any other name is an error: its rows would be lost in the sum.
    """
    code = F.regexp_extract(F.col(file_col), r"([^/.]+)\.[^/]*$", 1)
    names = {v: k for k, v in countries.items()} | {k: k for k in countries}
    pairs = [x for kv in names.items() for x in (F.lit(kv[0]), F.lit(kv[1]))]
    found = F.try_element_at(F.create_map(*pairs), code)
    unknown = F.raise_error(F.concat(F.lit("no country is known for the file "), F.coalesce(F.col(file_col), F.lit("NULL"))))
    return long.withColumn("country", F.coalesce(found, unknown.cast("string")))


def financial_statements(long: DataFrame, order: Sequence[str] = DEFAULT_ORDER,
                         values: Sequence[Sequence[str]] | None = None) -> DataFrame:
    """Date (1 January of TIME) + one column per (name1|name2|name3); rows with a
    missing name part are dropped; overlapping yearly fetches collapse to the first."""
    dated = long.withColumn("Date", parse_year("TIME"))
    return pivot_composite(dated, "Date", STATEMENT_KEYS, "DATA_VALUE", list(order), values)
