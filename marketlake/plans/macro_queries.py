"""Macro-series queries: statistic envelopes, pivots, grouped sums, unions."""

from __future__ import annotations

from itertools import product

from pyspark.sql import functions as F

from marketlake.functions import json_field, map_lookup, parse_year, stat_time
from marketlake.operators.common import broadcast_if_bounded
from marketlake.operators.reshape import (
    filter_in,
    group_sum,
    pivot_composite,
    pivot_first,
    rename_positional,
    select_rename,
    union_all,
    union_dedup,
    union_first_wins,
)
from marketlake.plans import series
from marketlake.plans.catalog import register
from marketlake.plans.standins import (
    CUTOFF,
    EVENT_TYPES,
    MISSING_VALUE_SQL,
    ORDER_PRIORITIES,
    ORDER_STATUSES,
    pivot_sql,
    price_history,
    stat_long,
)
from marketlake.session import read_table
from marketlake.sources.statistics import parse_statistics

DAY_SQL = "strftime(ts, '%Y%m%d')"

# ----------------------------------------------------------------- pivots


@register("pivot_wide", pivot_sql(DAY_SQL, "event_type", "value", "event_id", EVENT_TYPES, "events",
                                  "ts IS NOT NULL"))
def pivot_wide(spark, sf_dir):
    """A3: long statistics -> TIME x item, first non-null value by input order."""
    return pivot_first(stat_long(spark, sf_dir), "TIME", "ITEM_NAME1", "DATA_VALUE", "event_id", EVENT_TYPES)


SELECTED = ["purchase", "signup", "view"]
RENAMED = ["TIME", "v_purchase", "v_signup", "v_view"]


@register(
    "pivot_select_rename",
    "SELECT \"TIME\", purchase AS v_purchase, signup AS v_signup, \"view\" AS v_view FROM ("
    + pivot_sql(DAY_SQL, "event_type", "value", "event_id", EVENT_TYPES, "events", "ts IS NOT NULL")
    + ") p",
)
def pivot_select_rename(spark, sf_dir):
    """A3 + P1 + P3: pivot everything, keep three items, rename by position."""
    wide = pivot_first(stat_long(spark, sf_dir), "TIME", "ITEM_NAME1", "DATA_VALUE", "event_id", EVENT_TYPES)
    return rename_positional(wide.select("TIME", *SELECTED), RENAMED)


FILTER_ITEMS = ["click", "purchase", "view"]


@register(
    "pivot_filtered",
    pivot_sql(DAY_SQL, "event_type", MISSING_VALUE_SQL, "event_id", FILTER_ITEMS, "events",
              "ts IS NOT NULL AND event_type IN ('click', 'purchase', 'view')"),
)
def pivot_filtered(spark, sf_dir):
    """F1 + A3: keep the listed items, then pivot; missing values never win "first"."""
    long = filter_in(stat_long(spark, sf_dir, with_missing=True), "ITEM_NAME1", FILTER_ITEMS)
    return pivot_first(long, "TIME", "ITEM_NAME1", "DATA_VALUE", "event_id", FILTER_ITEMS)


COMPOSITE_VALUES = list(product(ORDER_STATUSES, ORDER_PRIORITIES))
# Four overlapping yearly ranges (boundary years are in two parts each), open at
# both ends (None); rows without a date come with the first.
YEAR_RANGES = [(None, 1994), (1994, 1996), (1996, 1998), (1998, None)]


def _composite_sql() -> str:
    cols = ",\n  ".join(
        f"arg_min(o_totalprice, o_orderkey) FILTER (WHERE o_orderstatus = '{s}' AND o_orderpriority = '{p}') "
        f"AS \"{s}|{p}\""
        for s, p in COMPOSITE_VALUES
    )
    return (
        f"SELECT make_date(CAST(year(o_orderdate) AS INTEGER), 1, 1) AS \"Date\",\n  {cols}\nFROM orders\n"
        "WHERE o_totalprice IS NOT NULL AND o_orderstatus IS NOT NULL AND o_orderpriority IS NOT NULL\n"
        "  AND o_orderdate IS NOT NULL\nGROUP BY 1"
    )


def yearly_statements(spark, sf_dir):
    """Orders as yearly statements; ``__d`` (the date) carries the fetch ranges."""
    return read_table(spark, sf_dir, "orders").select(
        stat_time("o_orderdate", "A").alias("TIME"),
        F.col("o_orderstatus").alias("ITEM_NAME1"),
        F.col("o_orderpriority").alias("ITEM_NAME2"),
        F.col("o_totalprice").alias("DATA_VALUE"),
        F.col("o_orderkey").alias("seq"),
        F.to_date("o_orderdate").alias("__d"),
    )


def year_range(lo: int | None, hi: int | None):
    """Years ``lo..hi`` inclusive (None: open), on the date column (pushed to the scan)."""
    d = F.col("__d")
    if lo is None:
        return d.isNull() | (d <= F.lit(f"{hi}-12-31").cast("date"))
    if hi is None:
        return d >= F.lit(f"{lo}-01-01").cast("date")
    return d.between(F.lit(f"{lo}-01-01").cast("date"), F.lit(f"{hi}-12-31").cast("date"))


def yearly_statement_parts(spark, sf_dir):
    """Orders as yearly statements fetched in four overlapping ranges (U2 input)."""
    o = yearly_statements(spark, sf_dir)
    return [o.where(year_range(lo, hi)).drop("__d") for lo, hi in YEAR_RANGES]


@register("pivot_composite", _composite_sql())
def pivot_composite_q(spark, sf_dir):
    """E2 core: U2 (overlapping parts, no de-dup) -> X1 (year -> date) -> A4 composite pivot."""
    stmts = union_all(yearly_statement_parts(spark, sf_dir)).withColumn("Date", parse_year("TIME"))
    return pivot_composite(stmts, "Date", ["ITEM_NAME1", "ITEM_NAME2"], "DATA_VALUE", "seq", COMPOSITE_VALUES)


# ----------------------------------------------------------------- sums


@register(
    "group_sum",
    f"""SELECT {DAY_SQL} AS "TIME",
  CAST(COALESCE(SUM(CAST({MISSING_VALUE_SQL} AS DECIMAL(18,4))), 0) AS DOUBLE) AS total
FROM events WHERE ts IS NOT NULL GROUP BY 1""",
)
def group_sum_q(spark, sf_dir):
    """A1: sum by TIME; NULLs ignored, all-NULL group -> 0, NULL key dropped."""
    return group_sum(stat_long(spark, sf_dir, with_missing=True), "TIME", "DATA_VALUE", "total", decimal_scale=4)


@register(
    "group_sum_by_entity",
    """SELECT n.n_name AS country, strftime(o.o_orderdate, '%Y') AS "Date",
  CAST(COALESCE(SUM(CAST(o.o_totalprice AS DECIMAL(18,4))), 0) AS DOUBLE) AS "GDP"
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE o.o_orderdate IS NOT NULL
GROUP BY 1, 2""",
)
def group_sum_by_entity(spark, sf_dir):
    """A2: one grouped sum per (entity, period) instead of one job per entity.

    The history is pre-aggregated to (code, year) before it meets the company
    table, so the join shuffles one row per code and year, not one per price;
    a code holding a third of all rows costs one row per map task.
    """
    o = read_table(spark, sf_dir, "orders")
    per_code = (
        o.where(F.col("o_orderdate").isNotNull())
        .groupBy(F.col("o_custkey").alias("code"), stat_time("o_orderdate", "A").alias("Date"))
        .agg(F.sum(F.col("o_totalprice").cast("decimal(18,4)")).alias("s"))
    )
    c = read_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("code"), "c_nationkey")
    n = broadcast_if_bounded(
        read_table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"),
                                                   F.col("n_name").alias("country")),
        10_000,
    )
    joined = per_code.join(c, "code").join(n, "c_nationkey")
    return (
        joined.where(F.col("country").isNotNull())
        .groupBy("country", "Date")
        .agg(F.coalesce(F.sum("s").cast("double"), F.lit(0.0)).alias("GDP"))
    )


# ----------------------------------------------------------------- unions


@register(
    "union_all_parts",
    f"""SELECT strftime(o_orderdate, '%Y') AS "TIME", COUNT(*) AS n_rows,
  CAST(SUM(CAST(o_totalprice AS DECIMAL(18,4))) AS DOUBLE) AS total
FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1""",
)
def union_all_parts(spark, sf_dir):
    """Two disjoint parts with different column order, UNION ALL by name."""
    h = price_history(spark, sf_dir).where(F.col("date").isNotNull())
    early = h.where(F.col("date") < F.lit(CUTOFF).cast("date")).select("date", "price", "code")
    late = h.where(F.col("date") >= F.lit(CUTOFF).cast("date")).select("code", "price", "date")
    u = union_all([early, late])
    return u.groupBy(stat_time("date", "A").alias("TIME")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.col("price").cast("decimal(18,4)")).cast("double").alias("total"),
    )


@register(
    "union_overlap_dedup",
    """SELECT DISTINCT strftime(o_orderdate, '%Y') AS "TIME", o_orderstatus AS "ITEM_NAME1",
  o_orderpriority AS "ITEM_NAME2", o_totalprice AS "DATA_VALUE", o_orderkey AS seq
FROM orders""",
)
def union_overlap_dedup(spark, sf_dir):
    """Four overlapping yearly ranges; each boundary year is kept from the first
    part that fetched it, by range filters at the scans (no shuffle)."""
    o = yearly_statements(spark, sf_dir)
    return union_first_wins([(o, year_range(lo, hi)) for lo, hi in YEAR_RANGES]).drop("__d")


@register(
    "union_overlap_distinct",
    """SELECT DISTINCT strftime(o_orderdate, '%Y') AS "TIME", o_orderstatus AS "ITEM_NAME1",
  o_orderpriority AS "ITEM_NAME2", o_totalprice AS "DATA_VALUE", o_orderkey AS seq
FROM orders""",
)
def union_overlap_distinct(spark, sf_dir):
    """U2 when the parts' ranges are unknown: UNION then DISTINCT (one shuffle,
    partial de-duplication map-side)."""
    return union_dedup(yearly_statement_parts(spark, sf_dir))


# ----------------------------------------------------------------- projections / parsing


@register(
    "series_project",
    f"""SELECT {DAY_SQL} AS "TIME", value AS "NewsSentiment" FROM events WHERE event_type = 'signup'""",
)
def series_project(spark, sf_dir):
    """P1 + P2: one series, DATA_VALUE renamed, two columns kept."""
    long = stat_long(spark, sf_dir).where(F.col("ITEM_NAME1") == "signup")
    return select_rename(long, {"TIME": "TIME", "DATA_VALUE": "NewsSentiment"})


@register(
    "json_rows",
    f"""SELECT event_id, '901Y001' AS "STAT_CODE", event_type AS "ITEM_NAME1", CAST(NULL AS VARCHAR) AS "WGT",
  {DAY_SQL} AS "TIME", value AS "DATA_VALUE"
FROM events WHERE event_type <> 'error'""",
)
def json_rows(spark, sf_dir):
    """S1 + X14: one response document per event; 'error' events carry an error
    document without the envelope and yield no rows. The extra field ``k`` is
    not part of the record and is dropped; the absent ``WGT`` becomes NULL."""
    ev = read_table(spark, sf_dir, "events")
    record = F.struct(
        F.lit("901Y001").alias("STAT_CODE"),
        F.col("event_type").alias("ITEM_NAME1"),
        stat_time("ts").alias("TIME"),
        F.col("value").cast("string").alias("DATA_VALUE"),
        json_field("props", "$.k", "bigint").alias("k"),
    )
    envelope = F.to_json(F.struct(F.struct(F.array(record).alias("row")).alias("StatisticSearch")))
    doc = F.when(F.col("event_type") != "error", envelope).otherwise(
        F.lit('{"RESULT": {"CODE": "INFO-200", "MESSAGE": "no data"}}'))
    rows = parse_statistics(ev.select("event_id", doc.alias("doc")), "doc", keep=["event_id"])
    return rows.select(
        "event_id", "STAT_CODE", "ITEM_NAME1", "WGT", "TIME",
        F.col("DATA_VALUE").try_cast("double").alias("DATA_VALUE"),
    )


@register(
    "parse_year",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y') AS year_text,
  make_date(CAST(year(o_orderdate) AS INTEGER), 1, 1) AS "Date" FROM orders""",
)
def parse_year_q(spark, sf_dir):
    """Year text -> DATE (1 January)."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", stat_time("o_orderdate", "A").alias("year_text"))
    return o.withColumn("Date", parse_year("year_text"))


# ----------------------------------------------------------------- published series presets

# Fixed values of the stand-in: event type -> published item name.
RATE_ITEMS = {
    "click": "원/달러(종가 15:30)",
    "error": "원/엔(기타)",
    "purchase": "원/위안(종가)",
    "signup": "원/유로(매매기준율)",
    "view": "원/100엔(하나은행고시)",
}
INTEREST_ITEMS = {
    "click": "KOFR(공시 RFR)",
    "error": "국고채(10년)",
    "purchase": "콜금리(1일, 전체거래)",
    "signup": "회사채(3년, AA-)",
    "view": "기타금리",
}


def _item_long(spark, sf_dir, mapping, with_missing=False):
    long = stat_long(spark, sf_dir, with_missing)
    return long.withColumn("ITEM_NAME1", map_lookup("ITEM_NAME1", mapping))


def _item_case_sql(mapping) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"(CASE event_type {whens} END)"


def _series_sql(mapping, columns, value_sql, where="ts IS NOT NULL"):
    key = _item_case_sql(mapping)
    cols = ",\n  ".join(
        f"arg_min({value_sql}, event_id) FILTER (WHERE {key} = '{item}') AS \"{out}\"" for item, out in columns)
    return (f"SELECT {DAY_SQL} AS \"TIME\",\n  {cols}\nFROM events\n"
            f"WHERE ({value_sql}) IS NOT NULL AND {key} IS NOT NULL AND {where}\nGROUP BY 1")


@register(
    "series_exchange_rate",
    _series_sql(RATE_ITEMS, list(series.EXCHANGE_RATE_COLUMNS.items()), "value"),
)
def series_exchange_rate(spark, sf_dir):
    """Exchange-rate preset: three of the published rates, first by input order, renamed."""
    return series.exchange_rate(_item_long(spark, sf_dir, RATE_ITEMS), order=["event_id"])


@register(
    "series_interest_rates",
    _series_sql(INTEREST_ITEMS, [(i, i) for i in series.INTEREST_RATE_ITEMS], MISSING_VALUE_SQL,
                "ts IS NOT NULL AND " + _item_case_sql(INTEREST_ITEMS) + " IN ("
                + ", ".join(f"'{i}'" for i in series.INTEREST_RATE_ITEMS) + ")"),
)
def series_interest_rates(spark, sf_dir):
    """Interest-rate preset: the ten listed items only, fixed columns (items the
    source lacks are all-NULL columns), missing values never win "first"."""
    return series.interest_rates(_item_long(spark, sf_dir, INTEREST_ITEMS, with_missing=True), order=["event_id"])


@register(
    "json_files",
    f"""SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS "STAT_CODE", event_type AS "ITEM_NAME1",
  {DAY_SQL} AS "TIME", value AS "DATA_VALUE"
FROM events WHERE event_type <> 'error'""",
)
def json_files(spark, sf_dir):
    """S1 over landed files: every event written as one envelope per line
    (JSON Lines; 'error' events as an error answer without rows), read back
    with the explicit record schema; absent fields are NULL, extra ones dropped."""
    from marketlake.session import scratch_path
    from marketlake.sources.statistics import read_statistics, to_stat_long

    ev = read_table(spark, sf_dir, "events")
    record = F.struct(
        json_field("props", "$.k", "string").alias("STAT_CODE"),
        F.col("event_type").alias("ITEM_NAME1"),
        stat_time("ts").alias("TIME"),
        F.col("value").cast("string").alias("DATA_VALUE"),
        F.col("user_id").alias("EXTRA_FIELD"),
    )
    envelope = F.to_json(F.struct(F.struct(F.array(record).alias("row")).alias("StatisticSearch")))
    line = F.when(F.col("event_type") != "error", envelope).otherwise(F.lit('{"RESULT": {"CODE": "INFO-200"}}'))
    path = scratch_path(spark, "responses")
    ev.select(line.alias("value")).write.text(path)
    rows = to_stat_long(read_statistics(spark, path, json_lines=True))
    return rows.select(F.col("STAT_CODE").cast("bigint").alias("STAT_CODE"), "ITEM_NAME1", "TIME", "DATA_VALUE")
