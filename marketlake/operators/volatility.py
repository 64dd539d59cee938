"""High-volatility rows of a price series.

The reference hands each code's history to an external function whose rule
is not published. Our rule (documented, parameterised): daily change in
percent against the previous stored day of the same code,
``change = (price / prev_price - 1) * 100``; keep rows with
``abs(change) >= threshold``. The first day of a code has no change and is
never kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_THRESHOLD_PCT = 5.0


def daily_first_price(
    df: DataFrame,
    key: str,
    ts: str,
    price: str,
    order: Sequence[str],
) -> DataFrame:
    """One price per (code, day): the first by ``order`` among that day's rows.

    A partial aggregate (``min_by``) before the shuffle, so the following window
    sees at most one row per code and calendar day regardless of input volume.
    """
    o = F.struct(*[F.col(c) for c in order])
    return (
        df.where(F.col(price).isNotNull() & F.col(ts).isNotNull())
        .groupBy(F.col(key).alias("code"), F.to_date(ts).alias("date"))
        .agg(F.min_by(F.col(price), o).alias("price"))
    )


def with_change(series: DataFrame, key: str = "code", date: str = "date", price: str = "price",
                tie: Sequence[str] = ()) -> DataFrame:
    """Add prev_price and change (percent) against the previous row of the same code.

    ``tie`` columns order rows sharing a date (none when the series has one row
    per code and day, as ``daily_first_price`` produces), keeping it deterministic.
    """
    w = Window.partitionBy(key).orderBy(F.col(date).asc(), *[F.col(t).asc() for t in tie])
    prev = F.lag(price).over(w)
    return (
        series.withColumn("prev_price", prev)
        .withColumn("change", (F.try_divide(F.col(price), F.col("prev_price")) - F.lit(1.0)) * F.lit(100.0))
    )


def high_volatility(
    series: DataFrame,
    threshold_pct: float = DEFAULT_THRESHOLD_PCT,
    key: str = "code",
    date: str = "date",
    price: str = "price",
    tie: Sequence[str] = (),
) -> DataFrame:
    """Rows whose absolute daily change is at least ``threshold_pct`` percent.

    ``series`` has one row per (code, date) (see ``daily_first_price``), so
    each window partition is bounded by the calendar, not by data volume.
    """
    return (
        with_change(series, key, date, price, tie)
        # NaN compares above every number in Spark, but is no change.
        .where(F.col("prev_price").isNotNull() & ~F.isnan(F.col("change").cast("double")) & (F.abs(F.col("change")) >= F.lit(float(threshold_pct))))
        .select(key, date, price, "prev_price", "change")
    )
