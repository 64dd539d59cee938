"""Ranked company lists: top-N, ranking numbers, parallel-list zip, exchange codes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.functions import map_lookup
from marketlake.operators.common import filter_by_keys

# Exchange name -> published exchange code; anything else is 'baddata'.
EXCHANGE_CODES = {
    "NMS": "NAS",
    "NYQ": "NYS",
}
UNKNOWN_EXCHANGE = "baddata"


def _ordering(metric: str, tie: str | Sequence[str], descending: bool) -> list[Column]:
    ties = [tie] if isinstance(tie, str) else list(tie)
    first = F.col(metric).desc_nulls_last() if descending else F.col(metric).asc_nulls_last()
    return [first] + [F.col(t).asc() for t in ties]


def top_n(df: DataFrame, n: int, metric: str, tie: str | Sequence[str], descending: bool = True) -> DataFrame:
    """The first ``n`` rows by ``metric`` (ties broken by ``tie``).

    Planned as TakeOrderedAndProject: every task keeps its own best ``n`` and
    only ``n`` x tasks rows reach the final merge, whatever the input size.
    """
    return df.orderBy(*_ordering(metric, tie, descending)).limit(n)


def rank_top(
    df: DataFrame,
    n: int,
    metric: str,
    tie: str | Sequence[str],
    descending: bool = True,
    rank_col: str = "ranking",
) -> DataFrame:
    """Top ``n`` with a 1-based INT ranking (as many ranks as rows, never a fixed 1..100).

    The window is un-partitioned but runs after the limit, i.e. on at most ``n`` rows.
    """
    order = _ordering(metric, tie, descending)
    top = df.orderBy(*order).limit(n)
    return top.withColumn(rank_col, F.row_number().over(Window.orderBy(*order)).cast("int"))


def first_k_codes(ranked: DataFrame, k: int, rank_col: str = "ranking") -> DataFrame:
    """``head(k)`` of a ranked list, in explicit rank order (files have no order in Spark)."""
    return ranked.orderBy(F.col(rank_col).asc()).limit(k)


def zip_lists(
    df: DataFrame,
    left: str,
    right: str,
    names: tuple[str, str] = ("name", "code"),
    pos_col: str = "pos",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Parallel lists held in two array columns -> one row per position (1-based).

    Lists of different lengths are an error (the scraped names and codes no
    longer line up), not silently padded.
    """
    l, r = F.col(left), F.col(right)
    pairs = F.zip_with(l, r, lambda a, b: F.struct(a.alias(names[0]), b.alias(names[1])))
    checked = F.when(F.size(l) == F.size(r), pairs).otherwise(
        F.raise_error(F.concat(F.lit(f"zip_lists: {left} and {right} differ in length"))))
    return (
        df.select(*keep, F.posexplode(checked).alias("__p", "__v"))
        .select(*keep, (F.col("__p") + 1).alias(pos_col), "__v.*")
    )


def exchange_code(c: str | Column, mapping: Mapping[str, str] = EXCHANGE_CODES,
                  default: str = UNKNOWN_EXCHANGE) -> Column:
    """Exchange name -> code; unknown or missing exchange -> ``default``."""
    return map_lookup(c, mapping, default)


def attach_exchange(
    listing: DataFrame,
    metadata: DataFrame,
    key: str = "code",
    exchange_col: str = "exchange",
    mapping: Mapping[str, str] = EXCHANGE_CODES,
    default: str = UNKNOWN_EXCHANGE,
    out_col: str = "excode",
) -> DataFrame:
    """Left join a listing with symbol metadata, then map the exchange.

    A symbol absent from the metadata and an exchange outside the map both
    give ``default``. The metadata is first reduced to the listed symbols
    (``filter_by_keys``: a literal IN pushed into its scan for a short list,
    a size-checked join otherwise), so the large side is never shuffled whole.
    """
    meta = filter_by_keys(metadata.select(key, exchange_col), listing.select(key), key)
    meta = meta.groupBy(key).agg(F.min(exchange_col).alias(exchange_col))  # one row per symbol
    return listing.join(meta, key, "left").withColumn(out_col, exchange_code(exchange_col, mapping, default))
