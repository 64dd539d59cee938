"""Per-code price history maintenance, set-based.

The reference walks the top-100 codes one by one (one lookup, one fetch, one
insert per code). Here every step is one plan over all codes: the latest
stored date per code is one grouped aggregate, the new/known split is one
semi/anti join, the increment is one join + filter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.operators.common import (
    MAX_LITERAL_KEYS,
    bounded_broadcast,
    bounded_values,
    filter_by_keys,
    join_materialized,
    join_per_key,
    materialize_per_key,
)


def latest_date(history: DataFrame, key: str = "code", date: str = "date", alias: str = "last_date") -> DataFrame:
    """Newest stored date per code (partial max before the shuffle)."""
    return history.groupBy(key).agg(F.max(date).alias(alias))


def latest_row(history: DataFrame, key: str = "code", order: Sequence[str] = ("date",)) -> DataFrame:
    """The whole newest row per code, ties broken by the later ``order`` columns.

    ``max(struct(order..., rest...))`` is a partial aggregate, so a code that
    holds a third of all rows is reduced map-side instead of sorted in one task.
    """
    order = list(order)
    rest = [c for c in history.columns if c != key and c not in order]
    packed = F.max(F.struct(*[F.col(c) for c in order + rest])).alias("__r")
    return history.groupBy(key).agg(packed).select(key, *[F.col(f"__r.{c}").alias(c) for c in order + rest])


def distinct_keys(df: DataFrame, key: str = "code") -> DataFrame:
    """Distinct keys; de-duplicated map-side so a hot key costs one row per task."""
    return df.select(key).where(F.col(key).isNotNull()).distinct()


def split_known(candidates: DataFrame, stored: DataFrame, key: str = "code") -> tuple[DataFrame, DataFrame]:
    """(known, new): candidates whose key is / is not in the stored history.

    The stored side is reduced to distinct keys first; the two outputs are
    disjoint and together equal ``candidates``.
    """
    keys = distinct_keys(stored, key)
    return candidates.join(keys, key, "left_semi"), candidates.join(keys, key, "left_anti")


def incremental_rows(
    stored: DataFrame, incoming: DataFrame, key: str = "code", date: str = "date"
) -> DataFrame:
    """Incoming rows that are strictly newer than the stored history of their code,
    or whose code has no stored history at all.

    Re-running with the same input adds nothing once the result is stored.
    The per-code last dates are broadcast when their count is within a bound,
    otherwise hot codes are split (``join_per_key``).
    """
    last = latest_date(stored, key, date, "__last")
    j = join_per_key(incoming, last, key, "left")
    return j.where(F.col("__last").isNull() | (F.col(date) > F.col("__last"))).drop("__last")


def append_incremental(stored: DataFrame, incoming: DataFrame, key: str = "code", date: str = "date") -> DataFrame:
    """stored UNION ALL the incremental rows (idempotent append)."""
    delta = incremental_rows(stored, incoming, key, date)
    return stored.unionByName(delta.select(*stored.columns))


def since(history: DataFrame, codes: DataFrame, start, key: str = "code", date: str = "date") -> DataFrame:
    """Rows of the listed codes with ``date >= start`` (the price lookup).

    A short code list is a literal ``IN`` filter next to the date filter,
    both pushed into the scan (``filter_by_keys``); a long one is joined.
    """
    h = history.where(F.col(date) >= F.lit(start).cast("date"))
    return filter_by_keys(h, codes, key)


def history_of(history: DataFrame, codes: DataFrame, max_codes: int = 1000, key: str = "code") -> DataFrame:
    """History of a short code list (a top-k): the codes become a literal
    ``IN`` filter, which prunes ``code=`` directories of a per-key layout and
    is pushed into Parquet scans (a join against a limited frame is neither)."""
    return history.where(F.col(key).isin(bounded_values(codes, key, max_codes)))


def attach(history: DataFrame, attrs: DataFrame, key: str = "code", cols: Sequence[str] = ("name",),
           bounded: bool = False) -> DataFrame:
    """Add company attributes to each history row (inner join on ``key``).

    With ``bounded=True`` the attribute side is a top-N list and is broadcast;
    otherwise AQE picks broadcast vs sort-merge from runtime sizes and splits
    skewed code partitions.
    """
    side = attrs.select(key, *cols)
    if bounded:
        side = bounded_broadcast(side)
    return history.join(side, key)


def retention_split(history: DataFrame, keep_codes: DataFrame, key: str = "code") -> tuple[DataFrame, DataFrame]:
    """(kept, dropped) history rows by membership of ``key`` in the keep list.

    A short keep list (a top-N) becomes literal ``IN`` / ``NOT IN`` filters
    (pruned partitions, pushed-down scans); a long one is materialised and
    counted once, then broadcast for both joins (or joined with hot keys split).
    """
    try:
        values = bounded_values(keep_codes.where(F.col(key).isNotNull()), key, MAX_LITERAL_KEYS)
    except ValueError:
        keys, rows = materialize_per_key(keep_codes.select(key).distinct())
        return (join_materialized(history, keys, rows, key, "left_semi"),
                join_materialized(history, keys, rows, key, "left_anti"))
    member = F.col(key).isin(values)
    return history.where(member), history.where(~F.coalesce(member, F.lit(False)))
