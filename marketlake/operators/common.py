"""Small shared building blocks for joins and guards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def broadcast_if_bounded(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast ``df`` only after checking it has at most ``max_rows`` rows.

    The check is a ``limit(max_rows + 1).count()`` job, which stops reading as
    soon as the bound is exceeded. Beyond the bound the frame is returned
    without a hint and AQE chooses from runtime sizes (sort-merge with skew
    splitting when large).
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def bounded_values(df: DataFrame, column: str, max_values: int) -> list:
    """The distinct values of ``column`` as a Python list, refused beyond ``max_values``.

    For short key lists (a top-k) that become literal ``IN`` filters: pruned
    partitions on a per-key layout and Parquet filter push-down, where a join
    against a limited frame gets neither. Reads at most ``max_values + 1`` rows.
    """
    rows = df.select(column).distinct().limit(max_values + 1).collect()
    if len(rows) > max_values:
        raise ValueError(f"more than {max_values} values in {column!r}; join instead")
    return [r[0] for r in rows]


def bounded_broadcast(df: DataFrame) -> DataFrame:
    """Broadcast a side whose size is bounded by construction (a ``limit(n)``
    result or a constant list). Callers must guarantee the bound."""
    return F.broadcast(df)


# A per-key side up to this many rows is broadcast (one row per code: ~25 bytes each).
PER_KEY_BROADCAST_ROWS = 2_000_000
# Beyond the broadcast bound, a key with more rows than this is split over
# ceil(rows / TARGET_ROWS_PER_TASK) join tasks.
TARGET_ROWS_PER_TASK = 5_000_000


def skew_join(big: DataFrame, per_key: DataFrame, key: str, how: str = "inner",
              target_rows_per_task: int = TARGET_ROWS_PER_TASK) -> DataFrame:
    """Join a large, possibly skewed frame with a frame of (at most) one row per key,
    splitting hot keys adaptively.

    Rows per key of ``big`` are counted first (a partial aggregate). Keys with
    more than ``target_rows_per_task`` rows get ``b = ceil(rows / target)``
    salt values: their rows are spread by a deterministic row hash (a retried
    task routes every row the same way) and their per-key row is replicated
    ``b`` times; all other keys join unsalted. The hot-key list has at most
    ``rows(big) / target_rows_per_task`` entries, which bounds its broadcast.
    ``how``: inner, left, left_semi, left_anti.
    """
    counts = big.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    hot = F.broadcast(counts.where(F.col("__n") > target_rows_per_task).select(
        key, F.ceil(F.col("__n") / F.lit(target_rows_per_task)).cast("int").alias("__b")))
    row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in big.columns])
    left = (
        big.join(hot, key, "left")
        .withColumn("__salt", F.when(F.col("__b").isNull(), F.lit(0))
                    .otherwise(F.pmod(row_hash, F.col("__b").cast("long")).cast("int")))
        .drop("__b")
    )
    right = (
        per_key.join(hot, key, "left")
        .withColumn("__salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("__b"), F.lit(1)) - 1)))
        .drop("__b")
    )
    return left.join(right, [key, "__salt"], how).drop("__salt")


def materialize_per_key(per_key: DataFrame) -> tuple[DataFrame, int]:
    """Compute a per-key frame once and count it.

    Checkpointed to the shared checkpoint directory: it survives executor
    loss and, unlike a cache, can never be matched stale by a later plan over
    a table that has changed since.
    """
    from marketlake.session import cut_lineage

    m = cut_lineage(per_key)
    return m, m.count()


def join_materialized(big: DataFrame, per_key: DataFrame, rows: int, key: str, how: str = "inner",
                      broadcast_rows: int = PER_KEY_BROADCAST_ROWS,
                      target_rows_per_task: int = TARGET_ROWS_PER_TASK) -> DataFrame:
    """``join_per_key`` for a per-key frame already materialised with ``rows`` rows."""
    if rows <= broadcast_rows:
        return big.join(F.broadcast(per_key), key, how)
    return skew_join(big, per_key, key, how, target_rows_per_task)


def join_per_key(big: DataFrame, per_key: DataFrame, key: str, how: str = "inner",
                 broadcast_rows: int = PER_KEY_BROADCAST_ROWS,
                 target_rows_per_task: int = TARGET_ROWS_PER_TASK) -> DataFrame:
    """Join a large frame with a per-key frame (last date per code, loaded codes,
    codes to keep or delete), safe under any key skew.

    The per-key side is computed once and counted (``materialize_per_key``).
    Within ``broadcast_rows`` it is broadcast: the large side is neither
    shuffled nor skew-sensitive. Beyond it, ``skew_join`` splits hot keys.
    (AQE cannot split such a join itself: the per-key side reuses its
    aggregate's partitioning, and AQE only splits joins whose both children
    are shuffles.)
    """
    m, rows = materialize_per_key(per_key)
    return join_materialized(big, m, rows, key, how, broadcast_rows, target_rows_per_task)


# Up to this many keys a membership test is a literal IN (partition pruning,
# Parquet push-down); beyond it, a size-checked join.
MAX_LITERAL_KEYS = 1000


def filter_by_keys(big: DataFrame, keys: DataFrame, key: str, keep: bool = True,
                   max_literal: int = MAX_LITERAL_KEYS) -> DataFrame:
    """Rows of ``big`` whose ``key`` is (``keep=True``) or is not in ``keys``.

    A short key list (a top-N, at most ``max_literal`` distinct keys, checked)
    becomes a literal ``IN`` / ``NOT IN`` filter; a longer one is joined with
    ``join_per_key``. NULL keys are never "in" the list.
    """
    try:
        values = bounded_values(keys.where(F.col(key).isNotNull()), key, max_literal)
    except ValueError:
        return join_per_key(big, keys.select(key).distinct(), key, "left_semi" if keep else "left_anti")
    member = F.col(key).isin(values)
    return big.where(member) if keep else big.where(~F.coalesce(member, F.lit(False)))
