"""Long <-> wide reshaping, grouped sums, unions and projections.

The long statistics tables are turned into wide tables the way the macro jobs
do it: first non-null value per (index, key) cell in an explicit order, fixed
column list, all-null rows dropped.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from marketlake.session import cut_lineage

# Spark's own ceiling for pivots without an explicit value list.
MAX_PIVOT_VALUES = 10_000
# Up to this many columns the pivot is one conditional aggregation (one shuffle).
SINGLE_PASS_MAX_VALUES = 64


def _names(cols: str | Sequence[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def _order_key(order: str | Sequence[str]) -> Column:
    cols = _names(order)
    if len(cols) == 1:
        return F.col(cols[0])
    return F.struct(*[x for c in cols for x in (F.col(c).isNull().alias(f"{c}_null"), F.col(c))])  # nulls last


def _first_by(value: Column, order: str | Sequence[str], own: Column | None = None) -> Column:
    """The value of the first row by ``order``, of the rows where ``own`` holds. Rows without an order come
    last; if a cell has no others, the least of their values."""
    ordering = _order_key(order)
    if own is not None:
        value, ordering = F.when(own, value), F.when(own, ordering)
    if len(_names(order)) > 1:
        return F.min_by(value, ordering)
    return F.coalesce(F.min_by(value, ordering), F.min(F.when(F.col(_names(order)[0]).isNull(), value)))


def _all_not_null(cols: Iterable[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])


def pivot_values(df: DataFrame, key: str, max_values: int = MAX_PIVOT_VALUES) -> list:
    """Sorted distinct non-null keys: the pivot's column list when none is given.

    This is one small aggregation job; the result is bounded by the table
    width, and refused beyond ``max_values`` like Spark's own pivot.
    """
    rows = (
        df.where(F.col(key).isNotNull()).select(key).distinct()
        .limit(max_values + 1).collect()
    )
    if len(rows) > max_values:
        raise ValueError(f"pivot on {key!r} has more than {max_values} distinct values; pass values=")
    return sorted(r[0] for r in rows)


def pivot_first(
    df: DataFrame,
    index: str | Sequence[str],
    key: str,
    value: str,
    order: str | Sequence[str],
    values: Sequence | None = None,
) -> DataFrame:
    """Long -> wide, keeping per cell the first non-null ``value`` by ``order``.

    * rows with a NULL index, key or value are ignored (so an index whose
      values are all NULL produces no row);
    * ``values`` fixes the output columns and their order (a listed key that
      never occurs gives an all-NULL column, so positional consumers never
      shift). Without it the sorted distinct non-null keys are used.
    * ``order`` is required: "first" has no meaning after a shuffle otherwise.
      A row whose order is NULL comes after all others.

    Plan: one partial aggregation per index value before a single shuffle on
    the index (up to ``SINGLE_PASS_MAX_VALUES`` columns), so a hot index value
    costs one row per map task, not one row per input row.
    """
    idx = _names(index)
    base = df.where(_all_not_null(idx + [key, value]))
    if values is None:
        values = pivot_values(base, key)
    values = list(values)
    if len(values) <= SINGLE_PASS_MAX_VALUES:
        # One aggregation, one shuffle on the index: each output column is a
        # min_by whose ordering is NULL (= ignored) unless the row has that key.
        cells = [_first_by(F.col(value), order, F.col(key) == F.lit(v)).alias(str(v)) for v in values]
        return base.groupBy(*idx).agg(*cells)
    # Wide pivots: Spark's two-phase pivot (per-cell aggregate, then PivotFirst)
    # evaluates one aggregate per row instead of one per listed value.
    return base.groupBy(*idx).pivot(key, values).agg(_first_by(F.col(value), order))


def pivot_blocks(df: DataFrame, index: str | Sequence[str], key: str, value: str, order: str | Sequence[str], width: int = 1000) -> tuple[DataFrame, DataFrame]:
    """``pivot_first`` for any number of items: (layout, cells) instead of a column per item.

    layout: item, block, place - the sorted items, ``width`` to a block. cells: index, block,
    ``cells``, an array with one element per place (NULL: no value); a block in which an index
    has no value has no row. One shuffle per cell, one per index and block; nothing is collected, and
    no row is wider than a block. ``block_columns`` gives chosen items as columns.
    """
    idx = _names(index)
    base = df.where(_all_not_null(idx + [key, value]))
    first = base.groupBy(*idx, key).agg(_first_by(F.col(value), order).alias("__v"))
    # Places by range: sorted parts are numbered from the counts of the parts before them.
    items = base.select(F.col(key).alias("item")).distinct()
    ranked = cut_lineage(items.repartitionByRange("item").sortWithinPartitions("item").select("item", F.monotonically_increasing_id().alias("__n")))
    part = F.shiftright("__n", 33)
    counts = ranked.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__count"))
    before = counts.select("__part", (F.sum("__count").over(Window.orderBy("__part")) - F.col("__count")).alias("__before"))  # one row per part
    number = F.col("__n") - F.shiftleft(F.col("__part"), 33) + F.col("__before")
    layout = ranked.withColumn("__part", part).join(F.broadcast(before), "__part").select(
        "item", F.floor(number / width).cast("int").alias("block"), (number % width).cast("int").alias("place"))
    layout = cut_lineage(layout)
    placed = first.join(layout, first[key] == layout["item"]).groupBy(*idx, "block").agg(
        F.sort_array(F.collect_list(F.struct("place", "__v"))).alias("__held"))
    # Each value with the empty places before it, then those after the last: one pass, whatever the width.
    none = F.lit(None).cast(first.schema["__v"].dataType)

    def spaced(x: Column, i: Column) -> Column:
        return F.concat(F.array_repeat(none, x["place"] - F.coalesce(F.get("__held", i - 1)["place"], F.lit(-1)) - 1), F.array(x["__v"]))

    rest = F.array_repeat(none, F.lit(width - 1) - F.element_at("__held", -1)["place"])
    return layout, placed.select(*idx, "block", F.concat(F.flatten(F.transform("__held", spaced)), rest).alias("cells"))


def block_columns(layout: DataFrame, cells: DataFrame, index: str | Sequence[str], items: Sequence) -> DataFrame:
    """Chosen items of ``pivot_blocks`` as columns, one row per index that has any of them; reads their blocks only."""
    idx = _names(index)
    where = {r["item"]: (r["block"], r["place"]) for r in layout.where(F.col("item").isin(list(items))).collect()}
    own = cells.where(F.col("block").isin(sorted({b for b, _ in where.values()})))
    kind = cells.schema["cells"].dataType.elementType

    def one(item) -> Column:
        if item not in where:
            return F.lit(None).cast(kind).alias(str(item))
        block, place = where[item]
        return F.max(F.when(F.col("block") == block, F.col("cells")[place])).alias(str(item))

    wide = own.groupBy(*idx).agg(*[one(i) for i in items])
    return wide.where(reduce(lambda a, b: a | b, [F.col(f"`{i}`").isNotNull() for i in items]))


def block_values(layout: DataFrame, cells: DataFrame, index: str | Sequence[str], value: str = "value") -> DataFrame:
    """All cells of ``pivot_blocks`` as rows again: index, item, value."""
    idx = _names(index)
    rows = cells.select(*idx, "block", F.posexplode("cells").alias("place", value)).where(F.col(value).isNotNull())
    return rows.join(layout, ["block", "place"]).select(*idx, "item", value)


def pivot_composite(
    df: DataFrame,
    index: str | Sequence[str],
    keys: Sequence[str],
    value: str,
    order: str | Sequence[str],
    values: Sequence[Sequence[str]] | None = None,
    sep: str = "|",
) -> DataFrame:
    """Pivot on a multi-column key; rows with any NULL key part are dropped.

    Output columns are named ``part1<sep>part2<sep>...``; a separator or backslash inside a
    part is written with a backslash before it, so different keys never share a column.
    """
    keys = list(keys)

    def part(k: str):
        return F.replace(F.replace(F.col(k).cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit(sep), F.lit("\\" + sep))

    base = df.where(_all_not_null(keys)).withColumn("__pivot_key", F.concat_ws(sep, *[part(k) for k in keys]))
    flat = None if values is None else [sep.join(str(p).replace("\\", "\\\\").replace(sep, "\\" + sep) for p in v) for v in values]
    return pivot_first(base, index, "__pivot_key", value, order, flat)


def group_sum(
    df: DataFrame,
    keys: str | Sequence[str],
    value: str,
    alias: str,
    decimal_scale: int | None = None,
    decimal_precision: int = 18,
) -> DataFrame:
    """Sum per key with pandas ``groupby().sum()`` semantics.

    NULL values are ignored, a group whose values are all NULL sums to 0,
    rows with a NULL key are dropped. With ``decimal_scale`` the sum is exact
    (through DECIMAL(decimal_precision, scale)) and returned as double, so the
    result does not depend on the order partitions are combined in. Precision
    18 keeps the per-row cast on 64-bit decimals; pass 38 for values of 10^14
    and more (a value that does not fit raises under ANSI mode).
    """
    ks = _names(keys)
    v = F.col(value)
    if decimal_scale is not None:
        v = v.cast(DecimalType(decimal_precision, decimal_scale))
    total = F.sum(v)
    if decimal_scale is not None:
        total = total.cast("double")
    return (
        df.where(_all_not_null(ks))
        .groupBy(*ks)
        .agg(F.coalesce(total, F.lit(0.0)).alias(alias))
    )


def union_all(dfs: Sequence[DataFrame], allow_missing: bool = True) -> DataFrame:
    """UNION ALL by column name (``pd.concat``); absent columns become NULL."""
    if not dfs:
        raise ValueError("union_all needs at least one DataFrame")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), dfs)


def union_dedup(dfs: Sequence[DataFrame], keys: Sequence[str] | None = None) -> DataFrame:
    """UNION of parts that may overlap (shared boundary periods), duplicates collapsed.

    With ``keys`` rows sharing a key are assumed identical and one is kept.
    The de-duplication aggregates map-side first, so heavily repeated rows
    are collapsed before the shuffle.
    """
    u = union_all(dfs)
    return u.dropDuplicates(list(keys)) if keys else u.distinct()


def union_first_wins(parts: Sequence[tuple[DataFrame, Column]]) -> DataFrame:
    """UNION of parts fetched with overlapping conditions (e.g. date ranges).

    Part ``i`` keeps the rows matching its own condition that no earlier
    part's condition covers, so a shared period comes from the first part
    that fetched it (the concat-then-"first" rule) and nothing is duplicated.
    Unlike ``distinct`` this needs no shuffle; conditions on raw columns are
    pushed into each part's scan.
    """
    if not parts:
        raise ValueError("union_first_wins needs at least one part")
    kept = []
    for i, (df, cond) in enumerate(parts):
        c = cond
        for _, earlier in parts[:i]:
            c = c & ~F.coalesce(earlier, F.lit(False))
        kept.append(df.where(c))
    return union_all(kept)


def union_ranges(parts: Sequence[tuple[DataFrame, object, object]], column: str) -> DataFrame:
    """``union_first_wins`` for inclusive ranges ``[lo, hi]`` of ``column``."""
    c = F.col(column)
    return union_first_wins([(df, c.between(F.lit(lo), F.lit(hi))) for df, lo, hi in parts])


def select_rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Keep the mapped columns (in mapping order) under their new names."""
    return df.select(*[F.col(f"`{src}`").alias(dst) for src, dst in mapping.items()])


def rename_positional(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``df.columns = [...]``: rename by position; the count must match."""
    if len(names) != len(df.columns):
        raise ValueError(f"{len(names)} names for {len(df.columns)} columns")
    return df.toDF(*names)


def filter_in(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    """Set-membership filter (pushed into the scan as an IN predicate)."""
    return df.where(F.col(column).isin(list(values)))
