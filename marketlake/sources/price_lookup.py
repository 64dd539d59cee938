"""Prices of symbols from a day on, as a data source of its own.

    price_lookup(spark, path, "code string, date date, price double", ["005930", "AAPL"], "2024-01-02")

``path`` holds one folder of Parquet files per symbol (``code=<symbol>/``, as ``write_per_key`` lands them).
A filter on the symbol or the day is pushed into the source: a task reads one lookup, that is some
symbols over a range of days, as the provider's own interface is asked. Folders
of other symbols are not opened; the files' statistics skip row groups of other days.

Spark keeps the source of a DataFrame as its last filters left it, and a query of the same DataFrame
without any filter would read no more than that. ``price_lookup`` therefore always sets one.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    LessThan,
    LessThanOrEqual,
)
from pyspark.sql.types import StructType

PUSH_DOWN = "spark.sql.python.filterPushdown.enabled"
SYMBOLS_PER_TASK = 20
YEARS_PER_TASK = 10
DAY = dt.timedelta(days=1)


@dataclass
class Lookup(InputPartition):
    """Some symbols, with their folders' names, from day ``lo`` to day ``hi`` (null: open)."""

    symbols: list[tuple[str, str]]
    lo: dt.date | None
    hi: dt.date | None

    def __init__(self, symbols: list[tuple[str, str]], lo: dt.date | None, hi: dt.date | None):
        super().__init__((symbols, lo, hi))
        self.symbols, self.lo, self.hi = symbols, lo, hi


def ranges(lo: dt.date | None, hi: dt.date | None, years: int) -> list[tuple[dt.date | None, dt.date | None]]:
    """The days from ``lo`` to ``hi`` in pieces of some years; an open end stays open."""
    if lo is None or hi is None:
        return [(lo, hi)]
    out = []
    while lo <= hi:
        end = min(hi, dt.date(min(lo.year + years, 9999), 1, 1) - DAY) if lo.year + years <= 9999 else hi
        out.append((lo, end))
        lo = end + DAY
    return out


class LookupReader(DataSourceReader):
    """Plans lookups from the pushed filters and reads them."""

    def __init__(self, path: str, schema: StructType, key: str, date: str):
        self.path, self.schema, self.key, self.date = path.rstrip("/"), schema, key, date
        self.symbols: set[str] | None = None
        self.lo: dt.date | None = None
        self.hi: dt.date | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Takes filters on the symbol and the day; the others stay Spark's."""
        self.symbols = self.lo = self.hi = None
        for f in filters:
            column = f.attribute if hasattr(f, "attribute") else ()
            if column == (self.key,) and isinstance(f, (EqualTo, In)):
                wanted = {str(v) for v in (f.value if isinstance(f, In) else [f.value]) if v is not None}
                self.symbols = wanted if self.symbols is None else self.symbols & wanted
            elif column == (self.date,) and isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)):
                if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)):
                    lo = f.value + DAY if isinstance(f, GreaterThan) else f.value
                    self.lo = lo if self.lo is None else max(self.lo, lo)
                if isinstance(f, (EqualTo, LessThan, LessThanOrEqual)):
                    hi = f.value - DAY if isinstance(f, LessThan) else f.value
                    self.hi = hi if self.hi is None else min(self.hi, hi)
            elif column == (self.key,) and isinstance(f, IsNotNull):
                continue  # a symbol's folder has a name
            else:
                yield f

    def _files(self):
        from pyarrow.fs import FileSystem

        return FileSystem.from_uri(self.path if ":/" in self.path else f"file://{self.path}")

    def partitions(self) -> list[Lookup]:
        """One lookup for some symbols and a range of days; without a filter on the symbol, of all folders."""
        from pyarrow.fs import FileSelector

        files, root = self._files()
        names = [i.base_name for i in files.get_file_info(FileSelector(root)) if i.base_name.startswith(f"{self.key}=")]
        held = sorted((unquote(n.removeprefix(f"{self.key}=")), n) for n in names)  # folder names are escaped
        held = [(s, n) for s, n in held if self.symbols is None or s in self.symbols]
        parts = [held[i : i + SYMBOLS_PER_TASK] for i in range(0, len(held), SYMBOLS_PER_TASK)]
        return [Lookup(p, lo, hi) for p in parts for lo, hi in ranges(self.lo, self.hi, YEARS_PER_TASK)] or [Lookup([], None, None)]

    def read(self, partition: Lookup) -> Iterator:
        import pyarrow as pa
        import pyarrow.dataset as ds
        from pyspark.sql.pandas.types import to_arrow_schema

        files, root = self._files()
        wanted = to_arrow_schema(self.schema)
        inside = pa.schema([f for f in wanted if f.name != self.key])
        day = ds.field(self.date)
        keep = None
        for bound in ([day >= partition.lo] if partition.lo else []) + ([day <= partition.hi] if partition.hi else []):
            keep = bound if keep is None else keep & bound
        for symbol, folder in partition.symbols:
            for batch in ds.dataset(f"{root}/{folder}", schema=inside, format="parquet", filesystem=files).to_batches(filter=keep):
                columns = [pa.array([symbol] * len(batch)).cast(f.type) if f.name == self.key else batch[f.name] for f in wanted]
                yield pa.RecordBatch.from_arrays(columns, schema=wanted)


class PriceLookup(DataSource):
    """The source ``price_lookup``; options: path, key (code), date (date). The schema is the reader's."""

    @classmethod
    def name(cls) -> str:
        return "price_lookup"

    def schema(self) -> str:
        return "code string, date date, price double"

    def reader(self, schema: StructType) -> LookupReader:
        return LookupReader(self.options["path"], schema, self.options.get("key", "code"), self.options.get("date", "date"))


def price_lookup(spark: SparkSession, path: str, schema: str | StructType, symbols: Sequence | None = None, start: str = "0001-01-01",
                 end: str | None = None, key: str = "code", date: str = "date") -> DataFrame:
    """The landed prices under ``path`` of ``symbols`` (None: all) from ``start`` [to ``end``]; rows without a date are left out.

    Further filters on ``key`` and ``date`` are pushed into the source too. The folders must be reachable
    by the executors' Python (local, HDFS or object store paths of Arrow).
    """
    spark.conf.set(PUSH_DOWN, "true")
    spark.dataSource.register(PriceLookup)
    rows = spark.read.format("price_lookup").schema(schema).options(path=path, key=key, date=date).load()
    rows = rows.where(F.col(date) >= F.lit(start).cast("date"))
    if end is not None:
        rows = rows.where(F.col(date) <= F.lit(end).cast("date"))
    return rows if symbols is None else rows.where(F.col(key).isin(list(symbols)))
