"""Per-code history as committed loads, with an index of last days.

    <path>/data/load=<n>/bucket=<b>/year=<y>/*.parquet   rows; a code lives in one bucket
    <path>/index/v=<n>[~<tag>]/*.parquet                 one row per code: its last day, [carried columns of
                                                         that day,] bucket, base

A load writes its rows, then the index that includes them. The index's ``_SUCCESS`` is
the commit: readers take the newest committed index and of each bucket the loads
from ``base`` up to its number, so a load that was interrupted is never seen and is
written over by the next one. What is new is found from the index alone: the stored rows are
not read, whatever their number. A delete or a compaction writes the survivors of the
buckets concerned as one load and moves those buckets' base there; other files stay untouched.

One writer at a time (a scheduled job); any number of readers.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from marketlake.operators.common import MAX_LITERAL_KEYS, bounded_values, filter_by_keys, join_materialized
from marketlake.sinks.files import write_partitioned
from marketlake.sources.files import child_names, delete_path, path_exists

REJECTS = -1  # the bucket of rows that are no history
PLACE = [StructField("load", LongType()), StructField("bucket", IntegerType()), StructField("year", IntegerType())]


@dataclass(frozen=True)
class Added:
    """What one load did: its number (the store's version after it), rows stored, rows put aside."""

    version: int
    stored: int
    unusable: int


@dataclass(frozen=True)
class HistoryStore:
    """A history under ``path``; ``buckets`` and ``carry`` are fixed for the life of the store.

    ``carry`` names columns whose values on a code's last day the index keeps too (of
    several rows of that day the greatest values).
    """

    spark: SparkSession
    path: str
    schema: StructType
    key: str = "code"
    date: str = "date"
    buckets: int = 16
    carry: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if taken := {"load", "bucket", "year", "last", "base"} & {f.name.lower() for f in self.schema.fields}:
            raise ValueError(f"column names of the store itself: {sorted(taken)}")

    # ------------------------------------------------------------------ committed state

    def _versions(self) -> dict[int, str]:
        """Committed versions and the names of their index folders."""
        found = {}
        for name in child_names(self.spark, f"{self.path}/index"):
            number = name.partition("~")[0].removeprefix("v=")
            if number.isdigit() and path_exists(self.spark, f"{self.path}/index/{name}/_SUCCESS"):
                found[int(number)] = name
        return found

    def version(self) -> int:
        """The number of the newest committed load (0: none)."""
        return max(self._versions(), default=0)

    def tag(self) -> str:
        """The tag of the newest committed load."""
        versions = self._versions()
        return versions[max(versions)].partition("~")[2] if versions else ""

    def committed(self, tag: str) -> bool:
        """Whether a load of this tag is among the committed ones (``vacuum`` forgets old ones)."""
        return any(name.partition("~")[2] == tag for name in self._versions().values())

    def _index_schema(self) -> StructType:
        day = self.schema[self.date].dataType
        held = [self.schema[c] for c in self.carry]
        return StructType([StructField(self.key, self.schema[self.key].dataType), StructField("last", day), *held, StructField("bucket", IntegerType()), StructField("base", LongType())])

    def index(self, version: int | None = None) -> DataFrame:
        """One row per code: key, last (its last stored day), bucket, base (the first load that counts in its bucket)."""
        versions = self._versions()
        version = max(versions, default=0) if version is None else version
        if not version:
            return self.spark.createDataFrame([], self._index_schema())
        return self.spark.read.schema(self._index_schema()).parquet(f"{self.path}/index/{versions[version]}")

    def _bases(self, version: int) -> dict[int, int]:
        """Bucket -> base; buckets without a code are left out. At most ``buckets`` rows."""
        if not version:
            return {}
        return {r.bucket: r.base for r in self.index(version).groupBy("bucket").agg(F.max("base").alias("base")).collect()}

    def bucket_of(self) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key).cast("string")), F.lit(self.buckets)).cast("int")

    # ------------------------------------------------------------------ reads

    def _data(self) -> DataFrame:
        return self.spark.read.schema(StructType([*self.schema.fields, *PLACE])).parquet(f"{self.path}/data")

    def read(self, codes: DataFrame | None = None, since=None, version: int | None = None) -> DataFrame:
        """The stored rows [of the listed codes] [from the day ``since`` on].

        Loads, buckets and years are partition filters; up to 1,000 codes are a
        literal list, pushed into the scan and narrowing the buckets, more are joined.
        """
        version = self.version() if version is None else version
        bases = self._bases(version)
        if not bases:
            return self.spark.createDataFrame([], self.schema)
        rows = self._held(version, bases)
        if since is not None:
            day = F.lit(since).cast("date")
            rows = rows.where((F.col("year") >= F.year(day)) & (F.col(self.date) >= day))
        if codes is not None:
            wanted = codes.select(F.col(self.key).cast(self.schema[self.key].dataType).alias(self.key)).where(F.col(self.key).isNotNull()).distinct()
            try:
                values = bounded_values(wanted, self.key, MAX_LITERAL_KEYS)
            except ValueError:
                rows = filter_by_keys(rows, wanted, self.key)
            else:
                own = [r[0] for r in self.spark.createDataFrame([(v,) for v in values], wanted.schema).select(self.bucket_of()).distinct().collect()]
                rows = rows.where(F.col("bucket").isin(own) & F.col(self.key).isin(values))
        return rows.select(*self.schema.names)

    def _held(self, version: int, bases: dict[int, int]) -> DataFrame:
        """The rows of some buckets, with load, bucket and year, as partition filters."""
        by_base: dict[int, list[int]] = {}
        for bucket, base in bases.items():
            by_base.setdefault(base, []).append(bucket)
        counts = F.lit(False)
        for base, own in sorted(by_base.items()):
            counts = counts | ((F.col("load") >= base) & F.col("bucket").isin(sorted(own)))
        return self._data().where((F.col("load") <= version) & counts)

    # ------------------------------------------------------------------ loads

    def _typed(self, rows: DataFrame) -> DataFrame:
        return rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self.schema.fields])

    def _write(self, rows: DataFrame, load: int) -> None:
        placed = rows if "bucket" in rows.columns else rows.withColumn("bucket", self.bucket_of())
        write_partitioned(placed.withColumn("year", F.year(self.date)), f"{self.path}/data/load={load}", ["bucket", "year"])

    def _last(self, rows: DataFrame) -> DataFrame:
        """Per code the last day of ``rows`` (key, last, carried columns) and its carried columns."""
        if not self.carry:
            return rows.groupBy(self.key).agg(F.max("last").alias("last"))
        packed = rows.groupBy(self.key).agg(F.max(F.struct("last", *self.carry)).alias("m"))
        return packed.select(self.key, "m.last", *[F.col(f"m.{c}") for c in self.carry])

    def _commit(self, index: DataFrame, load: int, tag: str, bases: dict[int, int]) -> None:
        """The commit: an index (key, last, carried columns) with each bucket's base, as version ``load``."""
        if tag and not tag.replace("-", "").replace("_", "").isalnum():
            raise ValueError("a tag has letters, digits, - and _ only")
        base = F.lit(load).cast("long")
        if bases:
            known = F.create_map(*[F.lit(x) for pair in sorted(bases.items()) for x in pair])
            base = F.coalesce(F.try_element_at(known, self.bucket_of()).cast("long"), base)
        out = index.select(self.key, "last", *self.carry, self.bucket_of().alias("bucket"), base.alias("base"))
        out.write.mode("overwrite").parquet(f"{self.path}/index/v={load}{f'~{tag}' if tag else ''}")

    def add(self, incoming: DataFrame, tag: str = "", newer_only: bool = True, since_version: int | None = None) -> Added:
        """Store the incoming rows that are newer than the last stored day of their code, or whose code is new.

        ``incoming`` is evaluated once, by the write. Rows without a key or a date are no history: the same
        write puts them aside (``rejects``). A load of nothing commits nothing. A ``tag`` that was committed before adds
        nothing (a replayed micro-batch). ``newer_only=False`` stores every row;
        ``since_version`` takes the last days of that version instead of the newest.
        """
        version = self.version()
        if tag and self.committed(tag):
            return Added(version, 0, 0)
        load = version + 1
        current = self.index(version)
        rows = self._typed(incoming)
        usable = F.col(self.key).isNotNull() & F.col(self.date).isNotNull()
        if newer_only:
            last = self.index(since_version) if since_version is not None else current
            last = last.select(self.key, F.col("last").alias("__last"))
            rows = join_materialized(rows, last, last.count(), self.key, "left")  # the count is in the files' footers
            rows = rows.withColumn("__new", F.col("__last").isNull() | (F.col(self.date) > F.col("__last"))).drop("__last")
        else:
            rows = rows.withColumn("__new", F.lit(True))
        rows = rows.where(~usable | F.col("__new")).select(*self.schema.names)
        self._write(rows.withColumn("bucket", F.when(usable, self.bucket_of()).otherwise(F.lit(REJECTS))), load)
        counts = {r[0]: r[1] for r in self._data().where(F.col("load") == load).groupBy(F.col("bucket") == REJECTS).count().collect()}
        stored, unusable = counts.get(False, 0), counts.get(True, 0)
        if not counts:
            delete_path(self.spark, f"{self.path}/data/load={load}")
            return Added(version, 0, 0)
        fresh = self._data().where((F.col("load") == load) & (F.col("bucket") != REJECTS)).select(self.key, F.col(self.date).alias("last"), *self.carry)
        self._commit(self._last(self._last(fresh).unionByName(current.drop("bucket", "base"))), load, tag, self._bases(version))
        return Added(load, stored, unusable)

    def rejects(self) -> DataFrame:
        """Rows without a key or a date, with the load they came in; kept until ``vacuum`` passes their load."""
        version = self.version()
        if not version:
            return self.spark.createDataFrame([], StructType([*self.schema.fields, PLACE[0]]))
        return self._data().where((F.col("bucket") == REJECTS) & (F.col("load") <= version)).select(*self.schema.names, "load")

    # ------------------------------------------------------------------ deletes, compaction, clean-up

    def _rewrite(self, buckets: list[int], gone: DataFrame | None) -> int:
        version = self.version()
        load, bases = version + 1, self._bases(version)
        index, held = self.index(version), self._held(version, {b: n for b, n in bases.items() if b in buckets})
        if gone is not None:
            held, index = filter_by_keys(held, gone, self.key, keep=False), filter_by_keys(index, gone, self.key, keep=False)
        self._write(held.select(*self.schema.names), load)
        self._commit(index, load, "", {b: n for b, n in bases.items() if b not in buckets})
        return load

    def delete(self, codes: DataFrame) -> int:
        """The listed codes go, rows and index, in one commit; only their buckets are written anew.

        Codes that the store does not have are passed over. Returns the store's version.
        """
        gone = codes.select(F.col(self.key).cast(self.schema[self.key].dataType).alias(self.key)).where(F.col(self.key).isNotNull()).distinct()
        touched = [r.bucket for r in filter_by_keys(self.index(), gone, self.key).select("bucket").distinct().collect()]  # at most ``buckets``
        return self._rewrite(sorted(touched), gone) if touched else self.version()

    def compact(self, most_loads: int = 8) -> list[int]:
        """Write buckets that are spread over more than ``most_loads`` loads anew, as one; their numbers."""
        version = self.version()
        bases = self._bases(version)
        loads = {b: 0 for b in bases}
        for load in self._loads(version):
            for bucket in self._buckets(load):
                if bucket in bases and load >= bases[bucket]:
                    loads[bucket] += 1
        spread = sorted(b for b, n in loads.items() if n > most_loads)
        if spread:
            self._rewrite(spread, None)
        return spread

    def _loads(self, version: int) -> list[int]:
        numbers = (n.removeprefix("load=") for n in child_names(self.spark, f"{self.path}/data"))
        return sorted(int(n) for n in numbers if n.isdigit() and int(n) <= version)

    def _buckets(self, load: int) -> list[int]:
        numbers = (n.removeprefix("bucket=") for n in child_names(self.spark, f"{self.path}/data/load={load}"))
        return sorted(int(n) for n in numbers if n.isdigit())

    def vacuum(self, keep_versions: int = 2) -> int:
        """Forget all but the newest ``keep_versions`` versions; folders that none of these reads are deleted. Their number."""
        versions = self._versions()
        kept = sorted(versions)[-max(1, keep_versions):]
        if not kept:
            return 0
        bases = [self._bases(v) for v in kept]
        gone = [f"index/{name}" for v, name in versions.items() if v not in kept]
        for load in self._loads(kept[-1]):
            for bucket in self._buckets(load):
                if not any(bucket in b and b[bucket] <= load <= v for v, b in zip(kept, bases)):
                    gone.append(f"data/load={load}/bucket={bucket}")
        for name in gone:
            delete_path(self.spark, f"{self.path}/{name}")
        return len(gone)
