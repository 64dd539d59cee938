"""Shared helpers of the text operators: words, stable hashes, Arrow batches, columns."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.session import scratch_path

# Python workers hold one Arrow batch at a time: at most this many rows and bytes.
BATCH_ROWS = 512
BATCH_BYTES = 16 << 20
# Entries of a per-worker memo; it is emptied when full, so memory stays bounded.
MEMO_ENTRIES = 200_000


def bound_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small: documents may be megabytes long."""
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{key}"
        now = spark.conf.get(key, None)
        digits = "".join(c for c in str(now) if c.isdigit())
        if not digits or int(digits) <= 0 or int(digits) > most or not str(now).isdigit():
            spark.conf.set(key, str(most))


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, path: str | None = None, codec: str | None = None, parts: list[str] | None = None) -> DataFrame:
    """The rows of ``df``, written once to the shared scratch folder and read from there.

    Cuts lineage like checkpoint(), in a compact form, and leaves no constraints of
    the plan behind, which grow with every round of a loop. The shuffle files of the
    write are given up with it, since only the table is read from here on.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, "rows")
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path, partitionBy=parts, compression=codec)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that nothing reads any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


class Scratch:
    """Written tables of some steps; they are removed when the block is left."""

    def __init__(self, spark: SparkSession):
        self.spark, self.path, self.tables = spark, scratch_path(spark, "steps"), 0

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *failure) -> None:
        remove(self.spark, self.path)

    def written(self, df: DataFrame) -> DataFrame:
        self.tables += 1
        return written(df, f"{self.path}/{self.tables}")


def fresh(name: str) -> str:
    """A column name that no caller's table has."""
    return f"__{name}_{uuid.uuid4().hex[:8]}"


def with_fields(df: DataFrame, struct: Column, fields: list[str]) -> DataFrame:
    """Append the fields of a struct column; columns of the same name are replaced."""
    tmp = fresh("s")
    out = df.withColumn(tmp, struct)
    return out.withColumns({f: out[tmp][f] for f in fields}).drop(tmp)


def utf8(array: pa.Array) -> list[bytes]:
    """Texts as UTF-8 bytes; null becomes empty."""
    return [x or b"" for x in array.cast(pa.large_binary()).to_pylist()]


def strings(array: pa.Array) -> list[str]:
    """Texts; null becomes empty."""
    return [x or "" for x in array.to_pylist()]


def by_batch(make: Callable[[], Callable[[pa.Array], pa.Array]]) -> Callable[[Iterator[pa.Array]], Iterator[pa.Array]]:
    """An iterator function for ``arrow_udf``: ``make`` builds the worker's state once per task; its
    attribute ``done``, if it has one, is called when the task ends."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        each = make()
        try:
            for batch in batches:
                yield each(batch)
        finally:
            getattr(each, "done", lambda: None)()

    return run


class Memo(dict):
    """A memo of ``fn`` with a bounded number of entries; long keys are not kept."""

    def __init__(self, fn: Callable, most: int = MEMO_ENTRIES, longest: int = 100):
        super().__init__()
        self.fn, self.most, self.longest = fn, most, longest

    def __missing__(self, key):
        value = self.fn(key)
        if len(key) <= self.longest:
            if len(self) >= self.most:
                self.clear()
            self[key] = value
        return value


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=64)
def odd_numbers(n: int, seed: int) -> np.ndarray:
    """n random odd multipliers, fixed by the seed."""
    return np.random.default_rng(seed).integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def gram_codes(codes: np.ndarray, k: int, seed: int = 17) -> np.ndarray:
    """64-bit codes of the k-word windows (none for fewer words)."""
    n = len(codes) - k + 1
    if n <= 0:
        return codes[:0]
    out = np.zeros(n, np.uint64)
    for j, m in enumerate(odd_numbers(k, seed)):
        out += codes[j : j + n] * m
    return mix(out)


# Byte classes of a word: 0 parts words, anything else is the byte as it is hashed.
SPACED = np.arange(256, dtype=np.uint8)  # words are [^\x20\x09-\x0D]+
SPACED[[32, *range(9, 14)]] = 0
SPACED[0] = 1  # a NUL is part of a word (hashed apart from \x01, see _scan_part)
SPACED_LOWER = SPACED.copy()  # the same, A-Z lowered
SPACED_LOWER[65:91] += 32
LETTERS = SPACED_LOWER.copy()  # ASCII letters and digits and all other characters; ASCII punctuation parts words
LETTERS[[c for c in range(128) if not chr(c).isalnum()]] = 0

SCAN_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1


@lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    def powers(base: int) -> np.ndarray:
        out = np.ones(1, np.uint64)
        while len(out) < n:
            out = np.concatenate([out, out * np.uint64(pow(base, len(out), 1 << 64))])
        return out[:n]

    return powers(_BASE), powers(pow(_BASE, -1, 1 << 64))


def _scan_part(data: np.ndarray, firsts: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    value = table[data]
    inside = value != 0
    parted = np.ones(len(data) + 1, bool)  # no word goes over this place
    parted[1:-1] = False
    parted[firsts] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | parted[1:-1]
    stop = inside.copy()
    stop[:-1] &= ~inside[1:] | parted[1:-1]
    starts, stops = np.flatnonzero(start), np.flatnonzero(stop) + 1
    size = 1 << max(20, (len(data) - 1).bit_length())
    power, inverse = _powers(size)
    number = value.astype(np.uint64)
    number[data == 0] += np.uint64(255)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(number * power[: len(data)], out=total[1:])
    codes = (total[stops] - total[starts]) * inverse[starts] + (stops - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return mix(codes), starts, stops


def scan_words(texts: pa.Array, table: np.ndarray = SPACED) -> tuple[np.ndarray, np.ndarray]:
    """64-bit codes of all words of a batch, and the place of each text's first word (one more at the end).

    Works on the batch's buffer as a whole, about SCAN_BYTES at a time, cut where
    no word goes over. A code is a polynomial of the word's bytes, mixed with its
    length; it is the same in every task. Nulls have no words.
    """
    codes, begin, _, _ = scan_places(*batch_bytes(texts), table)
    return codes, begin


def batch_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a batch of texts, and where each text begins (one more at the end)."""
    texts = texts.cast(pa.large_binary())
    _, offsets, buffer = texts.buffers()
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8)
    data = np.frombuffer(buffer, np.uint8)[at[0] : at[-1]] if buffer is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    return data, at - at[0]


def by_bytes(texts: pa.Array, most: int = SCAN_BYTES) -> Iterator[pa.Array]:
    """A batch in slices of at most ``most`` bytes; a longer text is a slice of its own."""
    ends, begin = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)), 0
    while begin < len(texts):
        done = int(ends[begin - 1]) if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, done + most, "right")))
        yield texts.slice(begin, end - begin)
        begin = end


def scan_places(data: np.ndarray, at: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(codes, each text's first word, first byte of each word, byte after it)."""
    codes, starts, stops, begin = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
    while begin < len(data):
        end, step = len(data), SCAN_BYTES
        while begin + step < len(data):
            # The last place up to begin + step where a text starts, or a byte that parts words lies.
            i = int(np.searchsorted(at, begin + step, "right")) - 1
            cut = int(at[i])
            if cut <= begin:
                parts = np.flatnonzero(table[data[begin + 1 : begin + step]] == 0)
                cut = begin + 1 + int(parts[-1]) if len(parts) else begin
            if cut > begin:
                end = cut
                break
            step *= 2  # one word is longer than all this
        firsts = at[(at >= begin) & (at < end)] - begin
        c, s, e = _scan_part(data[begin:end], firsts, table)
        codes.append(c)
        starts.append(s + begin)
        stops.append(e + begin)
        begin = end
    place = np.concatenate(starts)
    return np.concatenate(codes), np.searchsorted(place, at, "left"), place, np.concatenate(stops)
