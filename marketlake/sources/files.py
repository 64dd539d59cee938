"""File scans: CSV with explicit schemas, multi-file fan-in, object listings, manifests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marketlake.functions import key_from_path

ROW_INDEX_COL = "_c0"  # how Spark names the unnamed index column pandas writes first

# RFC 4180 like pandas and warehouse COPY: quotes inside fields are doubled.
# An unquoted empty field is NULL, a quoted empty field ("") the empty string;
# the NUL null marker keeps the reader from folding "" into NULL.
CSV_READ_OPTIONS = {"escape": '"', "nullValue": "\u0000"}


def _paths(paths: str | Sequence[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def read_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: StructType | None = None,
    header: bool = True,
    check_header: bool = False,
    **options,
) -> DataFrame:
    """CSV with a header (a UTF-8 BOM is stripped), comma, RFC 4180 quoting.

    With ``schema`` nothing is inferred (codes keep their leading zeros);
    ``check_header=True`` fails when the header names differ from the schema
    instead of mapping columns by position. Without ``schema`` every column
    is text (S3), to be typed explicitly afterwards.
    """
    reader = spark.read.option("header", header).option("multiLine", options.pop("multiLine", False))
    reader = reader.options(**CSV_READ_OPTIONS)
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", not check_header)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.csv(_paths(paths))


def drop_row_index(df: DataFrame, col: str = ROW_INDEX_COL) -> DataFrame:
    """Drop the unnamed leading row-index column of pandas-written CSVs."""
    return df.drop(col) if col in df.columns else df


def read_parts(spark: SparkSession, paths: Sequence[str], fmt: str = "parquet",
               schema: StructType | None = None, **options) -> DataFrame:
    """Many part files -> one table in a single scan (no driver loop of jobs).

    Parts written with different column orders are matched by name for
    self-describing formats; CSV parts need ``schema``.
    """
    if fmt == "csv":
        # The header is held against the schema: parts in another column order raise instead of swapping values.
        options = {"header": True, "enforceSchema": False} | options
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(list(paths))


def list_objects(spark: SparkSession, prefix: str, suffix: str | None = ".csv") -> DataFrame:
    """Object listing under ``prefix`` as a DataFrame (path, length, modificationTime).

    Uses the ``binaryFile`` source without selecting ``content``, so only the
    listing happens (in parallel for large prefixes) and no file is opened.
    Every object is listed (no 1000-key page limit).
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if suffix:
        reader = reader.option("pathGlobFilter", f"*{suffix}")
    return reader.load(prefix).select("path", "length", "modificationTime")


def keys_from_objects(listing: DataFrame, suffix: str = ".csv", key: str = "code") -> DataFrame:
    """Existing keys from object names (``prefix/CODE.csv`` or ``prefix/code=CODE/*.csv``)."""
    return listing.select(key_from_path("path", suffix).alias(key)).where(F.col(key).isNotNull()).distinct()


def existing_keys(spark: SparkSession, prefix: str, suffix: str = ".csv", key: str = "code") -> DataFrame:
    """S6 in one call: list ``prefix`` and return the distinct keys found."""
    return keys_from_objects(list_objects(spark, prefix, suffix), suffix, key)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on its (possibly remote) filesystem."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders directly under ``path``, sorted; none if it does not exist."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(st.getPath().getName() for st in fs.listStatus(p)) if fs.exists(p) else []


def delete_path(spark: SparkSession, path: str) -> bool:
    """Recursively delete ``path`` on its filesystem (used after a commit, never before)."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(fs.delete(p, True))


def read_manifest(spark: SparkSession, path: str, key: str = "code") -> DataFrame | None:
    """The manifest of codes to load, or ``None`` when there is none (nothing to do)."""
    if not path_exists(spark, path):
        return None
    m = read_csv(spark, path)
    return drop_row_index(m).select(F.col(key).cast("string").alias(key))
