"""Statistic API responses (JSON envelope) -> long rows.

``{"StatisticSearch": {"row": [{14 fields}, ...]}}``. Exactly the declared
fields are kept (absent -> NULL, unknown -> dropped). A document without the
envelope (an error or "no data" answer) yields no rows, or raises in strict mode.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marketlake.operators.common import PER_KEY_BROADCAST_ROWS
from marketlake.schemas import STAT_ROW_TEXT, envelope_schema

FILE_ORDER = ["source_file", "row_pos"]
LINE_ORDER = ["source_file", "source_block", "source_line", "row_pos"]


def parse_statistics(
    df: DataFrame,
    doc_col: str,
    row_schema: StructType = STAT_ROW_TEXT,
    root: str = "StatisticSearch",
    keep: Sequence[str] = (),
    strict: bool = False,
    with_position: bool = False,
    position: str = "row_pos",
) -> DataFrame:
    """Explode envelope documents held in a text column into one row per record.

    ``with_position`` adds the record's 0-based position in its document, the
    natural "input order" for pivot-first.
    """
    # Text that is not JSON raises (a truncated download); JSON without the envelope has no rows.
    parsed = F.from_json(F.col(doc_col), envelope_schema(row_schema, root), {"mode": "FAILFAST"})
    rows = F.col("__env").getField(root).getField("row")
    if strict:
        rows = F.when(rows.isNull(), F.raise_error(F.lit(f"response without {root}.row"))).otherwise(rows)
    exploded = df.select(*keep, parsed.alias("__env")).select(*keep, F.posexplode(rows).alias(position, "__r"))
    cols = [*keep, "__r.*"] + ([position] if with_position else [])
    return exploded.select(*cols)


def read_statistics(
    spark: SparkSession,
    paths: str | Sequence[str],
    row_schema: StructType = STAT_ROW_TEXT,
    root: str = "StatisticSearch",
    strict: bool = False,
    json_lines: bool = False,
) -> DataFrame:
    """Landed response files -> long rows.

    Default: one JSON document per file (an API response); files are
    independent tasks, and ``source_file, row_pos`` (the record's position in
    its response) is the input order. ``json_lines=True``: one envelope per
    line, so large files split across tasks; ``source_file, source_block, source_line,
    row_pos`` (``LINE_ORDER``) is the input order. One huge document: ``read_large_statistics``.
    Documents are parsed with the explicit schema, never inferred.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if json_lines:
        # A block of a file is read by one task from its start to its end, so the ids ascend with its lines.
        docs = spark.read.text(paths).select(
            F.col("value").alias("__doc"), F.col("_metadata.file_path").alias("source_file"),
            F.col("_metadata.file_block_start").alias("source_block"), F.monotonically_increasing_id().alias("source_line"))
        return parse_statistics(docs, "__doc", row_schema, root, keep=LINE_ORDER[:-1], strict=strict,
                                with_position=True)
    docs = spark.read.text(paths, wholetext=True).select(
        F.col("value").alias("__doc"), F.col("_metadata.file_path").alias("source_file")
    )
    return parse_statistics(docs, "__doc", row_schema, root, keep=["source_file"], strict=strict,
                            with_position=True)


def read_large_statistics(
    spark: SparkSession,
    paths: str | Sequence[str],
    row_schema: StructType = STAT_ROW_TEXT,
    root: str = "StatisticSearch",
    strict: bool = False,
) -> DataFrame:
    """Landed response files, each one JSON document of any size -> long rows (``source_file, row_pos``, fields).

    Files are read in pieces that end with a closing brace, so a document is split over
    tasks like any text. A brace ends a record unless it stands in a string, that is after
    an odd number of quotes; the quotes before a block are summed up from the blocks' own
    counts. A record cut by a brace in a string, or by a block's end, is joined again. No task holds more than a
    block of a file (``spark.sql.files.maxPartitionBytes``) or one record. Records are flat objects, as the
    provider sends them. A document without the envelope has no rows, or raises with ``strict``; one that breaks off raises.
    """
    file, block = "source_file", "__block"
    landed = spark.read.option("lineSep", "}").text([paths] if isinstance(paths, str) else list(paths))
    pieces = landed.select(
        F.col("value").alias("__text"), F.col("_metadata.file_path").alias(file), F.col("_metadata.file_block_start").alias(block), F.monotonically_increasing_id().alias("__n"))
    plain = F.regexp_replace("__text", r"\\.", "")  # without escaped characters
    pieces = pieces.withColumn("__quotes", F.length(plain) - F.length(F.replace(plain, F.lit('"'), F.lit(""))))
    inside, so_far = Window.partitionBy(file, block).orderBy("__n"), Window.partitionBy(file).orderBy(block)  # a block's pieces; a file's blocks
    pieces = pieces.withColumn("__quotes", F.sum("__quotes").over(inside))

    def before(column: str, of: DataFrame, agg) -> DataFrame:
        """Per block, what the blocks of its file before it add up to."""
        own = of.groupBy(file, block).agg(agg.alias("__own"))
        return own.select(file, block, (F.sum("__own").over(so_far) - F.col("__own")).alias(column))

    pieces = pieces.join(before("__open", pieces, F.max("__quotes")), [file, block])
    ends = ((F.col("__quotes") + F.col("__open")) % 2 == 0).cast("long")  # the brace after the piece ends a record
    pieces = pieces.select(file, block, "__n", "__text", ends.alias("__ends"))
    pieces = pieces.withColumn("__rec", F.sum("__ends").over(inside) - F.col("__ends"))
    pieces = pieces.join(before("__records", pieces, F.sum("__ends")), [file, block])
    part = F.struct(block, "__n", "__text")
    records = pieces.groupBy(file, (F.col("__rec") + F.col("__records")).alias("row_pos")).agg(F.array_sort(F.collect_list(part)).alias("__parts"))
    text = F.array_join(F.col("__parts")["__text"], "}")
    # The first record follows the head of the document, the others a comma; the list ends with a bracket.
    head = rf'(?s)^\s*\{{\s*"{root}"\s*:\s*\{{.*?"row"\s*:\s*\[\s*'
    body = F.when(F.col("row_pos") == 0, F.when(F.regexp_like(text, F.lit(head)), F.regexp_replace(text, head, ""))).otherwise(F.regexp_replace(text, r"^\s*,\s*", ""))
    records = records.select(file, "row_pos", text.alias("__text"), body.alias("__body"))
    bracket = F.regexp_like("__text", F.lit(r"^\s*\]")) | ((F.col("row_pos") == 0) & F.regexp_like("__body", F.lit(r"^\s*\]")))
    shape = records.groupBy(file).agg(F.min(F.when(bracket, F.col("row_pos"))).alias("__end"), F.max((F.col("row_pos") == 0) & F.col("__body").isNotNull()).alias("__listed"))
    if len(landed.inputFiles()) <= PER_KEY_BROADCAST_ROWS:  # one row per file: a document's records stay in the tasks that they are in
        shape = F.broadcast(shape)
    rows = records.join(shape, file)
    broken = F.raise_error(F.concat(F.lit("a document that breaks off: "), F.col(file))).cast("string")
    missing = F.raise_error(F.concat(F.lit(f"response without {root}.row: "), F.col(file))).cast("string") if strict else F.lit(None).cast("string")
    body = F.when(~F.col("__listed"), F.when(F.col("row_pos") == 0, missing)).when(F.col("__end").isNull(), broken).when(F.col("row_pos") < F.col("__end"), F.concat("__body", F.lit("}")))
    parsed = F.from_json("__body", row_schema, {"mode": "FAILFAST"}).alias("__r")
    return rows.withColumn("__body", body).where(F.col("__body").isNotNull()).select(file, "row_pos", parsed).select(file, "row_pos", "__r.*")


def to_stat_long(rows: DataFrame) -> DataFrame:
    """Text record -> typed long table (DATA_VALUE double; bad numbers -> NULL)."""
    return rows.withColumn("DATA_VALUE", F.col("DATA_VALUE").try_cast("double"))
