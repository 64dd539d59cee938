"""Explicit schemas for every table the jobs read or write.

Nothing is inferred: inference turns 6-digit codes such as ``005930`` into
integers and makes pivot widths depend on the data.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# The 14 fields of one statistic record, in the provider's order.
STAT_FIELDS = [
    "STAT_CODE", "STAT_NAME", "ITEM_CODE1", "ITEM_NAME1", "ITEM_CODE2",
    "ITEM_NAME2", "ITEM_CODE3", "ITEM_NAME3", "ITEM_CODE4", "ITEM_NAME4",
    "UNIT_NAME", "WGT", "TIME", "DATA_VALUE",
]

# As delivered in the JSON envelope every field is text.
STAT_ROW_TEXT = StructType([StructField(f, StringType(), True) for f in STAT_FIELDS])

# Long statistics table once landed: TIME stays text (yyyyMMdd / yyyy), value is numeric.
STAT_LONG = StructType(
    [StructField(f, StringType(), True) for f in STAT_FIELDS[:-1]]
    + [StructField("DATA_VALUE", DoubleType(), True)]
)


def envelope_schema(row_schema: StructType = STAT_ROW_TEXT, root: str = "StatisticSearch") -> StructType:
    """``{root: {"row": [row, ...]}}``."""
    return StructType([
        StructField(root, StructType([StructField("row", ArrayType(row_schema), True)]), True)
    ])


# Ranked company list as published (us top 100): ranking INT, name, code, excode.
RANKED_LIST = StructType([
    StructField("ranking", IntegerType(), False),
    StructField("name", StringType(), True),
    StructField("code", StringType(), True),
    StructField("excode", StringType(), True),
])

# KR top list snapshot table: date, name, code.
TOP_SNAPSHOT = StructType([
    StructField("date", DateType(), False),
    StructField("name", StringType(), True),
    StructField("code", StringType(), True),
])

# Warehouse price history: date DATE, name, code, open_value NUMERIC(8,2).
PRICE_HISTORY = StructType([
    StructField("date", DateType(), True),
    StructField("name", StringType(), True),
    StructField("code", StringType(), True),
    StructField("open_value", DecimalType(8, 2), True),
])

# Landed history CSV, read all-text then typed (unnamed row index first).
US_HISTORY_TEXT = StructType([
    StructField("_c0", StringType(), True),
    StructField("Name", StringType(), True),
    StructField("Code", StringType(), True),
    StructField("Date", StringType(), True),
    StructField("OpenValue", StringType(), True),
])

# Declared record of the Avro history files (Date as text, prices float32).
AVRO_HISTORY_FIELDS = [
    ("Date", StringType()),
    ("Open", FloatType()),
    ("High", FloatType()),
    ("Low", FloatType()),
    ("Close", FloatType()),
    ("Volume", FloatType()),
    ("Change", FloatType()),
    ("name", StringType()),
    ("code", StringType()),
]
AVRO_REQUIRED = ["Date", "name", "code"]
AVRO_HISTORY = StructType([StructField(n, t, n not in AVRO_REQUIRED) for n, t in AVRO_HISTORY_FIELDS])

AVRO_HISTORY_JSON = """{
  "type": "record", "name": "StockData",
  "fields": [
    {"name": "Date", "type": "string"},
    {"name": "Open", "type": ["float", "null"]},
    {"name": "High", "type": ["float", "null"]},
    {"name": "Low", "type": ["float", "null"]},
    {"name": "Close", "type": ["float", "null"]},
    {"name": "Volume", "type": ["float", "null"]},
    {"name": "Change", "type": ["float", "null"]},
    {"name": "name", "type": "string"},
    {"name": "code", "type": "string"}
  ]
}"""

# Output of the volatility rule (ours; the reference's is external).
VOLATILITY = StructType([
    StructField("code", StringType(), True),
    StructField("date", DateType(), True),
    StructField("price", DoubleType(), True),
    StructField("prev_price", DoubleType(), True),
    StructField("change", DoubleType(), True),
])

# Manifest of newly backfilled codes (unnamed index, code).
MANIFEST = StructType([
    StructField("_c0", StringType(), True),
    StructField("code", StringType(), True),
])

LONG = LongType()
