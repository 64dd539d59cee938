"""Column -> Column helpers. All are built-in Spark expressions (codegen, no UDF)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- dates / text


def stat_time(c: ColumnOrName, freq: str = "D") -> Column:
    """Date or timestamp -> statistic TIME text: ``yyyyMMdd`` (D), ``yyyyMM`` (M), ``yyyy`` (A)."""
    pattern = {"D": "yyyyMMdd", "M": "yyyyMM", "A": "yyyy"}[freq]
    return F.date_format(_c(c), pattern)


def parse_year(c: ColumnOrName) -> Column:
    """``'1997'`` -> DATE 1997-01-01; anything unparsable -> NULL."""
    return F.try_to_date(_c(c).cast("string"), "yyyy")


def date_text(c: ColumnOrName) -> Column:
    """DATE/TIMESTAMP -> ``yyyy-MM-dd`` text."""
    return F.date_format(_c(c), "yyyy-MM-dd")


def to_date_or_null(c: ColumnOrName) -> Column:
    """Text -> DATE; bad text -> NULL (ANSI-safe)."""
    return _c(c).try_cast("date")


def to_decimal_or_null(c: ColumnOrName, precision: int = 8, scale: int = 2) -> Column:
    """Text/number -> DECIMAL(p,s) rounding HALF_UP; overflow or bad text -> NULL."""
    return _c(c).try_cast(DecimalType(precision, scale))


def to_double_or_null(c: ColumnOrName) -> Column:
    return _c(c).try_cast("double")


def cast_or_null(c: ColumnOrName, data_type: DataType | str) -> Column:
    return _c(c).try_cast(data_type)


# ---------------------------------------------------------------- codes / names


def zfill(c: ColumnOrName, width: int = 6) -> Column:
    """Left-pad with zeros to ``width``; longer values are kept whole (``lpad`` alone truncates)."""
    s = _c(c).cast("string")
    return F.when(F.length(s) < width, F.lpad(s, width, "0")).otherwise(s)


def int_code(c: ColumnOrName, width: int = 6) -> Column:
    """A code that was mis-read as a number -> zero-padded text (``5930`` -> ``005930``)."""
    return F.format_string(f"%0{width}d", _c(c).cast("long"))


def strip_quotes(c: ColumnOrName) -> Column:
    """Remove every single and double quote from a name."""
    return F.translate(_c(c), "'\"", "")


# ---------------------------------------------------------------- paths / URIs


def last_segment(c: ColumnOrName) -> Column:
    """``a/b/005930.csv`` -> ``005930.csv``."""
    return F.element_at(F.split(_c(c), "/"), -1)


def file_stem(c: ColumnOrName) -> Column:
    """``a/b/Korea.csv`` -> ``Korea`` (text before the first dot of the last segment)."""
    return F.element_at(F.split(last_segment(c), r"\."), 1)


def strip_suffix(c: ColumnOrName, suffix: str) -> Column:
    import re

    return F.regexp_replace(_c(c), re.escape(suffix) + "$", "")


def strip_prefix(c: ColumnOrName, prefix: str) -> Column:
    import re

    return F.regexp_replace(_c(c), "^" + re.escape(prefix), "")


def uri_bucket(c: ColumnOrName) -> Column:
    """``s3://bucket/key/part`` -> ``bucket``."""
    return F.regexp_extract(_c(c), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/]+)/?", 1)


def uri_key(c: ColumnOrName) -> Column:
    """``s3://bucket/key/part`` -> ``key/part``."""
    return F.regexp_extract(_c(c), r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/]+/(.*)$", 1)


def object_path(prefix: str, c: ColumnOrName, suffix: str = ".csv") -> Column:
    """``prefix + code + suffix`` (e.g. the per-code history object)."""
    return F.concat(F.lit(prefix), _c(c).cast("string"), F.lit(suffix))


def unescape_path_name(c: ColumnOrName) -> Column:
    """A partition directory's value as it was written: ``%5EGSPC`` -> ``^GSPC`` (a plus sign stays)."""
    return F.try_url_decode(F.replace(_c(c), F.lit("+"), F.lit("%2B")))


def key_from_path(c: ColumnOrName, suffix: str = ".csv") -> Column:
    """Object name -> key: the last segment without ``suffix``; NULL when the suffix differs.

    Handles both flat ``prefix/CODE.csv`` objects and Hive-style
    ``prefix/code=CODE/part-*.csv`` layouts.
    """
    import re

    path = _c(c)
    hive = F.regexp_extract(path, r"/[^/=]+=([^/]+)/[^/]*" + re.escape(suffix) + "$", 1)
    flat = F.regexp_extract(path, r"([^/]+)" + re.escape(suffix) + "$", 1)
    key = F.when(hive != "", unescape_path_name(hive)).otherwise(flat)
    return F.when(path.endswith(suffix), key)


# ---------------------------------------------------------------- lookups / JSON


def map_lookup(c: ColumnOrName, mapping: Mapping[str, str], default: str | None = None) -> Column:
    """Constant-map lookup; missing key (or NULL) -> ``default``."""
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    looked = F.try_element_at(F.create_map(*pairs), _c(c))
    return looked if default is None else F.coalesce(looked, F.lit(default))


def json_field(c: ColumnOrName, path: str, data_type: DataType | str = "string") -> Column:
    """Field of a JSON text column; absent or malformed -> NULL."""
    return F.get_json_object(_c(c), path).try_cast(data_type)
