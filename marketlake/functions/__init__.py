"""Column -> Column helpers (built-in expressions only)."""

from marketlake.functions.scalars import (  # noqa: F401
    cast_or_null,
    date_text,
    file_stem,
    int_code,
    json_field,
    key_from_path,
    last_segment,
    map_lookup,
    object_path,
    parse_year,
    stat_time,
    strip_prefix,
    strip_quotes,
    strip_suffix,
    to_date_or_null,
    to_decimal_or_null,
    to_double_or_null,
    uri_bucket,
    uri_key,
    zfill,
)
