"""Job entry points for spark-submit / a scheduler: ``python -m marketlake <job> ...``.

Each sub-command only maps arguments onto one function of ``marketlake.plans``;
dates, paths, table names and connection properties are always explicit.
Tables live in the session's catalog (a metastore on a cluster).
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import functions as F

SERIES = ("exchange_rate", "interest_rates", "kospi", "news_sentiment", "gdp", "financial_statements")


def _props(pairs: list[str]) -> dict[str, str]:
    return dict(p.split("=", 1) for p in pairs or [])


def _read(spark, path: str, fmt: str, ddl: str | None = None):
    """Read an input; with ``ddl`` (``"code string, date date, ..."``) keep exactly
    those columns, cast to those types (text CSV inputs become typed)."""
    from pyspark.sql.types import StructType

    from marketlake.sources.files import read_csv

    df = read_csv(spark, path) if fmt == "csv" else spark.read.format(fmt).load(path)
    if ddl is None:
        return df
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in StructType.fromDDL(ddl).fields])


HISTORY_DDL = "code string, date date, price double, row_key long"


def run_series(spark, a) -> None:
    from marketlake.plans import jobs, series
    from marketlake.sources.statistics import FILE_ORDER, LINE_ORDER, read_large_statistics, read_statistics, to_stat_long

    if a.large:
        long = to_stat_long(read_large_statistics(spark, a.landing, strict=a.strict))
    else:
        long = to_stat_long(read_statistics(spark, a.landing, strict=a.strict, json_lines=a.json_lines))
    order = LINE_ORDER if a.json_lines and not a.large else FILE_ORDER
    publish = (lambda shape, sort_by, evolve=False: jobs.series_job(long, shape, a.raw, a.processed, a.table, a.root, sort_by, evolve))
    if a.series == "exchange_rate":
        publish(lambda raw: series.exchange_rate(raw, order), ["TIME"])
    elif a.series == "interest_rates":
        publish(lambda raw: series.interest_rates(raw, order), ["TIME"])
    elif a.series == "kospi":
        publish(lambda raw: series.kospi(raw, order), ["TIME"], evolve=True)
    elif a.series == "news_sentiment":
        publish(series.news_sentiment, ["TIME"])
    elif a.series == "gdp":
        publish(lambda raw: series.gdp(series.country_from_file(raw)), ["country", "Date"])
    else:
        publish(lambda raw: series.financial_statements(raw, order), ["Date"], evolve=True)


def run_rank_publish(spark, a) -> None:
    from marketlake.plans import jobs

    listing = _read(spark, a.listing, a.listing_format)  # one row per company: position, name, code
    rows = listing.select(F.col(a.order_col).cast("int").alias("pos"), "name", "code")
    metadata = _read(spark, a.metadata, a.metadata_format, "code string, exchange string")
    jobs.rank_publish_rows(rows, metadata, a.csv, a.table, a.root)


def run_snapshot(spark, a) -> None:
    from marketlake.sinks.tables import truncate_reload, with_run_date

    listing = _read(spark, a.listing, a.listing_format).select(
        F.col(a.name_col).alias("name"), F.col(a.code_col).cast("string").alias("code"))
    truncate_reload(with_run_date(listing, a.as_of), a.table, a.root)


def run_per_key_upsert(spark, a) -> None:
    from pyspark.sql.types import StructType

    from marketlake.sinks.files import drop_key_dirs, upsert_per_key

    schema = StructType.fromDDL(a.schema)
    incoming = _read(spark, a.incoming, a.incoming_format).select(*[f.name for f in schema.fields])
    upsert_per_key(spark, a.path, incoming, schema, fmt=a.format, rewrite=a.rewrite)
    if a.keep:
        drop_key_dirs(spark, a.path, _read(spark, a.keep, a.keep_format, "code string"))


def run_history_refresh(spark, a) -> None:
    from marketlake.plans import jobs

    listing = _read(spark, a.listing, a.listing_format, "code string, name string")
    prices = _read(spark, a.prices, a.prices_format, HISTORY_DDL)
    jobs.history_refresh_job(listing, prices, a.table, a.manifest, a.start)


def run_manifest_load(spark, a) -> None:
    from marketlake.plans import jobs

    jobs.manifest_load_job(spark, a.manifest, a.history_csv, a.table)


def run_manifest_publish(spark, a) -> None:
    from marketlake.plans import jobs

    jobs.manifest_jdbc_load_job(spark, a.manifest, a.history_csv, a.url, a.table, _props(a.prop))


def run_vacuum(spark, a) -> None:
    from marketlake.sinks.tables import vacuum_versions

    vacuum_versions(spark, a.table, a.root, a.keep_previous)


def _store(spark, a):
    from pyspark.sql.types import StructType

    from marketlake.sinks.history_store import HistoryStore

    return HistoryStore(spark, a.store, StructType.fromDDL(a.schema), buckets=a.buckets)


def run_store_refresh(spark, a) -> None:
    from marketlake.plans import store_jobs

    listing = _read(spark, a.listing, a.listing_format, "code string, name string")
    store_jobs.refresh_store_job(listing, _read(spark, a.prices, a.prices_format, HISTORY_DDL), _store(spark, a), a.manifest, a.start)


def run_store_stream(spark, a) -> None:
    from marketlake.streaming.keyed import stream_into_store

    stream_into_store(spark, a.landing, _store(spark, a), a.checkpoint, fmt=a.format)


def run_store_retention(spark, a) -> None:
    from marketlake.plans import store_jobs

    store_jobs.retention_stores_job(_store(spark, a), a.objects, _read(spark, a.keep, a.keep_format, "code string"), a.intents)


def run_store_vacuum(spark, a) -> None:
    store = _store(spark, a)
    store.compact(a.most_loads)
    store.vacuum()


def run_volatility(spark, a) -> None:
    from marketlake.plans import jobs

    ranked = _read(spark, a.ranked, a.ranked_format, "ranking int, code string")
    history = _read(spark, a.history, a.history_format, HISTORY_DDL)
    jobs.top_volatility_job(ranked, history, a.table, a.root, a.k, a.threshold,
                            code_width=a.code_width or None)


def run_retention(spark, a) -> None:
    from marketlake.plans import jobs

    jobs.retention_job(a.table, _read(spark, a.keep, a.keep_format, "code string"), a.root)


def run_replicate(spark, a) -> None:
    from marketlake.plans import jobs

    jobs.replicate_schema_job(spark, a.database, a.url, _props(a.prop), a.target_prefix, a.parallel, a.staging)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="marketlake")
    sub = p.add_subparsers(dest="job", required=True)

    s = sub.add_parser("series", help="macro series: landed responses -> wide table")
    s.add_argument("series", choices=SERIES)
    s.add_argument("--landing", required=True)
    s.add_argument("--table", required=True)
    s.add_argument("--root", required=True, help="directory holding table versions")
    s.add_argument("--raw", help="raw zone path; without it nothing is landed")
    s.add_argument("--processed", help="processed CSV path; without it no CSV is written")
    s.add_argument("--strict", action="store_true", help="fail on a response without data")
    s.add_argument("--json-lines", action="store_true", help="one response per line instead of per file")
    s.add_argument("--large", action="store_true", help="documents too large for one task each: read them record by record")
    s.set_defaults(run=run_series)

    s = sub.add_parser("rank-publish", help="ranking page -> ranked, exchange-coded table")
    s.add_argument("--listing", required=True)
    s.add_argument("--listing-format", default="csv")
    s.add_argument("--order-col", default="position", help="column giving the page order")
    s.add_argument("--metadata", required=True, help="code, exchange")
    s.add_argument("--metadata-format", default="parquet")
    s.add_argument("--csv", required=True)
    s.add_argument("--table", required=True)
    s.add_argument("--root", required=True)
    s.set_defaults(run=run_rank_publish)

    s = sub.add_parser("snapshot", help="the day's listing stamped with the run date, replace-loaded")
    s.add_argument("--listing", required=True)
    s.add_argument("--listing-format", default="csv")
    s.add_argument("--name-col", default="CompanyName")
    s.add_argument("--code-col", default="CompanyCode")
    s.add_argument("--as-of", required=True, help="run date, yyyy-MM-dd (never the wall clock)")
    s.add_argument("--table", required=True)
    s.add_argument("--root", required=True)
    s.set_defaults(run=run_snapshot)

    s = sub.add_parser("per-key-upsert", help="per-code history directories: add newer days")
    s.add_argument("--path", required=True)
    s.add_argument("--incoming", required=True)
    s.add_argument("--incoming-format", default="parquet")
    s.add_argument("--schema", default=HISTORY_DDL)
    s.add_argument("--format", default="parquet")
    s.add_argument("--rewrite", action="store_true", help="replace touched code directories instead of appending")
    s.add_argument("--keep", help="listing of codes to keep; directories of other codes are dropped")
    s.add_argument("--keep-format", default="csv")
    s.set_defaults(run=run_per_key_upsert)

    s = sub.add_parser("history-refresh", help="append new days / backfill new codes")
    s.add_argument("--listing", required=True)
    s.add_argument("--listing-format", default="csv")
    s.add_argument("--prices", required=True)
    s.add_argument("--prices-format", default="parquet")
    s.add_argument("--table", required=True)
    s.add_argument("--manifest", required=True)
    s.add_argument("--start")
    s.set_defaults(run=run_history_refresh)

    s = sub.add_parser("manifest-load", help="load the history of the codes in the manifest")
    s.add_argument("--manifest", required=True)
    s.add_argument("--history-csv", required=True)
    s.add_argument("--table", required=True)
    s.set_defaults(run=run_manifest_load)

    s = sub.add_parser("manifest-publish", help="load the history of the codes in the manifest into a warehouse, in one transaction")
    s.add_argument("--manifest", required=True)
    s.add_argument("--history-csv", required=True)
    s.add_argument("--url", required=True)
    s.add_argument("--table", required=True)
    s.add_argument("--prop", action="append", help="JDBC property key=value (user, password, driver)")
    s.set_defaults(run=run_manifest_publish)

    s = sub.add_parser("vacuum", help="delete old versions of a table")
    s.add_argument("--table", required=True)
    s.add_argument("--root", required=True)
    s.add_argument("--keep-previous", type=int, default=1)
    s.set_defaults(run=run_vacuum)

    def store_parser(name: str, run, text: str, schema: str = HISTORY_DDL):
        s = sub.add_parser(name, help=text)
        s.add_argument("--store", required=True, help="path of the history store")
        s.add_argument("--schema", default=schema)
        s.add_argument("--buckets", type=int, default=16, help="fixed for the life of the store")
        s.set_defaults(run=run)
        return s

    s = store_parser("store-refresh", run_store_refresh, "append new days / backfill new codes in a history store",
                     "code string, name string, date date, price double, row_key long")
    s.add_argument("--listing", required=True)
    s.add_argument("--listing-format", default="csv")
    s.add_argument("--prices", required=True)
    s.add_argument("--prices-format", default="parquet")
    s.add_argument("--manifest", required=True)
    s.add_argument("--start")

    s = store_parser("store-stream", run_store_stream, "newly landed files -> history store, once")
    s.add_argument("--landing", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--format", default="parquet")

    s = store_parser("store-retention", run_store_retention, "drop codes no longer listed from a history store and from their objects")
    s.add_argument("--objects", required=True, help="folder with one code=... folder per code")
    s.add_argument("--keep", required=True)
    s.add_argument("--keep-format", default="csv")
    s.add_argument("--intents", required=True, help="where deletes are written down until they are done")

    s = store_parser("store-vacuum", run_store_vacuum, "compact a history store and delete what no version reads")
    s.add_argument("--most-loads", type=int, default=8)

    s = sub.add_parser("volatility", help="high-volatility rows of the top-k codes")
    s.add_argument("--ranked", required=True)
    s.add_argument("--ranked-format", default="csv")
    s.add_argument("--history", required=True)
    s.add_argument("--history-format", default="parquet")
    s.add_argument("--table", required=True)
    s.add_argument("--root", required=True)
    s.add_argument("--k", type=int, default=3)
    s.add_argument("--threshold", type=float, default=5.0)
    s.add_argument("--code-width", type=int, default=6, help="zero-pad numeric codes; 0 keeps them (tickers)")
    s.set_defaults(run=run_volatility)

    s = sub.add_parser("retention", help="drop the history of codes no longer listed")
    s.add_argument("--table", required=True)
    s.add_argument("--keep", required=True)
    s.add_argument("--keep-format", default="csv")
    s.add_argument("--root", required=True)
    s.set_defaults(run=run_retention)

    s = sub.add_parser("replicate", help="copy every table of a database over JDBC")
    s.add_argument("--database", required=True)
    s.add_argument("--url", required=True)
    s.add_argument("--prop", action="append", help="JDBC property key=value (user, password, driver)")
    s.add_argument("--target-prefix", default="")
    s.add_argument("--parallel", type=int, default=4)
    s.add_argument("--staging")
    s.set_defaults(run=run_replicate)
    return p


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    from marketlake.session import build_session

    spark = build_session(app_name=f"marketlake-{args.job}")
    args.run(spark, args)
    return 0


if __name__ == "__main__":
    sys.exit(main())
