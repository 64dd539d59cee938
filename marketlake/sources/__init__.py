"""Scans: statistic envelopes, CSV / Parquet / ORC files, file listings, JDBC and catalog."""
