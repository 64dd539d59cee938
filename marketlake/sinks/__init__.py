"""Writers: CSV, gzip CSV, Parquet, ORC, Avro, JDBC; idempotent and atomic table loads."""
