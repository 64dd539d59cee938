"""marketlake — set-based operators for market and macro-economic data lakes on Spark.

Every public function takes and returns ``pyspark.sql.DataFrame`` (or ``Column``)
and is written with built-in Spark SQL expressions, so Catalyst can push filters
and projections into scans and whole-stage codegen covers the hot path.

Layout:

* ``marketlake.functions``  Column -> Column helpers (codes, dates, paths, maps, JSON)
* ``marketlake.sources``    scans: statistics envelopes, CSV, file listings, JDBC, catalog
* ``marketlake.operators``  reshape (pivot / group sum / union), ranking, history, volatility
* ``marketlake.sinks``      CSV / Parquet / ORC / Avro / JDBC writers, idempotent table loads
* ``marketlake.streaming``  run-once (availableNow) file ingestion and upsert
* ``marketlake.plans``      end-to-end jobs and the query catalogue used by the checks
"""

__version__ = "0.1.0"

from marketlake.session import build_session, scratch_path, checkpoint_root  # noqa: F401
