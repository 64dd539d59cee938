"""Session construction and shared scratch space.

Scratch output (staged writes, stream checkpoints, round-trip files) always
lives under the cluster's checkpoint directory, which is a shared filesystem on
a real cluster (``spark.checkpoint.dir``). Only when the session has none (unit
tests, a laptop) do we create a local one.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings we want on every session we build ourselves. AQE re-plans joins at
# run time from real sizes (broadcast only below the threshold, sort-merge
# beyond it), coalesces small shuffle partitions and splits skewed ones.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Checkpoints (lineage cuts, materialised per-key sides) are deleted once
    # nothing references them any more, so daily runs do not accumulate them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "marketlake",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    On a cluster leave ``master`` unset (spark-submit decides) and size
    ``shuffle_partitions`` to roughly total input bytes / 128 MB; AQE then
    coalesces what turns out small.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The session's checkpoint directory; set a local one only when unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        # No cluster-wide setting: this is a local run or a test.
        configured = tempfile.mkdtemp(prefix="marketlake-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique directory path under the checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/marketlake/{name}-{uuid.uuid4().hex[:16]}"


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint (survives executor loss), never ``localCheckpoint``."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=eager)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver-generated table (``<sf_dir>/<name>.parquet``)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
