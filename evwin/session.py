"""Session construction and lineage-cutting helpers."""

from __future__ import annotations

import os
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Local/test defaults.  On a cluster the session is handed to us already
# configured; we only fill in what is unset.
_LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # local runs: keep small shuffles spread over the cores instead of
    # coalescing everything below 1 MB into one task
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    # Broadcast only what the runtime statistics prove small; beyond it the
    # planner keeps the shuffle (sort-merge) join.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "evwin", conf: dict[str, str] | None = None) -> SparkSession:
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", os.environ.get("EVWIN_DRIVER_MEM", "8g")))
    for k, v in (_LOCAL_CONF | (conf or {})).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in
    ``spark.checkpoint.dir``; only when it is unset (local tests) pick one."""
    d = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir is not set: a cluster has to name a shared folder")
        d = os.environ.get("EVWIN_CHECKPOINT_DIR") or "/tmp/evwin-checkpoints"
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(d)
    return d


_SCRATCH: ContextVar[str | None] = ContextVar("scratch", default=None)


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder under the shared checkpoint folder that nothing else uses."""
    base = _SCRATCH.get() or f"{ensure_checkpoint_dir(spark).rstrip('/')}/evwin"
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def scratch(spark: SparkSession):
    """What is materialized inside goes into one folder, removed at the end: for runs
    that write all their results, so that nothing of them is read later."""
    folder = new_folder(spark, "run")
    before = _SCRATCH.set(folder)
    try:
        yield folder
    finally:
        _SCRATCH.reset(before)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet under the shared checkpoint folder and read it
    back: cuts lineage (survives executor loss) and lets several consumers
    reuse one computation.  Each call writes a fresh sub-folder."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)
