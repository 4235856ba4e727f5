"""Session helpers: a local session for tests/bench and lineage cutting.

Iterative operators (greedy suppression on large groups, furthest point
sampling, hierarchy closure) cut lineage with ``DataFrame.checkpoint()``
into the folder named by ``spark.checkpoint.dir``.  On a cluster that
folder must be shared storage and is set by the cluster; only a local
master without the setting gets a fresh private folder (tests, bench).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

_LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.driver.memory": "16g",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_spark(cores: int | str = "*", app: str = "kestrel", extra: dict | None = None) -> SparkSession:
    """Local session used by tests and the bench (clusters bring their own)."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in {**_LOCAL_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, reading ``spark.checkpoint.dir`` first.

    A private folder is created only for a local master with no setting.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return conf
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="kestrel-ckpt-", dir=os.environ.get("KESTREL_SCRATCH", "/tmp"))
    sc.setCheckpointDir(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (survives executor loss); never localCheckpoint."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
