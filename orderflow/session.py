"""Where intermediate tables live.

Stage boundaries are written as Parquet into the shared folder the cluster
names in ``spark.checkpoint.dir`` (an HDFS / object-store path on a cluster),
so they survive the loss of any executor and cut the logical plan. The
setting is read from the session; only when it is unset and Spark runs in local
mode (tests) a folder of the warehouse is used.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def _context(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # sessions without a local SparkContext (Spark Connect)
        return None


def app_id(spark: SparkSession) -> str:
    sc = _context(spark)
    return sc.applicationId if sc is not None else spark.conf.get("spark.app.id", "app")


def checkpoint_root(spark: SparkSession) -> str:
    root = spark.conf.get(CHECKPOINT_CONF, None)
    sc = _context(spark)
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if not root:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(
                f"{CHECKPOINT_CONF} is unset; set it to a shared folder (HDFS, object store) on a cluster"
            )
        root = f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints"
    return root.rstrip("/")


def new_work_dir(spark: SparkSession, label: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/orderflow/{app_id(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system holds it, if it is there."""
    sc = _context(spark)
    if sc is None:
        return
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)
