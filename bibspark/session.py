"""Session helpers shared by all operators."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
_written: dict[int, list[str]] = {}


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the cluster names; a private one only where none is set (local tests)."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    shared = spark.conf.get(CHECKPOINT_CONF, None)
    if shared is None and not sc.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
    sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="bibspark-ckpt-"))


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as a compressed table in the shared folder and read it back, without lineage.

    The files survive the loss of executors; they are deleted when the driver ends or by ``release``.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/bibspark-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if id(spark.sparkContext) not in _written:
        atexit.register(release, spark)
    _written.setdefault(id(spark.sparkContext), []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Delete what ``cut`` wrote; frames that were made from it can't be read any more."""
    paths = _written.pop(id(spark.sparkContext), [])
    try:
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        for p in paths:
            target = jvm.org.apache.hadoop.fs.Path(p)
            target.getFileSystem(conf).delete(target, True)
    except Exception:  # the session has ended already
        pass


def parallelism(spark: SparkSession) -> int:
    """Shuffle partitions the session asks for; the unit all explicit repartitions scale with."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
