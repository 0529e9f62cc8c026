"""Tables written to the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: dict[str, list[str]] = {}


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where a session on one machine has none, a temporary folder that is set for it."""
    for key in ("spark.checkpoint.dir", "cartulary.local.checkpoint.dir"):
        if root := spark.conf.get(key, None):
            return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and the executors share")
    root = "file://" + tempfile.mkdtemp(prefix="cartulary-")
    spark.conf.set("cartulary.local.checkpoint.dir", root)
    spark.sparkContext.setCheckpointDir(root)
    return root


def materialize(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet and read back: its lineage ends there, and the files outlive executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/cartulary-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_tables(spark: SparkSession) -> int:
    """Deletes the tables that the session has written so far, once nothing that reads them will run any more."""
    paths = _written.pop(spark.sparkContext.applicationId, [])
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(conf).delete(at, True)
    return len(paths)
