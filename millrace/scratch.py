"""Written intermediate results in the folder that all machines share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: list[str] = []


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder that ``spark.checkpoint.dir`` names.

    Only a local master may do without: it gets a temporary folder. A cluster's
    machines would each write to their own disk, so there it is an error.
    """
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        where = tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(where)
    return where


def scratch_path(spark: SparkSession, name: str = "rows") -> str:
    """A new path in the shared folder, which ``clear_scratch`` removes."""
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def staged(df: DataFrame, *by: str) -> DataFrame:
    """Write ``df`` to the shared folder, in a folder for each value of ``by`` if given, and read it back.

    This cuts the lineage: what was computed survives the loss of executors
    and is not computed again by each later reader.
    """
    path = scratch_path(df.sparkSession)
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Remove what this application wrote to the shared folder. To be called when results that read it are saved."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    while _written:
        path = jvm.org.apache.hadoop.fs.Path(_written.pop())
        path.getFileSystem(conf).delete(path, True)
