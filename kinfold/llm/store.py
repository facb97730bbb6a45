"""Tables between jobs, in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; only a local session without it gets its own folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="kinfold-shared-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def written(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write a table once and read it back: lineage ends here, and a lost executor costs a reread."""
    path = f"{shared_folder(df.sparkSession)}/kinfold/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
