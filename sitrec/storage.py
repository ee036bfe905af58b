"""Where intermediate tables live.

A cluster names a shared folder in ``spark.checkpoint.dir``; checkpoints and written
tables go there.  Only a local session without that setting gets a folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's shared folder, also set as the context's checkpoint folder."""
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="sitrec-"))
    return sc.getCheckpointDir()


def new_path(spark: SparkSession, name: str) -> str:
    """A path nobody has written to yet, inside the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table of this session that nothing reads any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back: lineage ends, the size is known to the optimizer."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_table(table: DataFrame) -> None:
    """Delete a table that ``written`` gave and nothing reads any more."""
    for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
        remove(table.sparkSession, folder)
