"""Tables written in the middle of a job and read back.

A staged table is computed once however many steps read it, a lost executor does not bring
back the work before it, and its size is known to the planner, which can then broadcast it
when it is small and shuffle when it is not.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from tillroll.sources.tables import write_table

_local_area: tempfile.TemporaryDirectory | None = None


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; on a local master without one, a new one."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    global _local_area
    if _local_area is None:
        _local_area = tempfile.TemporaryDirectory(prefix="tillroll-")
    return _local_area.name


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder nobody else uses. It is deleted when the application ends, because a table
    in it may be read as long as that."""
    folder = f"{shared_folder(spark)}/tillroll-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return f"{folder}/{name}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new table in the shared folder and return that table."""
    return write_table(df, new_folder(df.sparkSession, name))
