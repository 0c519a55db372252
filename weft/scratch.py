"""Intermediate tables in the folder that driver and executors share.

Lineage is cut by writing Parquet below ``spark.checkpoint.dir``. A machine-local
folder is used only where the setting is absent *and* the master is local.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a temporary one on a local master only."""
    base = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getConf().get("spark.checkpoint.dir", "")
    if base:
        path = spark._jvm.org.apache.hadoop.fs.Path(base)
        full = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
        return full.replace("file:/", "file:///", 1) if full[:6] == "file:/" and full[:7] != "file://" else full
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return "file://" + os.path.join(tempfile.gettempdir(), "checkpoints")


def _delete(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # the session may have ended
        hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
        hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


#: Folders in use: a weak reference of the JVM to the plan that reads one, and its path.
_IN_USE: list[tuple] = []


def sweep(spark: SparkSession) -> None:
    """Delete the folders whose plan, and every plan made from it, is gone."""
    for entry in list(_IN_USE):
        with contextlib.suppress(Exception):
            if entry[0].get() is None:
                _IN_USE.remove(entry)
                _delete(spark, entry[1])


class Scratch:
    """Tables of one run; they go some time after the plan bound by :meth:`bind` is unreachable."""

    def __init__(self, spark: SparkSession, name: str):
        sweep(spark)
        self.spark = spark
        self.root = f"{shared_dir(spark)}/weft/{name}-{uuid.uuid4().hex}"
        self._n = 0

    def path(self, name: str) -> str:
        self._n += 1
        return f"{self.root}/{self._n}-{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._weft_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that no pending plan reads any more."""
        for table in tables:
            _delete(self.spark, table._weft_path)

    def bind(self, df: DataFrame) -> DataFrame:
        plan = df._jdf.queryExecution().commandExecuted()
        _IN_USE.append((self.spark._jvm.java.lang.ref.WeakReference(plan), self.root))
        return df
