"""A folder on shared storage for tables that several later stages read.

A written table cuts lineage and survives lost executors. The parent folder is the one the
session names in ``spark.checkpoint.dir``; a machine-local folder is used only in local mode.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_local_root: str | None = None


def shared_root(spark: SparkSession) -> str:
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    global _local_root
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="shopscope-")
    return _local_root


class Workspace:
    """Writes named tables below one fresh folder and reads them back.

    The folder goes when it is discarded, and at the latest when the application ends, as a result
    that is computed lazily may read it until then.
    """

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark = spark
        self.path = path or f"{shared_root(spark)}/run-{uuid.uuid4().hex}"
        folder, system = self._folder()
        system.mkdirs(folder)
        system.deleteOnExit(folder)  # is forgotten for a folder that does not exist

    def _folder(self):
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return folder, folder.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def location(self, name: str) -> str:
        return f"{self.path}/{name}"

    def store(self, name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(self.location(name))
        return self.read(name, df)

    def keep(self, name: str, df: DataFrame) -> DataFrame:
        """Store a large table in little room, and remove the shuffle files it was made with as soon as it is written.

        Those of a lazy plan stay until all of it has run, and longer.
        """
        before = self.spark.conf.get(_CLEANUP, None)
        self.spark.conf.set(_CLEANUP, "true")
        try:
            df.write.mode("overwrite").option("compression", "zstd").parquet(self.location(name))
        finally:
            if before is None:
                self.spark.conf.unset(_CLEANUP)
            else:
                self.spark.conf.set(_CLEANUP, before)
        return self.read(name, df)

    def drop(self, name: str) -> None:
        """Delete one table that nothing reads any more."""
        folder, system = self._folder()
        system.delete(self.spark._jvm.org.apache.hadoop.fs.Path(folder, name), True)

    def discard(self) -> None:
        """Delete the folder, once nothing reads its tables any more."""
        folder, system = self._folder()
        system.delete(folder, True)

    def read(self, name: str, like: DataFrame) -> DataFrame:
        return self.spark.read.schema(like.schema).parquet(self.location(name))
