"""Session helpers: where intermediate tables live and how they are written."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Largest table, in bytes of raw doubles, that is broadcast or collected.
BOUNDED_BYTES = 16 * 1024 * 1024


def fits_bound(rows: int, doubles_per_row: int) -> bool:
    """True when ``rows`` x ``doubles_per_row`` doubles stay inside ``BOUNDED_BYTES``."""
    return rows * doubles_per_row * 8 <= BOUNDED_BYTES


def checkpoint_folder(spark: SparkSession) -> str:
    """Shared folder for intermediate tables, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder; on a cluster such a folder would not
    be visible to other executors, so a missing setting is an error there.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="gridlloyd-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


class Scratch:
    """A private sub-folder of the checkpoint folder holding written intermediate tables.

    Writing a table cuts the lineage, and the files outlive any executor.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.path = f"{checkpoint_folder(spark)}/gridlloyd-{uuid.uuid4().hex}"

    def write(self, df: DataFrame, name: str, partition_by: str | None = None, **options) -> DataFrame:
        writer = df.write.mode("overwrite").options(**options)
        if partition_by:
            writer = writer.partitionBy(partition_by)
        target = f"{self.path}/{name}"
        writer.parquet(target)
        return self.spark.read.schema(df.schema).parquet(target)

    def drop(self) -> None:
        """Delete the folder; for jobs whose result no longer reads it."""
        jvm_path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        conf = self.spark._jsc.hadoopConfiguration()
        jvm_path.getFileSystem(conf).delete(jvm_path, True)
