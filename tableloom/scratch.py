"""Tables that cut a lineage: written to the folder all executors share, and read again.

The folder is ``spark.checkpoint.dir`` of the session.  Where that is unset and Spark runs in one process (tests, a
laptop) a temporary folder takes its place; on a cluster, where a machine-local folder would be invisible to the other
executors, it is an error.  A table that was written survives the loss of any executor.
"""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

HANDED_ON = 1.3  # seconds
_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder, as a path or URI without a trailing slash."""
    told = spark.conf.get("spark.checkpoint.dir", None)
    if told:
        return told.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir is not set: on a cluster, tables need a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="tableloom-")
        atexit.register(shutil.rmtree, _own[app], ignore_errors=True)
    return f"file://{_own[app]}"


class Scratch:
    """One run's folder under the shared one."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"

    def table(self, name: str) -> str:
        return f"{self.path}/{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Writes df as the table name and returns the table."""
        schema = df.schema
        df.write.mode("overwrite").parquet(self.table(name))
        return self.spark.read.schema(schema).parquet(self.table(name))

    def release(self) -> None:
        """Lets go of the shuffle files of finished queries, which the driver otherwise keeps until it happens to collect garbage.

        The gateway hands dropped references on about once a second; before that the driver's JVM still holds them.
        """
        gc.collect()
        time.sleep(HANDED_ON)
        for _ in range(2):  # what the first collection finds may hold on to more
            self.spark._jvm.System.gc()
            time.sleep(0.2)

    def drop(self, *names: str) -> None:
        """Deletes tables that nothing reads any more, so that they stop counting as disk."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.table(name))
            path.getFileSystem(conf).delete(path, True)
