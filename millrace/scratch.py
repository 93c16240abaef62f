"""Tables that cut a job's lineage, in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own_dir: dict[str, str] = {}


def is_local(spark: SparkSession) -> bool:
    """Whether driver and tasks share one machine; local-cluster is a cluster."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one only in a local session that names none."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not is_local(spark):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_dir:
        _own_dir[app] = "file://" + tempfile.mkdtemp(prefix="millrace-")
    return _own_dir[app]


class Scratch:
    """Tables of one operator call, below the shared folder."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/millrace/{name}-{uuid.uuid4().hex}"
        self.n = 0
        atexit.register(self._forget, self.root)

    def _forget(self, path: str) -> None:
        try:
            jvm = self.spark._jvm
            at = jvm.org.apache.hadoop.fs.Path(path)
            conf = self.spark._jsc.hadoopConfiguration()
            at.getFileSystem(conf).delete(at, True)
        except Exception:  # the session may be gone at exit
            pass

    def cut(self, df: DataFrame, name: str = "t") -> DataFrame:
        """Writes df once and returns the written table."""
        self.n += 1
        path = f"{self.root}/{name}-{self.n}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            self._forget(t._scratch_path)
