"""Session helpers: table loading and durable intermediate results."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_roots: dict[int, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scratch_root(spark: SparkSession) -> str:
    """Folder for intermediate tables, under the shared folder named in ``spark.checkpoint.dir``.

    A folder of this machine is used only when the setting is absent and the master is plain local mode.
    """
    sc = spark.sparkContext
    key = id(sc)
    if key not in _roots:
        base = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
        if not base:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
            base = "file://" + os.path.join(tempfile.gettempdir(), "waymark-scratch")
        _roots[key] = f"{base.rstrip('/')}/waymark-{uuid.uuid4().hex}"
        atexit.register(_remove, spark, _roots[key])
    return _roots[key]


def _path(spark: SparkSession, where: str):
    return spark._jvm.org.apache.hadoop.fs.Path(where)


def _remove(spark: SparkSession, where: str) -> None:
    try:
        path = _path(spark, where)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:  # the JVM may be gone at exit
        pass


class Stored:
    """A written table: survives lost executors, cuts lineage, can be dropped when no longer read."""

    def __init__(self, df: DataFrame, name: str):
        self.spark = df.sparkSession
        self.path = f"{scratch_root(self.spark)}/{name}-{uuid.uuid4().hex[:10]}"
        df.write.parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        _remove(self.spark, self.path)


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back."""
    return Stored(df, name).df


def size_of(df: DataFrame) -> int:
    """Catalyst's size estimate of a plan, in bytes."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


BROADCAST_LIMIT = 32 << 20


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Hint a broadcast only when the plan's own estimate is below ``limit``; otherwise leave the join to shuffle."""
    from pyspark.sql import functions as F

    return F.broadcast(df) if size_of(df) <= limit else df
