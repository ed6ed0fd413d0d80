"""Session helpers shared by all operators."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder that the driver and every executor can reach, as named by ``spark.checkpoint.dir``.

    Only where the session names none and its master is local (tests on one machine) is a local folder made and set; on a
    cluster without a shared folder this raises.
    """
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at:
        at = spark.sparkContext.getCheckpointDir()
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        at = f"file://{tempfile.mkdtemp(prefix='strataloom-')}"
        spark.sparkContext.setCheckpointDir(at)
    return at.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{os.getpid()}-{uuid.uuid4().hex[:12]}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a path through Hadoop's file system, whichever store holds it."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def bound_batches(spark: SparkSession, most: int = 4 << 20) -> None:
    """Bound the bytes (and not only the rows) of the batches that go to Python: long texts would make huge ones."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(most))


_WRITTEN: list[str] = []


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: the lineage is cut and survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    _WRITTEN.append(path)
    return spark.read.schema(df.schema).parquet(path)


def settle(spark: SparkSession, make: Callable[[], DataFrame], name: str = "stage") -> DataFrame:
    """materialize(make()), and then delete whatever was materialized on the way there."""
    before = len(_WRITTEN)
    out = materialize(make(), name)
    for path in _WRITTEN[before:-1]:
        delete_path(spark, path)
    del _WRITTEN[before:-1]
    return out


def release(spark: SparkSession, df: DataFrame) -> None:
    """Delete the folder of a materialized frame that nothing reads any more."""
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        known = [w for w in _WRITTEN if path.endswith(w.split("://", 1)[-1].rstrip("/"))]
        for w in known:
            delete_path(spark, w)
            _WRITTEN.remove(w)
