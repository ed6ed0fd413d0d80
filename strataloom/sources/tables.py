"""Snapshot tables: Parquet versions v=N below a folder, and a _CURRENT file that names the published one.

A writer fills a new version and then moves the pointer, so a reader sees the old snapshot or the new one, never a mixture,
and a table may be rewritten from itself. File operations go through Hadoop's file system.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class SnapshotTable:
    def __init__(self, spark: SparkSession, path: str, schema: StructType | str):
        self.spark, self.path = spark, path.rstrip("/")
        self.schema = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def version(self) -> int:
        """The published version, 0 if the table is new. A pointer that can't be read counts as none."""
        at = self._path(f"{self.path}/_CURRENT")
        if not self._fs.exists(at):
            return 0
        stream = self._fs.open(at)
        try:
            data = bytes(stream.readAllBytes()).decode("ascii", "replace").strip()
        except Py4JJavaError as e:
            if "ChecksumException" not in str(e):
                raise
            data = ""
        finally:
            stream.close()
        return int(data) if data.isdigit() else 0

    def read(self, version: int | None = None) -> DataFrame:
        """The published rows; columns added to the schema since they were written are null."""
        v = self.version() if version is None else version
        if not v:
            return self.spark.createDataFrame([], self.schema).where("false")  # known to be empty, so upserts into it need no join
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/v={v}")

    def publish(self, rows: DataFrame, expect: int | None = None) -> int:
        """Write ``rows`` as the next version and move the pointer; with ``expect``, only if that is still the published one."""
        now = self.version()
        v = now + 1
        while self._fs.exists(self._path(f"{self.path}/v={v}")):
            v += 1
        rows.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema)).write.parquet(f"{self.path}/v={v}")
        if self.version() != (now if expect is None else expect):
            raise RuntimeError(f"{self.path} was published by another writer")
        temp = self._path(f"{self.path}/_CURRENT.{v}")
        stream = self._fs.create(temp, True)
        stream.write(str(v).encode())
        stream.close()
        at = self._path(f"{self.path}/_CURRENT")
        context = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        files = context.FileContext.getFileContext(temp.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).getUri())
        option = self.spark.sparkContext._gateway.new_array(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        option[0] = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        files.rename(temp, at, option)
        return v


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], rules: dict[str, Callable[[Column, Column, Column], Column]] | None = None) -> DataFrame:
    """Rows of both by key. A column's rule gets (old, new, whether new has the row); without one the new row's value wins.

    Columns that ``new`` lacks keep the old value. Both sides have one row per key.
    """
    rules = rules or {}
    o = old.select(F.struct(*old.columns).alias("o"), *(F.col(k).alias(k) for k in keys))
    n = new.select(F.struct(*new.columns, F.lit(True).alias("__here")).alias("n"), *(F.col(k).alias(k) for k in keys))
    both = o.join(n, [*keys], "full_outer")
    here, out = F.coalesce(F.col("n.__here"), F.lit(False)), []
    for f in old.schema.fields:
        if f.name in keys:
            out.append(F.col(f.name))
            continue
        was = F.col(f"o.{f.name}")
        now = F.col(f"n.{f.name}") if f.name in new.columns else None
        if f.name in rules:
            value = rules[f.name](was, was if now is None else now, here)
        else:
            value = was if now is None else F.when(here, now).otherwise(was)
        out.append(value.cast(f.dataType).alias(f.name))
    return both.select(*out).select(*old.columns)


def keep_first(was: Column, now: Column, here: Column) -> Column:
    """The stored value, if the row was there."""
    return F.coalesce(was, now)


def take_new(was: Column, now: Column, here: Column) -> Column:
    """The new row's value, null included."""
    return F.when(here, now).otherwise(was)


def widen(rows: DataFrame, schema: StructType) -> DataFrame:
    """Rows of an older schema with the missing columns as nulls."""
    return rows.sparkSession.createDataFrame([], schema).unionByName(rows, allowMissingColumns=True)
