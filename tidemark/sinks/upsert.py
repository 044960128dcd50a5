"""A table of files in which a newer row of a key takes the older one's place.

Keys are dealt to hash buckets.  An upsert reads the buckets its changes touch, keeps the newest row of every key, and
writes these buckets anew as one version; the other buckets stay as they are.  A version is named by its batch, made
from the versions before it and only read once it is complete, so a batch that is run again puts the same rows into the
same place and changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKET = "_bucket"


class KeyedTable:
    """``order`` tells which of two rows of a key is newer; of equals the one written later stays.  Null keys are keys."""

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: Sequence[str], order: str, buckets: int = 64) -> None:
        self.spark, self.path, self.schema, self.keys, self.order, self.buckets = spark, path, schema, list(keys), order, buckets

    def upsert(self, changes: DataFrame, batch_id: int) -> None:
        rest = [c for c in changes.columns if c not in self.keys]
        changes = changes.withColumn(BUCKET, F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")).persist()
        try:
            touched = [r[0] for r in changes.select(BUCKET).distinct().collect()]  # at most ``buckets`` numbers
            if not touched:
                return
            old = self._rows({b: v for b, v in self._newest(batch_id).items() if b in touched})
            both = changes.withColumn("_late", F.lit(1))
            if old is not None:
                both = both.unionByName(old.withColumn("_late", F.lit(0)))
            newest = both.groupBy(*self.keys, BUCKET).agg(
                F.max_by(F.struct(*rest), F.struct(self.order, "_late", *[c for c in rest if c != self.order])).alias("_v"))
            newest.select(*self.keys, "_v.*", BUCKET).repartition(BUCKET).write.partitionBy(BUCKET).mode(
                "overwrite").parquet(f"{self.path}/v={batch_id}")
        finally:
            changes.unpersist()

    def read(self) -> DataFrame:
        """The current rows."""
        rows = self._rows(self._newest(None))
        if rows is None:
            return self.spark.createDataFrame([], self.schema)
        return rows.drop(BUCKET)

    def _newest(self, before: int | None) -> dict[int, int]:
        """Newest complete version of every bucket; of versions before a batch only."""
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        files = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(root):
            return {}
        newest: dict[int, int] = {}
        for entry in files.listStatus(root):
            version = int(entry.getPath().getName().removeprefix("v="))
            names = [e.getPath().getName() for e in files.listStatus(entry.getPath())]
            if "_SUCCESS" in names and (before is None or version < before):
                for name in names:
                    if name.startswith(f"{BUCKET}="):
                        bucket = int(name.split("=")[1])
                        newest[bucket] = max(version, newest.get(bucket, version))
        return newest

    def _rows(self, versions: dict[int, int]) -> DataFrame | None:
        if not versions:
            return None
        paths = [f"{self.path}/v={v}/{BUCKET}={b}" for b, v in sorted(versions.items())]
        rows = self.spark.read.schema(self.schema).parquet(*paths)
        return rows.withColumn(BUCKET, F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))
