"""Session settings, table loading and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_local_scratch: str | None = None


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are planned for."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
    settings.update({key: str(value) for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def prepare(spark: SparkSession) -> SparkSession:
    """Runtime settings every registered query relies on.

    Event times are stored without zone and mean UTC.  On a local master the
    untouched default of 200 shuffle partitions is lowered to the core count;
    a cluster's own setting is never changed.
    """
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    if is_local(spark) and spark.conf.get("spark.sql.shuffle.partitions") == "200":
        spark.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may do without it; there the process makes its own
    temporary folder, once.
    """
    global _local_scratch
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not is_local(spark):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if _local_scratch is None:
        _local_scratch = tempfile.mkdtemp(prefix="tidemark-")
    return _local_scratch


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder path below the shared scratch root."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table; zone-less times become UTC instants so that they can be watermarked."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    for field in df.schema.fields:
        if field.dataType.typeName() == "timestamp_ntz":
            df = df.withColumn(field.name, F.col(field.name).cast("timestamp"))
    return df
