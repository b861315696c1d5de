"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every query relies on. All can be changed on a live session.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A join that feeds an aggregate on the same key is split too when one key is hot.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# State on local disk with small checkpoints: only what changed is uploaded per batch.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

_local_root: str | None = None


def build(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the runtime settings applied; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**RUNTIME, **STATE_STORE}
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else made."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    context = spark.sparkContext
    partitions = "spark.sql.shuffle.partitions"
    chosen = context.getConf().contains(partitions) or spark.conf.get(partitions) != "200"
    if context.master.startswith("local") and not chosen:
        # The cluster default of 200 tasks and state stores is no use on one machine.
        spark.conf.set(partitions, str(context.defaultParallelism))
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local master may go without it: there a folder of this process is used.
    """
    global _local_root
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        if _local_root is None:
            _local_root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        root = _local_root
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one, for the tables and offsets of one run."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, folder: str | None = None) -> DataFrame:
    """Write ``df`` as a table below the shared folder and read on from there.

    This cuts the lineage like a checkpoint, but the table is columnar: a later pass over
    one or two columns reads only those. A given ``folder`` is replaced, so that a caller
    that settles again and again leaves one table only.
    """
    spark = df.sparkSession
    if folder:
        df.write.mode("overwrite").parquet(folder)
    else:
        folder = new_folder(spark, "settled")
        df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)
