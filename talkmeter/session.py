"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


# Streaming state on disk, so that it may outgrow executor memory.
DISK_STATE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Rows of more columns aren't fused into one compiled loop: such loops are too large to be optimised.
FUSED_FIELDS = 30


def build_session(app: str = "talkmeter", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every job here relies on.

    A cluster submit already carries master, memory and shuffle sizing, so only
    semantics (UTC, AQE, spill-free state store) are fixed here.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": DISK_STATE,
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    Only where the setting is absent and everything runs in one process (tests,
    a laptop) a local one is created and recorded in the session, so later calls
    agree. On a cluster executors could not reach it, so its absence is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", "")
    if not folder:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"set spark.checkpoint.dir to a shared folder; master is {master}")
        folder = tempfile.mkdtemp(prefix="talkmeter-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_run_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; never reused between runs."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows as a table in the shared folder: computed once, and of a size that Spark knows."""
    folder = new_run_folder(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def wide_session(spark: SparkSession) -> SparkSession:
    """A sibling session for tables of many columns, with the settings of this one.

    Spark fuses the operators of a stage into one loop. With forty columns or more the compiler of the JVM
    gives such a loop up again and again, and it runs several times as long as operators side by side.
    """
    folder = shared_folder(spark)
    sibling = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            sibling.conf.set(key, value)
    if sibling.conf.get("spark.checkpoint.dir", "") != spark.conf.get("spark.checkpoint.dir"):
        sibling.conf.set("spark.checkpoint.dir", folder)
    sibling.conf.set("spark.sql.codegen.maxFields", FUSED_FIELDS)
    return sibling


def streaming_session(spark: SparkSession, partitions: int | None = None) -> SparkSession:
    """A sibling session for stateful streams, on the same cluster.

    A checkpoint keeps its number of state partitions for life, so give the
    number the stream will need when it has grown; by default it is that of the
    session's shuffles. The state goes to disk.
    """
    sibling = spark.newSession()
    asked = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sibling.conf.set("spark.sql.shuffle.partitions", asked)
    sibling.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    sibling.conf.set("spark.sql.streaming.stateStore.providerClass", DISK_STATE)
    return sibling
