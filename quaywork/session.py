"""Session defaults and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_scratch: list[str] = []
#: Temporary folders of local sessions without a setting, by application.
_local: dict[str, str] = {}

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(
    app: str = "quaywork", master: str | None = None, partitions: int | None = None
) -> SparkSession:
    """A session tuned by configuration only; a cluster supplies its own master."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
        # Recording the call site of every column slows down building large plans.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
        builder = builder.config("spark.driver.memory", "16g")
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session without that setting (a test) gets a temporary folder;
    on a cluster its absence is an error, since a folder of one machine is not
    seen by the others.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        # The setting cannot be changed in a running session, so the folder is remembered here.
        folder = _local.setdefault(spark.sparkContext.applicationId, "") or tempfile.mkdtemp(prefix="quaywork-")
        _local[spark.sparkContext.applicationId] = folder
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder for intermediate data; :func:`clear_scratch` removes it."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    _scratch.append(path)
    return path


def written_once(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to a new scratch folder and read back, so that several uses do not compute it again."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> int:
    """Remove the scratch folders this process has made; what is still read from them must be done."""
    count = len(_scratch)
    while _scratch:
        path = spark._jvm.org.apache.hadoop.fs.Path(_scratch.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return count
