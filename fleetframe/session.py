"""Spark session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Settings the operators are designed for. Shuffle parallelism is left to the cluster: set
# spark.sql.adaptive.coalescePartitions.initialPartitionNum high (for example 2-3 times the cores)
# and let adaptive execution merge small partitions up to the advisory size.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    # State of the gap sessions outside the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Checkpoints go away with the frames that use them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def create_session(app_name: str = "fleetframe", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the engine settings; `conf` keys use `__` for dots (spark__driver__memory="8g")."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = ENGINE_CONF | {key.replace("__", "."): value for key, value in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """All timestamps of the engine are UTC, whatever the machine's zone is."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`; a temporary one only for local sessions without it."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if not context.getCheckpointDir():
            context.setCheckpointDir(configured)
        return configured
    current = context.getCheckpointDir()
    if current:
        return current
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="fleetframe-")
    context.setCheckpointDir(local)
    return local


def work_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder; it goes away when the application ends."""
    context = spark.sparkContext
    root = f"{shared_dir(spark).rstrip('/')}/work-{context.applicationId}"
    if getattr(context, "_fleetframe_work", None) != root:
        folder = context._jvm.org.apache.hadoop.fs.Path(root)
        store = folder.getFileSystem(context._jsc.hadoopConfiguration())
        store.mkdirs(folder)
        store.deleteOnExit(folder)
        context._fleetframe_work = root
    return f"{root}/{name}-{uuid.uuid4().hex}"


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once per Spark context."""
    context, home = spark.sparkContext, Path(__file__).parent
    if getattr(context, "_fleetframe_shipped", False) or not home.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="fleetframe-")) / "fleetframe.zip"
    with zipfile.ZipFile(archive, "w") as packed:
        for module in sorted(home.rglob("*.py")):
            packed.write(module, module.relative_to(home.parent))
    context.addPyFile(str(archive))
    context._fleetframe_shipped = True


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: computes `df` once and cuts its lineage; survives the loss of executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
