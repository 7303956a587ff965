"""Session defaults and the lineage cut used by iterative stages."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CLUSTER_SAFE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "verdant") -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in CLUSTER_SAFE_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of this session.

    It is the one the cluster names in spark.checkpoint.dir.  Only where that setting is
    absent and the master is local (tests, a laptop) a folder of this machine is made; on a
    cluster executors could not read each other's files there, so that is an error.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None)
        if not folder:
            if not re.fullmatch(r"local(\[[^,]*(,\d+)?\])?", context.master):
                raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors of {context.master} share")
            folder = tempfile.mkdtemp(prefix="verdant-checkpoint-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Write df to the shared checkpoint folder and read it back.

    Unlike a local checkpoint the copy survives the loss of any executor.
    """
    _shared_folder(df.sparkSession)
    return df.checkpoint(eager=eager)


_FREES_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut_and_freed(df: DataFrame) -> DataFrame:
    """cut_lineage for large shuffles: their files go as soon as the copy is written, which needs them
    no more, and not only when the driver happens to collect its garbage."""
    conf = df.sparkSession.conf
    before = conf.get(_FREES_SHUFFLES, "false")
    conf.set(_FREES_SHUFFLES, "true")
    try:
        return cut_lineage(df.select("*"))  # a plan of its own, which nothing else runs again
    finally:
        conf.set(_FREES_SHUFFLES, before)


def stored(df: DataFrame) -> DataFrame:
    """df written as a table in the shared checkpoint folder and read back.

    A third of the size of a checkpoint, and later plans know how large it is; its
    partitioning is not kept, so use it for what is read by columns or joined by several keys.
    """
    path = f"{_shared_folder(df.sparkSession)}/{uuid.uuid4().hex}.parquet"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


BROADCAST_ROWS = 200_000  # of narrow rows, some 10 MB


def small_join(big: DataFrame, small: DataFrame, keys: list[str], how: str) -> DataFrame:
    """big joined to a side of narrow rows that is usually small: broadcast if it is found to have
    at most BROADCAST_ROWS rows, else joined as Spark plans it, with a shuffle."""
    fits = small.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS  # a look at the size; the join takes all rows
    return big.join(F.broadcast(small) if fits else small, keys, how)


def spread(df: DataFrame) -> DataFrame:
    """df in at least as many partitions as there are cores, ahead of costly work on each row.

    Inputs of many files are left as they are; a small one in a single file would otherwise
    keep one core busy.  Only the placement of rows changes.  A plan that shuffles already is
    not touched, as counting its partitions would run it.
    """
    if "Exchange" in df._jdf.queryExecution().executedPlan().toString():
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once a context; they need not have it installed."""
    context = spark.sparkContext
    if getattr(context, "_verdant_shipped", None) == context.applicationId:
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="verdant-package-")) / "verdant.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    context.addPyFile(str(archive))
    context._verdant_shipped = context.applicationId
