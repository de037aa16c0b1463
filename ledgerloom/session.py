"""Session helpers: local sessions for tests, table access, lineage cuts."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int = 4, partitions: int = 8, name: str = "ledgerloom") -> SparkSession:
    """A local session with the settings the engine expects everywhere."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Table ``name`` of a data folder with one parquet file or folder per table."""
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the folder all executors share.

    The folder is the session's ``spark.checkpoint.dir``.  Only where that is unset, as in
    tests on one machine, a temporary folder is used instead.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


def small_rows(df: DataFrame, most: int, what: str) -> list:
    """Rows of a reference table for the driver, refused beyond a stated bound."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"{what} has more than {most} rows; raise the bound or use the join form")
    return rows


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, wherever they were started.

    The package's own sources go through Spark's file server once an application.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    home = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="ledgerloom-ship-")) / f"{home.name}-{context.applicationId}.zip"
    with zipfile.ZipFile(archive, "w") as packed:
        for source in sorted(home.rglob("*.py")):
            packed.write(source, source.relative_to(home.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, for checkpoints and written intermediate tables."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="ledgerloom-checkpoint-")
    return str(shared)


#: Estimated bytes of input below which rows are spread over the cores.
SPREAD_BYTES = 64 << 20


def spread(df: DataFrame, most_bytes: int = SPREAD_BYTES) -> DataFrame:
    """Rows over all cores where the input is estimated to be at most ``most_bytes`` and
    lies in fewer files than there are cores.

    A table in one small file is one piece, and what follows it would run on one core.
    Larger inputs, by the optimizer's own estimate, are never moved.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if size <= most_bytes and len(df.inputFiles()) < cores else df
