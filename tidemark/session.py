"""Session settings and the shared folder that jobs may write to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Runtime settings every job relies on: dates are UTC dates.

    Sides that both lie together by one of the keys of their join are joined as they lie, so that
    windows by that key need no shuffle of the joined rows. Such sides come from ``clean.gathered``,
    and a key's rows meet in one task for the windows anyway.

    Folders are listed by a few tasks a core. By default each has a task of its own, up to 10,000,
    and starting a task takes longer than listing a folder.

    Shuffle files go when the query that wrote them ends. By default they lie on disk until the driver's
    garbage collection meets their frame, so those of all steps of a run may lie there together. A frame
    that is run a second time shuffles anew.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", False)
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism",
                   4 * spark.sparkContext.defaultParallelism)
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", True)
    return spark


def local_session(cores: int | str = "*", app: str = "tidemark", **conf: str) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        # Window work is CPU-heavy per byte: do not merge partitions down to fewer than the cores.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
    )
    for name, value in conf.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one named by ``spark.checkpoint.dir``.

    Where the setting is absent, a temporary folder is used on a local master only: on a cluster
    no other machine would see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="run-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The table written to the shared folder and read back: what follows starts from files that
    any executor sees."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)
