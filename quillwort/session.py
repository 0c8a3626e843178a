"""Session helpers: one place for the session's settings, table loading and durable cuts of a lineage."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int = 8, app: str = "quillwort", **conf: str) -> SparkSession:
    """A session for tests and benchmarks on one machine. Clusters bring their own session."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = {
        "spark.sql.shuffle.partitions": str(cores),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Only where the session names none (tests on one machine) a temporary folder is made; on a
    cluster without the setting this raises, because a machine-local folder would lose data.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not configured:
        current = context.getCheckpointDir()
        if current:
            configured = current
        elif context.master.startswith("local[") or context.master == "local":
            configured = tempfile.mkdtemp(prefix="quillwort-")
        else:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return configured


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage: the rows as a table in the shared folder, so that a lost executor costs no recomputation.

    A table also has its true size. A checkpoint would keep the size that was estimated for the
    plan behind it, and in a loop of joins such estimates multiply from round to round, until
    planning is what takes the time. The JVM deletes the table when it ends.
    """
    spark = df.sparkSession
    path = fresh_path(spark, "cut")
    df.write.parquet(path)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete a table that ``durable`` wrote and nothing will read again."""
    spark = df.sparkSession
    for folder in {os.path.dirname(f) for f in df.inputFiles()}:
        if os.path.basename(folder).startswith("cut-"):
            place = spark._jvm.org.apache.hadoop.fs.Path(folder)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def pinned(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint, which keeps partitions and the order within them."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder for a table that an operator writes."""
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spread(df: DataFrame, per_core: int = 3) -> DataFrame:
    """The rows over at least ``per_core`` tasks per core, for work that costs far more than moving the rows.

    A small or well compressed table is read by few tasks, and a row group cannot be cut further. A
    table that already has enough partitions stays where it is, so nothing moves at large sizes.
    """
    wanted = per_core * df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= wanted else df.repartition(wanted)
