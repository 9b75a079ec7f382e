"""Reading of the project's Parquet tables and small session helpers."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once an application, so that Python workers can import it.

    The archive lies beside the driver only until Spark's file server has it; executors fetch it from there.
    """
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = tempfile.mkdtemp(prefix="paperloom-")
    stage = os.path.join(out, "src")
    shutil.copytree(os.path.join(root, "paperloom"), os.path.join(stage, "paperloom"), ignore=shutil.ignore_patterns("__pycache__", "*.pyc"))
    sc.addPyFile(shutil.make_archive(os.path.join(out, "paperloom"), "zip", stage))
    _shipped.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data directory; ``name.parquet`` may be a file or a folder."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for written intermediate tables.

    ``spark.checkpoint.dir`` names it on a cluster. Only where it is unset in local mode (tests) a folder under the session's warehouse is
    used; on a cluster that would be a folder of one machine and is an error.
    """
    conf = spark.sparkContext.getConf()
    shared = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors share")
        shared = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_paperloom_shared"
    return shared.rstrip("/")


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once into the shared folder and read it back.

    Lineage is cut with a table that every executor can reach, so that a lost executor costs a re-read and
    not a recomputation.
    """
    spark = df.sparkSession
    path = f"{run_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def run_dir(spark: SparkSession) -> str:
    """The folder of this application's intermediate tables within the shared one."""
    return f"{checkpoint_dir(spark)}/paperloom-{spark.sparkContext.applicationId}"


def clean_up(spark: SparkSession) -> None:
    """Delete this application's intermediate tables. For the end of a run: no frame that was made before can be read after it."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(run_dir(spark))
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def is_small(df: DataFrame, limit: int) -> bool:
    """Whether ``df`` has at most ``limit`` rows; reads no further than that."""
    return df.limit(limit + 1).count() <= limit


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores where its input has fewer splits than there are cores (a small or unsplittable file); as it is otherwise.

    For scans before costly maps over texts: a large table has many splits and is not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    splits = df._jdf.queryExecution().toRdd().getNumPartitions()
    return df.repartition(cores) if 0 < splits < cores else df
