"""Tables as versioned snapshots: written whole under a new name, then pointed to (S-16 to S-18)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return fs.exists(p)


def read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """The current snapshot at ``path``, or None."""
    version = current_version(spark, path)
    return None if version is None else spark.read.parquet(f"{path}/{version}")


def current_version(spark: SparkSession, path: str) -> str | None:
    """The name of the current snapshot; None where nothing was ever written. Snapshots without a pointer are an error and no empty table."""
    fs, at, jvm = _fs(spark, f"{path}/CURRENT")
    if fs.exists(at):
        return spark.read.text(f"{path}/CURRENT").first()[0]
    found = fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{path}/v-*"))
    if found is not None and len(found):
        raise RuntimeError(f"{path} holds snapshots and no pointer to one")
    return None


def replace(df: DataFrame, path: str, expected: str | None = None) -> str:
    """Write the next snapshot and point to it; readers of the last one are not disturbed, and a lost write leaves it in place.

    The pointer is a file that is written beside the old one and renamed over it, so there is one at any time. With ``expected`` (the version
    that the new one was made from) a snapshot that another writer has put there since is an error and stays.
    """
    spark = df.sparkSession
    version = f"v-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(f"{path}/_new-{version}")
    fs, at, jvm = _fs(spark, f"{path}/CURRENT")
    fresh = jvm.org.apache.hadoop.fs.Path(f"{path}/_fresh-{version}")
    out = fs.create(fresh, True)
    out.write(bytearray((version + "\n").encode()))
    out.close()
    if expected is not None and current_version(spark, path) != expected:
        fs.delete(fresh, False)
        raise RuntimeError(f"{path} was written by another run")
    fs.rename(jvm.org.apache.hadoop.fs.Path(f"{path}/_new-{version}"), jvm.org.apache.hadoop.fs.Path(f"{path}/{version}"))
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    over = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    over[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    files.rename(fs.makeQualified(fresh), fs.makeQualified(at), over)
    return version


def archive_run(spark: SparkSession, root: str, tables: tuple[str, ...], stamp: str, stages: tuple[str, ...]) -> DataFrame:
    """S-17: the current snapshots of the tables below ``root`` copied to ``runs/<stamp>`` before a forced run, with a manifest: a row a table
    (name, version, rows; null where it was never written), with the stages that will be run."""
    rows = []
    for name in tables:
        version = current_version(spark, f"{root}/{name}")
        n = None
        if version is not None:
            copy = f"{root}/runs/{stamp}/{name}"
            spark.read.parquet(f"{root}/{name}/{version}").write.mode("overwrite").parquet(copy)
            n = spark.read.parquet(copy).count()
        rows.append((name, version, n, ",".join(stages), stamp))
    manifest = spark.createDataFrame(rows, "name string, version string, rows long, stages string, stamp string")
    manifest.coalesce(1).write.mode("overwrite").json(f"{root}/runs/{stamp}/manifest")
    return manifest


def discard(artifacts: DataFrame, skipped: DataFrame, key: str = "source_key") -> DataFrame:
    """S-18: artifacts without those of skipped papers."""
    return artifacts.join(skipped.select(key).distinct(), key, "left_anti")


def artifact_map(spark: SparkSession, root: str, suffix: str, excluded: tuple[str, ...] = ()) -> DataFrame:
    """S-19: (source_key, path, length, modified) of the files with a suffix; contents are not read."""
    from paperloom.functions import identity
    from paperloom.sources.archives import relative

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{suffix}").load(root).select("path", "length", F.col("modificationTime").alias("modified"))
    out = files.withColumn("source_key", identity.source_key(F.regexp_replace(relative("path", root), "\\" + suffix + "$", ".pdf")))
    for d in excluded:
        out = out.where(~F.col("path").contains(f"/{d}/"))
    return out
