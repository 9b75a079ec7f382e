"""ZIP archives of PDFs: discovery, safe members, batches (S-1 to S-7)."""

from __future__ import annotations

import io
import re
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from paperloom.functions import identity, text as X


def relative(path: str, root: str):
    """Column: a file's path below ``root``."""
    return F.substring_index(F.regexp_replace(path, r"^file:/*", "/"), re.sub(r"^file:/*", "/", root).rstrip("/") + "/", -1)


def find(spark: SparkSession, root: str, selected: list[str] | None = None) -> DataFrame:
    """S-1, S-5: (archive, content, archive_sha256_96, archive_size, modified), every ``.zip`` below ``root`` in any letter case, or the
    selected relative paths."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.[zZ][iI][pP]").load(root)
    rel = relative("path", root)
    out = files.select(rel.alias("archive"), "content", identity.fingerprint("content").alias("archive_sha256_96"), F.col("length").alias("archive_size"), F.col("modificationTime").alias("modified"))
    if selected is not None:
        wanted = spark.createDataFrame([(s,) for s in selected], "archive string").select(identity.archive_path("archive").alias("archive"))
        out = out.join(wanted, "archive", "left_semi")
    return out


def safe_member(name: str, is_dir: bool) -> str:
    """S-3: 'take', 'skip' or an error for a member of an archive."""
    path = name.replace("\\", "/")
    parts = [p for p in path.split("/") if p]
    if is_dir or not path.lower().endswith(".pdf"):
        return "skip"
    if path.startswith("/") or ".." in parts:
        return "unsafe path: " + name
    return "skip" if parts and parts[0] == "__MACOSX" else "take"


def members(archives: DataFrame, with_bytes: bool = True) -> DataFrame:
    """S-3: (archive, member, content, sha256_96, error): the PDFs of each archive. A bad archive gives one row with its error and no
    member: an absolute or climbing path, two names that differ in letter case only, or no ZIP file at all."""
    schema = "archive string, member string, content binary, sha256_96 string, error string"

    def run(batches):
        import hashlib

        import pyarrow as pa

        def rows(archive, content):
            try:
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    verdicts = [(i, safe_member(i.filename, i.is_dir())) for i in z.infolist()]
                    bad = [v for _, v in verdicts if v not in ("take", "skip")]
                    taken = [i for i, v in verdicts if v == "take"]
                    folded = [i.filename.casefold() for i in taken]
                    if bad or len(set(folded)) < len(folded):
                        yield archive, None, None, None, bad[0] if bad else "names collide"
                        return
                    for i in sorted(taken, key=lambda i: i.filename):
                        data = z.read(i)
                        yield archive, i.filename.replace("\\", "/"), data if with_bytes else None, hashlib.sha256(data).hexdigest()[:24], None
            except (zipfile.BadZipFile, OSError, RuntimeError, NotImplementedError) as e:
                yield archive, None, None, None, f"{type(e).__name__}: {e}"[:200]

        for b in batches:
            for archive, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                cols = list(zip(*rows(archive, content))) or [(), (), (), (), ()]
                kinds = (pa.string(), pa.string(), pa.binary(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["archive", "member", "content", "sha256_96", "error"])

    return archives.select("archive", "content").mapInArrow(run, schema)


def latest_manifest(manifest: DataFrame) -> DataFrame:
    """The last preparation of each archive; of equal times the one with the greatest content hash."""
    w = Window.partitionBy("archive").orderBy(F.col("prepared_at").desc_nulls_last(), F.col("archive_sha256_96").desc_nulls_last(), F.col("pdf_count").desc_nulls_last())
    return manifest.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def is_current(found: DataFrame, manifest: DataFrame, counts: DataFrame) -> DataFrame:
    """S-6: found archives with ``current``: the manifest has the same path and content, announces PDFs, and as many are there.

    ``counts``: archive, n (the PDFs that are there).
    """
    m = manifest.select("archive", "archive_sha256_96", F.col("pdf_count").alias("__announced")).dropDuplicates(["archive", "archive_sha256_96"])
    j = found.join(m, ["archive", "archive_sha256_96"], "left").join(counts, "archive", "left")
    return j.withColumn("current", F.coalesce((F.col("__announced") > 0) & (F.col("__announced") == F.col("n")), F.lit(False))).drop("__announced", "n")


def prepare(spark: SparkSession, root: str, out: str, prepared_at: str, selected: list[str] | None = None, force: bool = False) -> DataFrame:
    """S-4, S-7: unpack the archives below ``root`` that are not current into ``out/members`` (a partition a batch, replaced as a whole) and
    their manifest rows into ``out/manifest``; (status, n): extracted, skipped, failed. A bad archive fails alone."""
    from paperloom.sources import snapshots
    from paperloom.tables import materialise

    found = find(spark, root, selected)
    old = snapshots.read_or_none(spark, f"{out}/manifest")
    if old is not None and not force:
        done = spark.read.parquet(f"{out}/members").groupBy("archive").agg(F.count("*").alias("n"))
        found = is_current(found, old, done)
    else:
        found = found.withColumn("current", F.lit(False))
    todo = found.where("NOT current")
    pdfs = materialise(members(todo), "unpacked")
    good = pdfs.where("error IS NULL").withColumn("batch", F.regexp_replace("archive", r"(?i)\.zip$", "")).withColumn("source_key", identity.source_key(F.concat("batch", F.lit("/"), "member")))
    good.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{out}/members")
    n = good.groupBy("archive").agg(F.count("*").cast("int").alias("pdf_count"))
    rows = todo.drop("content", "current").join(n, "archive").withColumn("prepared_at", F.lit(prepared_at))
    new = rows if old is None else old.join(rows.select("archive"), "archive", "left_anti").unionByName(rows, allowMissingColumns=True)
    snapshots.replace(new, f"{out}/manifest")
    status = F.when(F.col("current"), "skipped").when(F.col("error").isNotNull(), "failed").otherwise("extracted")
    errors = pdfs.where("error IS NOT NULL").select("archive", "error")
    return found.select("archive", "current").join(errors, "archive", "left").groupBy(status.alias("status")).agg(F.count("*").alias("n"))


def tally(manifest: DataFrame, pdfs: DataFrame) -> DataFrame:
    """Announced and present PDFs of each batch: (archive, announced, present)."""
    present = pdfs.groupBy(F.concat(F.substring_index("source_key", "/", 1), F.lit(".zip")).alias("archive")).agg(F.count("*").alias("present"))
    return latest_manifest(manifest).select("archive", F.col("pdf_count").alias("announced")).join(present, "archive", "left").withColumn("present", F.coalesce("present", F.lit(0)))


def path_order(key: str = "source_key") -> list:
    """L-1: the order of paths by their components, which differs from that of the strings."""
    return [F.split(X.c(key), "/")]
