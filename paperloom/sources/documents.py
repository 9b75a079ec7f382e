"""Converted papers and JSON documents as tables and files (S-8 to S-15)."""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperloom.functions import identity, text as X
from paperloom.sources.archives import relative


@dataclass(frozen=True)
class Settings:
    """S-15: settings with their defaults; each is overridden by the environment variable of its name in capitals."""

    openai_api_key: str = ""
    openai_base_url: str = ""
    llm_model: str = ""
    llm_temperature: float = 0.0
    max_input_chars: int = 100_000
    max_output_tokens: int = 16_384
    max_retries: int = 3
    min_md_chars: int = 10_000
    metadata_head_chars: int = 5_000
    workers: int = 1
    process_limit: int = 0
    convert_backend: str = "plain"
    convert_workers: int = 4
    extract_groups: str = ""
    extract_group_spec: str = ""
    extract_group_parallel: int = 1
    pdf_dir: str = "papers"
    markdown_dir: str = "markdown"
    json_output_dir: str = "json_output"
    db_dir: str = "db"

    @staticmethod
    def load(env: dict[str, str] | None = None) -> "Settings":
        env = dict(os.environ) if env is None else env
        return Settings(**{f.name: type(f.default)(env[f.name.upper()]) for f in fields(Settings) if env.get(f.name.upper(), "") != ""})


def scope_paths(base: str, settings: Settings, source: str | None = None) -> tuple[str, str, str]:
    """P-4: (folder of PDFs, folder of their texts, root of their keys) of a scope: a source within the PDF root keeps its place below it, any
    other takes its own name and is its own root."""
    full = lambda p: os.path.normpath(p if os.path.isabs(p) else os.path.join(base, p))
    pdfs, texts = full(settings.pdf_dir), full(settings.markdown_dir)
    if source is None:
        return pdfs, texts, pdfs
    at = full(source)
    inside = at == pdfs or at.startswith(pdfs.rstrip("/") + "/")
    below = os.path.relpath(at, pdfs) if inside else os.path.basename(at)
    return at, texts if below == "." else os.path.join(texts, below), pdfs if inside else at


def read_pdfs(spark: SparkSession, root: str) -> DataFrame:
    """S-8: (source_key, content, source_pdf_sha256_96) of the ``.pdf`` files below a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.pdf").load(root)
    return files.select(identity.source_key(relative("path", root)).alias("source_key"), "content", identity.fingerprint("content").alias("source_pdf_sha256_96"))


#: A converter takes the bytes of a paper and gives the text of each page.
Converter = Callable[[bytes], list[str]]


def plain_pages(content: bytes) -> list[str]:
    """The converter that needs no library: UTF-8 text with form feeds between pages."""
    return content.decode("utf-8", "replace").split("\f")


def convert(pdfs: DataFrame, converter: Converter = plain_pages, known: DataFrame | None = None) -> DataFrame:
    """S-9, S-10: (source_key, text, char_count, converted_text_sha256_96, elapsed, error): pages joined by 1-based markers, cleaned up
    (T-1 to T-3). A paper that cannot be converted gives its error. Of the papers in ``known`` (source_key, text) the text is taken as it is and
    took no time."""
    if known is not None:
        old = known.where(F.col("text").isNotNull()).groupBy("source_key").agg(F.max("text").alias("text")).join(pdfs.select("source_key").distinct(), "source_key", "left_semi")
        again = old.withColumns({"elapsed": F.lit(0.0), "error": F.lit(None).cast("string"), "char_count": F.length("text").cast("long"), "converted_text_sha256_96": identity.fingerprint("text")})
        return convert(pdfs.join(old.select("source_key"), "source_key", "left_anti"), converter).unionByName(again)

    def run(batches):
        import time

        import pyarrow as pa

        for b in batches:
            texts, took, errors = [], [], []
            for content in b.column(1).to_pylist():
                began = time.time()
                try:
                    texts.append("\n\n".join(f"<!-- PAGE {i} -->\n\n{p}" for i, p in enumerate(converter(content), 1)))
                    errors.append(None)
                except Exception as e:  # one paper's failure is its own
                    texts.append(None)
                    errors.append(f"{type(e).__name__}: {e}"[:500])
                took.append(round(time.time() - began, 3))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string()), pa.array(took, pa.float64()), pa.array(errors, pa.string())], ["source_key", "raw", "elapsed", "error"])

    raw = pdfs.select("source_key", "content").mapInArrow(run, "source_key string, raw string, elapsed double, error string")
    text = X.fix_abstract_order(X.truncate_back_matter(X.drop_pictures("raw")))
    return raw.select("source_key", text.alias("text"), "elapsed", "error").withColumns({"char_count": F.length("text").cast("long"), "converted_text_sha256_96": identity.fingerprint("text")})


def read_markdown(spark: SparkSession, root: str) -> DataFrame:
    """S-11: (source_key, text) of the ``.md`` files below a folder."""
    files = spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.md")
    return files.select(identity.source_key(F.regexp_replace(relative("_metadata.file_path", root), r"\.md$", ".pdf")).alias("source_key"), F.col("value").alias("text"))


def read_json(spark: SparkSession, root: str, schema: T.StructType | str) -> DataFrame:
    """S-12: one row a JSON document; the schema is given, never inferred, and what does not fit is null."""
    return spark.read.schema(schema).option("multiLine", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").json(root)


def write_json(df: DataFrame, path: str, name: str = "source_key") -> None:
    """S-13, S-14: an export of one JSON document a row, as text files of one object a line, in folders by the first component of the key."""
    folder = F.substring_index(F.col(name), "/", 1)
    df.select(folder.alias("batch"), F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").partitionBy("batch").text(path)
