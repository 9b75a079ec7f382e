"""Command line: ``python -m paperloom.cli prepare|convert|preprocess|extract|all|status|inspect|reset …``."""

from __future__ import annotations

import argparse
import datetime
import json
import sys
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.operators import prompts as P
from paperloom.operators import state as S
from paperloom.plans import pipeline
from paperloom.sources import archives, documents, snapshots
from paperloom.tables import ship


#: L-8: the order of the stages; ``all`` runs a range of them.
STEPS = ("prepare", "convert", "preprocess", "extract")
#: The tables that a forced run copies first.
KEPT = ("state", "metadata", "entries")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="paperloom")
    sub = p.add_subparsers(dest="command", required=True)
    conf = documents.Settings.load()
    for name in ("prepare", *STEPS[1:], "all", "status", "inspect", "reset"):
        s = sub.add_parser(name)
        s.add_argument("--root", required=True, help="folder of the corpus: archives, members, papers, state")
        s.add_argument("--paper", action="append", default=[], help="only this source key; may be repeated")
        s.add_argument("--force", action="store_true")
        if name == "reset":
            s.add_argument("--stage", choices=S.STAGES, default="extract")
        if name in ("prepare", "all"):
            s.add_argument("--archive", action="append", default=None)
        if name in ("convert", "all"):
            s.add_argument("--min-chars", type=int, default=conf.min_md_chars)
        if name in ("convert", "preprocess", "extract", "all"):
            s.add_argument("--limit", type=int, default=conf.process_limit, help="at most so many papers, the first by key; 0: all")
        if name in ("preprocess", "extract", "all"):
            s.add_argument("--replies", help="JSON file of recorded replies, for runs without a client")
        if name == "all":
            s.add_argument("--from-stage", choices=STEPS, default=STEPS[0])
            s.add_argument("--to-stage", choices=STEPS, default=STEPS[-1])
    return p


def run_stage(a: argparse.Namespace, spark: SparkSession, state: DataFrame, only: Column, now: str, now_s: float, client: P.Client) -> int:
    """``preprocess`` and ``extract``: the claim is written before the model is asked, the state after what was made."""
    state_path, conf = f"{a.root}/state", documents.Settings.load()
    if a.force:
        snapshots.archive_run(spark, a.root, KEPT, now.replace("/", "-"), (a.command,))
        state = S.reset_stage(state, a.command, only, now)
    claimed = pipeline.claim(state, a.command, now_s, now, only, a.limit)
    snapshots.replace(claimed, state_path)
    papers = spark.read.parquet(f"{a.root}/papers")
    meta, entries = (snapshots.read_or_none(spark, f"{a.root}/{n}") for n in ("metadata", "entries"))
    if a.command == "preprocess":
        new, made = pipeline.preprocess_stage(claimed, papers, client, now, now_s, conf.metadata_head_chars)
        rest = None if meta is None else meta.join(made.select("source_key"), "source_key", "left_anti")
        snapshots.replace(made if rest is None else rest.unionByName(made, allowMissingColumns=True), f"{a.root}/metadata")
        if entries is not None:  # they rest on the old metadata
            snapshots.replace(entries.join(made.select("doc_id"), "doc_id", "left_anti"), f"{a.root}/entries")
    else:
        names = tuple(filter(None, conf.extract_groups.split(","))) or P.DEFAULT_GROUPS
        out = pipeline.extract_claimed(claimed, papers, entries, client, now, now_s, names, conf.extract_group_spec, conf.llm_model)
        new = out["state"]
        snapshots.replace(out["entries"], f"{a.root}/entries")
        # S-14: what was answered, and what became of every anchor
        asked = out["replies"].select("source_key", "grp", "reply", "error").withColumn("asked_at", F.lit(now))
        asked.write.mode("append").parquet(f"{a.root}/llm_raw")
        out["audit"].withColumn("made_at", F.lit(now)).write.mode("append").parquet(f"{a.root}/evidence_audit")
        if meta is not None:
            old = meta if "extraction_info" in meta.columns else meta.withColumn("extraction_info", F.lit(None).cast(out["info"].schema["extraction_info"].dataType))
            stamped = old.join(out["info"].withColumnRenamed("extraction_info", "__new"), "source_key", "left")
            snapshots.replace(stamped.withColumn("extraction_info", F.coalesce("__new", "extraction_info")).drop("__new"), f"{a.root}/metadata")
    snapshots.replace(new, state_path)
    status = F.col(f"{a.command}_status")
    return 1 if snapshots.read_or_none(spark, state_path).where(only & status.isin("failed", "partial")).count() else 0


def main(argv: list[str] | None = None, spark: SparkSession | None = None, client: P.Client | None = None) -> int:
    """0: all went well; 1: something failed; 2: a wrong call."""
    a = parser().parse_args(argv)
    if a.command == "all":
        first, last = STEPS.index(a.from_stage), STEPS.index(a.to_stage)
        if first > last:
            print("--from-stage has to come before --to-stage", file=sys.stderr)
            return 2
        worst = 0
        for step in STEPS[first : last + 1]:
            own = {"prepare": [x for n in a.archive or () for x in ("--archive", n)], "convert": ["--min-chars", str(a.min_chars), "--limit", str(a.limit)]}.get(step, ["--limit", str(a.limit), *(["--replies", a.replies] if a.replies else [])])
            code = main([step, "--root", a.root, *(x for p in a.paper for x in ("--paper", p)), *(["--force"] if a.force else []), *own], spark, client)
            if code == 2:
                return code
            worst = max(code, worst)
        return worst
    if a.command in ("preprocess", "extract") and client is None:
        if not a.replies:
            print("a client or --replies is needed", file=sys.stderr)
            return 2
        with open(a.replies, encoding="utf-8") as f:
            client = P.replay(json.load(f))
    spark = spark or SparkSession.builder.getOrCreate()
    ship(spark)
    now, state_path = datetime.datetime.now().strftime("%m/%d/%Y/%H:%M:%S"), f"{a.root}/state"
    old = snapshots.read_or_none(spark, state_path)
    state = S.migrate(spark.createDataFrame([], S.schema())) if old is None else old
    only = F.col("source_key").isin(a.paper) if a.paper else F.lit(True)
    if a.command == "prepare":
        out = archives.prepare(spark, f"{a.root}/archives", a.root, now, a.archive, a.force)
        out.show(truncate=False)
        return 1 if out.where("status = 'failed'").count() else 0
    if a.command == "convert":
        if a.force and old is not None:
            snapshots.archive_run(spark, a.root, KEPT, now.replace("/", "-"), ("convert",))
            state = S.reset_stage(state, "convert", only, now)
        pdfs = spark.read.parquet(f"{a.root}/members").where(only).select("source_key", "content", F.col("sha256_96").alias("source_pdf_sha256_96"))
        if a.limit:
            todo = pdfs.select("source_key").join(state.where("convert_status = 'done'").select("source_key"), "source_key", "left_anti")
            pdfs = pdfs.join(todo.distinct().orderBy(*archives.path_order()).limit(a.limit), "source_key", "left_semi")
        new, papers = pipeline.convert_stage(state, pdfs, now, a.min_chars)
        papers.write.mode("append").parquet(f"{a.root}/papers")
        snapshots.replace(new, state_path)
        return 1 if new.where(only & (F.col("convert_status") == "failed")).count() else 0
    if a.command in ("preprocess", "extract"):
        return run_stage(a, spark, state, only, now, time.time(), client)
    if a.command == "reset":
        snapshots.replace(S.reset_stage(state, a.stage, only, now) if a.paper else S.reset_failed(state, a.stage, now), state_path)
        return 0
    if a.command == "status":
        if a.paper:
            S.records(state.where(only)).show(truncate=False)
        else:
            for f in (S.stats, S.char_stats, S.token_totals, S.skip_histogram):
                f(state).show(truncate=False)
        return 0
    papers = spark.read.parquet(f"{a.root}/papers") if snapshots.exists(spark, f"{a.root}/papers") else spark.createDataFrame([], "source_key string, text string")
    entries = snapshots.read_or_none(spark, f"{a.root}/entries")
    if entries is None:
        entries = spark.createDataFrame([], "doc_id string, evidence struct<page:int>")
    raw = spark.read.parquet(f"{a.root}/llm_raw") if snapshots.exists(spark, f"{a.root}/llm_raw") else None
    pipeline.inspect(state.where(only), papers.where(only), entries, state.where(only & F.col("doc_id").isNotNull()).select("source_key", "doc_id"), raw).orderBy("source_key").show(truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
