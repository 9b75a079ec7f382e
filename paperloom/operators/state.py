"""State of papers as pure transitions: a frame of the state table in, the next snapshot's frame out (G-*, A-1 to A-4, L-3).

Parquet has no MERGE; a transition is a projection over the table, and the store writes snapshots (see ``sources.snapshots``).
Times are given, never read from the clock, so that a transition is repeatable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

STAGES = ("convert", "preprocess", "extract")
#: Format of the state's time stamps, seconds of a lease.
STAMP = "MM/dd/yyyy/HH:mm:ss"
LEASE = 600

#: The 26 columns of the state table.
COLUMNS = {
    "source_key": T.StringType(), "convert_status": T.StringType(), "preprocess_status": T.StringType(), "extract_status": T.StringType(), "char_count": T.LongType(), "skip_reason": T.StringType(),
    "retry_count": T.IntegerType(), "error_msg": T.StringType(), "claimed_at": T.DoubleType(), "updated_at": T.StringType(), "extract_model": T.StringType(), "content_hash": T.StringType(), "doc_id": T.StringType(),
    "source_pdf_sha256_96": T.StringType(), "converted_text_sha256_96": T.StringType(), "duplicate_of": T.StringType(), "skip_code": T.StringType(), "skip_detail": T.StringType(), "convert_at": T.StringType(),
    "preprocess_at": T.StringType(), "extract_at": T.StringType(), "preprocess_prompt_tokens": T.IntegerType(), "preprocess_completion_tokens": T.IntegerType(), "extract_prompt_tokens": T.IntegerType(),
    "extract_completion_tokens": T.IntegerType(), "extract_failed_groups": T.StringType(),
}


def schema() -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in COLUMNS.items()])


def _stage(stage: str) -> str:
    if stage not in STAGES:
        raise ValueError(f"no stage {stage}")
    return stage


def stamp(x: Column | str) -> Column:
    """A state time stamp as a timestamp."""
    return F.try_to_timestamp(F.col(x) if isinstance(x, str) else x, F.lit(STAMP))


def migrate(df: DataFrame) -> DataFrame:
    """G-1: a table of an older layout with all columns: ``stem`` becomes ``source_key``, missing columns are null."""
    if "stem" in df.columns and "source_key" not in df.columns:
        pdf = lambda x: F.when(F.lower(x).endswith(".pdf"), x).otherwise(F.concat(x, F.lit(".pdf")))
        df = df.withColumn("source_key", pdf(F.col("stem")))
        if "duplicate_of" in df.columns:
            df = df.withColumn("duplicate_of", F.when(F.coalesce(F.col("duplicate_of"), F.lit("")) != "", pdf(F.col("duplicate_of"))))
    defaults = {f"{s}_status": F.lit("pending") for s in STAGES} | {"retry_count": F.lit(0)}
    return df.select(*[(F.col(n) if n in df.columns else defaults.get(n, F.lit(None))).cast(t).alias(n) for n, t in COLUMNS.items()])


def current(df: DataFrame) -> DataFrame:
    """One row a paper: the state with the latest ``updated_at``; late arrivals of older states lose, repeated rows collapse.

    Ties are broken by the whole row, so the result does not depend on the order of the rows.
    """
    rest = [n for n in df.columns if n != "source_key"]
    newest = F.max(F.struct(stamp("updated_at").alias("__at"), *rest))
    return df.groupBy("source_key").agg(newest.alias("__s")).select("source_key", *[F.col(f"__s.{n}").alias(n) for n in rest])


def register(df: DataFrame, keys: DataFrame, now: str) -> DataFrame:
    """G-2: the table with the keys that it lacks, pending in every stage."""
    new = keys.select("source_key").distinct().join(df.select("source_key"), "source_key", "left_anti").withColumn("updated_at", F.lit(now))
    return df.unionByName(migrate(new))


def eligible(stage: str) -> Column:
    """P-8: whether a row may be claimed for a stage."""
    col, free = F.col(f"{_stage(stage)}_status"), F.col("skip_reason").isNull() & F.col("skip_code").isNull()
    if stage == "extract":
        return col.isin("pending", "partial") & free & (F.col("preprocess_status") == "done")
    if stage == "preprocess":
        return (col == "pending") & free & (F.col("convert_status") == "done")
    return (col == "pending") & free


def expire(df: DataFrame, stage: str, now_s: float, now: str) -> DataFrame:
    """Running rows whose lease is over are pending again."""
    over = (F.col(f"{_stage(stage)}_status") == "running") & (F.col("claimed_at") < now_s - LEASE)
    return _update(df, over, {f"{stage}_status": F.lit("pending"), "claimed_at": F.lit(None), "updated_at": F.lit(now)})


def claim(df: DataFrame, stage: str, now_s: float, now: str, limit: int | None = None) -> DataFrame:
    """G-3: a batch of eligible rows set running, the first ``limit`` by key (all without one)."""
    df = expire(df, stage, now_s, now)
    ok = eligible(stage)
    if limit is not None:
        first = df.where(ok).select("source_key").orderBy("source_key").limit(limit).withColumn("__mine", F.lit(True))
        df = df.join(F.broadcast(first) if limit <= 100_000 else first, "source_key", "left")
        ok = F.coalesce("__mine", F.lit(False))
    out = _update(df, ok, {f"{stage}_status": F.lit("running"), "claimed_at": F.lit(now_s), "updated_at": F.lit(now)})
    return out.drop("__mine")


def _update(df: DataFrame, where: Column, values: dict[str, Column]) -> DataFrame:
    where = F.coalesce(where, F.lit(False))
    return df.withColumns({n: F.when(where, v.cast(COLUMNS[n])).otherwise(F.col(n)) for n, v in values.items()})


def mark_done(df: DataFrame, where: Column, stage: str, now: str) -> DataFrame:
    """G-4: the stage is done; its error and every skip field are cleared."""
    none = {n: F.lit(None) for n in ("error_msg", "skip_reason", "skip_code", "skip_detail", "duplicate_of")}
    return _update(df, where, {f"{_stage(stage)}_status": F.lit("done"), f"{stage}_at": F.lit(now), "updated_at": F.lit(now)} | none)


def mark_failed(df: DataFrame, where: Column, stage: str, message: Column, now: str) -> DataFrame:
    """G-5: the stage failed once more."""
    return _update(df, where, {f"{_stage(stage)}_status": F.lit("failed"), "retry_count": F.col("retry_count") + 1, "error_msg": F.substring(message, 1, 500), "updated_at": F.lit(now)})


def skip(df: DataFrame, where: Column, code: str, detail: Column, now: str, duplicate_of: Column | None = None, unconverted: bool = False) -> DataFrame:
    """G-6: the paper takes no further part; ``unconverted`` if its conversion never ran."""
    detail = F.coalesce(detail, F.lit(""))
    values = {
        "skip_reason": F.substring(F.when(detail != "", F.concat(F.lit(f"{code}: "), detail)).otherwise(F.lit(code)), 1, 200), "skip_code": F.lit(code[:80]), "skip_detail": F.substring(detail, 1, 500),
        "duplicate_of": F.lit(None) if duplicate_of is None else duplicate_of, "preprocess_status": F.lit("skipped"), "extract_status": F.lit("skipped"), "claimed_at": F.lit(None), "updated_at": F.lit(now),
    }
    return _update(df, where, values | ({"convert_status": F.lit("skipped")} if unconverted else {}))


def release(df: DataFrame, where: Column, stage: str, now: str) -> DataFrame:
    """G-7: claimed rows are pending again."""
    return _update(df, where, {f"{_stage(stage)}_status": F.lit("pending"), "claimed_at": F.lit(None), "updated_at": F.lit(now)})


def processed(df: DataFrame, stage: str) -> DataFrame:
    """G-8: the keys whose stage is done, or done in part."""
    return df.where(F.col(f"{_stage(stage)}_status").isin("done", "partial")).select("source_key")


def reset_failed(df: DataFrame, stage: str, now: str, where: Column | None = None) -> DataFrame:
    """G-9: failed rows are pending again; all of them only without a condition."""
    failed = F.col(f"{_stage(stage)}_status") == "failed"
    return _update(df, failed if where is None else failed & where, {f"{stage}_status": F.lit("pending"), "updated_at": F.lit(now)})


#: What a reset of a stage clears, beside the stage itself.
_TOKENS = {s: (f"{s}_prompt_tokens", f"{s}_completion_tokens") for s in ("preprocess", "extract")}
_EXTRACT_OWN = ("extract_failed_groups", "extract_model", *_TOKENS["extract"])
_RESETS = {
    "convert": ("char_count", "content_hash", "doc_id", "source_pdf_sha256_96", "converted_text_sha256_96", "skip_reason", "skip_code", "skip_detail", "duplicate_of", "preprocess_at", "extract_at", *_TOKENS["preprocess"], *_EXTRACT_OWN),
    "preprocess": (*_TOKENS["preprocess"], "extract_at", *_EXTRACT_OWN),
    "extract": _EXTRACT_OWN,
}


def reset_stage(df: DataFrame, stage: str, where: Column, now: str) -> DataFrame:
    """G-10: a stage and what follows from it start again; a skipped paper only from its conversion on."""
    _stage(stage)
    if stage != "convert":
        where = where & F.col("skip_reason").isNull() & F.col("skip_code").isNull()
    values = {f"{s}_status": F.lit("pending") for s in STAGES[STAGES.index(stage) :]} | {n: F.lit(None) for n in ("claimed_at", "error_msg", *_RESETS[stage])}
    return _update(df, where, values | {"updated_at": F.lit(now)})


def reset_skipped(df: DataFrame, now: str) -> DataFrame:
    """G-11: skipped papers take part again."""
    where = F.col("skip_reason").isNotNull() | F.col("skip_code").isNotNull()
    values = {f"{s}_status": F.when(F.col(f"{s}_status") == "skipped", "pending").otherwise(F.col(f"{s}_status")) for s in STAGES}
    return _update(df, where, values | {n: F.lit(None) for n in ("skip_reason", "skip_code", "skip_detail", "duplicate_of")} | {"updated_at": F.lit(now)})


def record(df: DataFrame, facts: DataFrame, now: str) -> DataFrame:
    """G-12 to G-15: set the columns of ``facts`` (source_key and any state columns) where they are given."""
    names = [n for n in facts.columns if n != "source_key"]
    f = facts.select("source_key", *[F.col(n).alias(f"__new_{n}") for n in names], F.lit(True).alias("__hit"))
    out = df.join(f, "source_key", "left")
    values = {n: F.coalesce(F.col(f"__new_{n}").cast(COLUMNS[n]), F.col(n)) for n in names}
    return out.withColumns(values | {"updated_at": F.when(F.col("__hit"), F.lit(now)).otherwise(F.col("updated_at"))}).select(*df.columns)


def set_failed_groups(df: DataFrame, where: Column, groups: Column, now: str) -> DataFrame:
    """G-15: the failed groups of rows (an array); with any the extraction is partial, without one they are cleared."""
    names = F.array_join(F.array_sort(F.array_distinct(F.filter(F.coalesce(groups, F.array().cast("array<string>")), lambda g: g != ""))), ",")
    out = _update(df, where, {"extract_failed_groups": F.nullif(names, F.lit("")), "updated_at": F.lit(now)})
    return _update(out, where & (names != ""), {"extract_status": F.lit("partial")})


def stage_totals(df: DataFrame) -> DataFrame:
    """A-11: (stage, done, tokens_in, tokens_out, tokens_a_paper) of the stages that ask a model."""
    of = lambda s: F.struct(
        F.lit(s).alias("stage"), (F.col(f"{s}_status") == "done").alias("done"), F.coalesce(f"{s}_prompt_tokens", F.lit(0)).alias("i"), F.coalesce(f"{s}_completion_tokens", F.lit(0)).alias("o")
    )
    per = df.select(F.explode(F.array(of("preprocess"), of("extract"))).alias("x")).groupBy("x.stage").agg(F.count_if("x.done").alias("done"), F.sum("x.i").alias("tokens_in"), F.sum("x.o").alias("tokens_out"))
    return per.withColumn("tokens_a_paper", F.when(F.col("done") > 0, F.floor((F.col("tokens_in") + F.col("tokens_out")) / F.col("done"))))


def failed_groups(df: DataFrame) -> DataFrame:
    """G-15: (source_key, groups) of the papers with failed groups."""
    groups = F.filter(F.transform(F.split("extract_failed_groups", ","), F.trim), lambda g: g != "")
    return df.select("source_key", groups.alias("groups")).where(F.size("groups") > 0)


def records(df: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """G-16: the rows of the given keys (all without any), by key."""
    return (df if keys is None else df.join(keys.select("source_key").distinct(), "source_key", "left_semi")).orderBy("source_key")


def stats(df: DataFrame) -> DataFrame:
    """A-1, G-17: one row with the counts of each stage."""
    n = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    of = lambda s, v: n(F.col(f"{s}_status") == v)
    return df.agg(
        of("convert", "done").alias("conv_done"), of("convert", "pending").alias("conv_pending"), of("convert", "failed").alias("conv_fail"), of("convert", "skipped").alias("conv_skipped"),
        of("preprocess", "done").alias("pre_done"), of("preprocess", "pending").alias("pre_pending"), of("preprocess", "failed").alias("pre_fail"),
        of("extract", "done").alias("ext_done"), of("extract", "pending").alias("ext_pending"), of("extract", "failed").alias("ext_fail"),
        n(F.col("skip_reason").isNotNull()).alias("skipped"), F.count("*").alias("total"),
    )


def char_stats(df: DataFrame) -> DataFrame:
    """A-2: number, sum and mean of the known text lengths."""
    return df.agg(F.count("char_count").alias("cnt"), F.sum("char_count").alias("total"), F.round(F.avg("char_count"), 6).alias("mean"))


def token_totals(df: DataFrame) -> DataFrame:
    """A-3: token sums of each stage and their mean over its done papers, cut to an integer."""
    parts = []
    for s in ("preprocess", "extract"):
        a, b = (F.coalesce(F.sum(f"{s}_{k}_tokens"), F.lit(0)) for k in ("prompt", "completion"))
        done = F.greatest(F.count_if(F.coalesce(F.col(f"{s}_status") == "done", F.lit(False))), F.lit(1))
        parts += [a.cast("long").alias(f"{s}_in"), b.cast("long").alias(f"{s}_out"), F.floor((a + b) / done).cast("long").alias(f"{s}_mean")]
    return df.agg(*parts)


def skip_histogram(df: DataFrame) -> DataFrame:
    """A-4: skipped papers by code, most frequent first."""
    hit = df.where(F.col("skip_reason").isNotNull() | F.col("skip_code").isNotNull())
    return hit.groupBy(F.coalesce("skip_code", F.lit("legacy_reason")).alias("code")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "code")


def top_tokens(df: DataFrame, stage: str = "extract", limit: int = 20) -> DataFrame:
    """L-3: the papers with most tokens; fused by the planner to one bounded heap a task."""
    a, b = F.col(f"{_stage(stage)}_prompt_tokens"), F.col(f"{stage}_completion_tokens")
    return df.where(a.isNotNull()).select("source_key", a.alias("tokens_in"), b.alias("tokens_out"), (a + b).alias("tokens")).orderBy(F.desc("tokens"), "source_key").limit(limit)


def keep_first(df: DataFrame, fingerprint: str, order: list[Column], valid: Column | None = None) -> DataFrame:
    """W-1, W-2, J-3: (…, is_kept, duplicate_of): of rows with one fingerprint the first in ``order`` is kept, the others point to it.

    Rows without a fingerprint, or for which ``valid`` is not true, are kept and take no part. A fingerprint that a third of
    the rows share is no single sort: its first row comes from a partial aggregation and is joined back.
    """
    ok = F.col(fingerprint).isNotNull() & (F.lit(True) if valid is None else F.coalesce(valid, F.lit(False)))
    key = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])
    first = df.where(ok).groupBy(F.col(fingerprint).alias("__fp")).agg(F.min(F.struct(key.alias("k"), F.col("source_key"))).alias("__first"), F.count("*").alias("__n")).where("__n > 1").select("__fp", "__first")
    out = df.withColumn("__ok", ok).join(first, F.col("__ok") & (F.col(fingerprint) == F.col("__fp")), "left")
    dup = F.col("__first").isNotNull() & (F.col("__first.source_key") != F.col("source_key"))
    return out.withColumn("is_kept", ~dup).withColumn("duplicate_of", F.when(dup, F.col("__first.source_key"))).drop("__ok", "__fp", "__first")


def linked_first(df: DataFrame, fingerprint: str) -> DataFrame:
    """G-13, G-14: for each row the least other key with its fingerprint that is not skipped (``prior``), null without one.

    Two least keys of each fingerprint are enough, so the self-join on (fingerprint, key <> key) is an aggregation.
    """
    two = F.slice(F.sort_array(F.collect_set("source_key")), 1, 2)
    live = df.where(F.col("skip_code").isNull() & F.col(fingerprint).isNotNull())
    # partial minima first: the set that is collected has at most one key a (fingerprint, salt)
    salted = live.groupBy(fingerprint, F.pmod(F.xxhash64("source_key"), F.lit(64)).alias("salt")).agg(F.min("source_key").alias("a"))
    second = live.join(salted.select(F.col(fingerprint).alias("__f"), "a"), (F.col(fingerprint) == F.col("__f")) & (F.col("source_key") == F.col("a")), "left_anti").groupBy(fingerprint, F.pmod(F.xxhash64("source_key"), F.lit(64)).alias("salt")).agg(F.min("source_key").alias("a"))
    least = salted.unionByName(second).select(fingerprint, F.col("a").alias("source_key")).groupBy(F.col(fingerprint).alias("__fp")).agg(two.alias("__two"))
    out = df.join(least, F.col(fingerprint) == F.col("__fp"), "left")
    return out.withColumn("prior", F.get(F.filter("__two", lambda k: k != F.col("source_key")), F.lit(0))).drop("__fp", "__two")


def row_number(partition: list[str], order: list[Column]) -> Column:
    return F.row_number().over(Window.partitionBy(*partition).orderBy(*order))
