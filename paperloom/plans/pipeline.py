"""The stages as one flow over tables: convert, preprocess, extract, inspect (section 3 of the survey)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions import identity, text as X
from paperloom.operators import entries as N
from paperloom.operators import metadata as M
from paperloom.operators import prompts as P
from paperloom.operators import state as S
from paperloom.sources import documents as D
from paperloom.tables import materialise


def convert_stage(state: DataFrame, pdfs: DataFrame, now: str, min_chars: int = 10_000, converter: D.Converter = D.plain_pages) -> tuple[DataFrame, DataFrame]:
    """(state, papers): papers that are not done yet are fingerprinted; of equal files only the first is converted; too short and repeated
    texts are skipped (W-1, W-2, P-5, P-6, G-18)."""
    state = S.register(state, pdfs, now)
    todo = pdfs.join(state.where("convert_status <> 'done'").select("source_key"), "source_key", "left_semi")
    known = state.where("convert_status = 'done'").select("source_key", "source_pdf_sha256_96", F.lit(True).alias("done"))
    both = known.unionByName(todo.select("source_key", "source_pdf_sha256_96", F.lit(False).alias("done")))
    first = materialise(S.keep_first(both, "source_pdf_sha256_96", [~F.col("done"), F.split("source_key", "/")]).where("NOT done"), "first")
    made = materialise(D.convert(todo.join(first.where("is_kept").select("source_key"), "source_key", "left_semi"), converter), "made")
    old = state.where("convert_status = 'done'").select("source_key", "converted_text_sha256_96", F.lit(True).alias("done"), F.lit(True).alias("long"))
    text = old.unionByName(made.where("error IS NULL").select("source_key", "converted_text_sha256_96", F.lit(False).alias("done"), (F.col("char_count") >= min_chars).alias("long")))
    second = S.keep_first(text, "converted_text_sha256_96", [~F.col("done"), F.split("source_key", "/")], F.col("long")).where("NOT done").select("source_key", "long", F.col("is_kept").alias("text_kept"), F.col("duplicate_of").alias("text_of"))
    facts = (
        first.select("source_key", F.col("source_pdf_sha256_96").alias("fp"), "is_kept", F.col("duplicate_of").alias("pdf_of"))
        .join(made.select("source_key", F.col("char_count").alias("chars"), F.col("converted_text_sha256_96").alias("tfp"), "error"), "source_key", "left")
        .join(second, "source_key", "left")
        .withColumn("hit", F.lit(True))
    )
    cols = state.columns
    s = state.join(materialise(facts, "facts"), "source_key", "left")
    hit, good = F.col("hit") & F.col("is_kept"), F.col("hit") & F.col("is_kept") & F.col("error").isNull()
    s = S._update(s, F.col("hit"), {"source_pdf_sha256_96": F.col("fp"), "content_hash": F.col("fp"), "doc_id": identity.doc_id_or_null("fp")})
    s = S.mark_done(s, good, "convert", now)
    s = S._update(s, good, {"char_count": F.col("chars"), "converted_text_sha256_96": F.col("tfp")})
    s = S.mark_failed(s, hit & F.col("error").isNotNull(), "convert", F.col("error"), now)
    s = S.skip(s, F.col("hit") & ~F.col("is_kept"), "duplicate_pdf", F.concat(F.lit("same bytes as "), "pdf_of"), now, F.col("pdf_of"), unconverted=True)
    s = S.skip(s, good & ~F.col("long"), "insufficient_text", F.concat(F.col("chars").cast("string"), F.lit(" characters")), now)
    s = S.skip(s, good & F.col("long") & ~F.col("text_kept"), "duplicate_markdown", F.concat(F.lit("same text as "), "text_of"), now, F.col("text_of"))
    return s.select(*cols), made.where("error IS NULL").select("source_key", "text")


_LEVELS = "struct<level1:string,level2:string,level3:string>"


def claim(state: DataFrame, stage: str, now_s: float, now: str, only: Column | None = None, limit: int = 0) -> DataFrame:
    """The state with the eligible papers of a stage set running, those of ``only`` where it is given, the first ``limit`` by key (P-7; 0: all); to
    be written before the stage is run."""
    most = limit or None
    if only is None:
        return materialise(S.claim(state, stage, now_s, now, most), "claimed")
    return materialise(S.claim(state.where(only), stage, now_s, now, most).unionByName(state.where(~F.coalesce(only, F.lit(False)))), "claimed")


def _claimed(state: DataFrame, papers: DataFrame, stage: str, now_s: float) -> tuple[Column, DataFrame]:
    """Whether a row was claimed at ``now_s``, and (source_key, doc_id, …, text) of those rows: of a paper converted twice its current text."""
    mine = (F.col(f"{stage}_status") == "running") & (F.col("claimed_at") == now_s)
    text = papers.select("source_key", "text", identity.fingerprint("text").alias("converted_text_sha256_96")).dropDuplicates(["source_key", "converted_text_sha256_96"])
    rows = state.where(mine & F.col("doc_id").isNotNull()).select("source_key", "doc_id", "source_pdf_sha256_96", "converted_text_sha256_96", "extract_failed_groups")
    return mine, materialise(rows.join(text, ["source_key", "converted_text_sha256_96"]), "todo")


def preprocess_stage(state: DataFrame, papers: DataFrame, client: P.Client, now: str, now_s: float, head: int = 5000) -> tuple[DataFrame, DataFrame]:
    """(state, metadata) of the papers that :func:`claim` set running: what their text gives (T-15 to T-20) and the model's answer (Q-2), validated
    and put together (K-9, K-10). A paper without a text, a title or disciplines of the list fails."""
    mine, todo = _claimed(state, papers, "preprocess", now_s)
    read = materialise(M.cascade(todo), "read")
    prompts = todo.join(read.select("source_key", "abstract", "introduction"), "source_key").select("source_key", F.lit("metadata").alias("grp"), P.metadata_prompt("text", "abstract", "introduction", head).alias("prompt"))
    replies = materialise(P.call(prompts, client), "replies")
    at = lambda n: F.get_json_object("reply", f"$.{n}")
    answers = replies.where("reply IS NOT NULL").select(
        "source_key", at("title").alias("title"), at("year").try_cast("int").alias("year"), at("doi").alias("doi"), F.from_json(at("keywords"), "array<string>").alias("keywords"),
        F.from_json(at("primary_discipline"), _LEVELS).alias("primary_discipline"), F.from_json(at("secondary_disciplines"), f"array<{_LEVELS}>").alias("secondary_disciplines"),
    )
    made = M.validate_disciplines(M.assemble(answers, read))
    made = made.withColumns({"title": X.strip("title"), "primary_discipline": F.col("primary_valid"), "secondary_disciplines": F.col("secondary_valid")}).drop("primary_valid", "secondary_valid")
    made = materialise(made.join(todo.select("source_key", "doc_id", "source_pdf_sha256_96", "converted_text_sha256_96"), "source_key"), "metadata")
    error = F.coalesce("error", F.when(F.col("__asked").isNull(), "no text or fingerprint"), F.when(F.col("__ok").isNull(), "no title in the reply"), F.when(~F.col("__ok"), "a discipline is not in the list"))
    s = state.join(replies.select("source_key", "error", "prompt_tokens", "completion_tokens", F.lit(True).alias("__asked")), "source_key", "left").join(made.select("source_key", F.col("disciplines_ok").alias("__ok")), "source_key", "left")
    s = s.withColumns({"__mine": F.coalesce(mine, F.lit(False)), "__error": error})
    s = S._update(s, F.col("__mine"), {"preprocess_prompt_tokens": F.col("prompt_tokens"), "preprocess_completion_tokens": F.col("completion_tokens"), "claimed_at": F.lit(None)})
    s = S.mark_done(s, F.col("__mine") & F.col("__error").isNull(), "preprocess", now)
    s = S.mark_failed(s, F.col("__mine") & F.col("__error").isNotNull(), "preprocess", F.col("__error"), now)
    return s.select(*state.columns), made.where("disciplines_ok").drop("disciplines_ok")


def extract_claimed(
    state: DataFrame, papers: DataFrame, old: DataFrame | None, client: P.Client, now: str, now_s: float, names: tuple[str, ...] = P.DEFAULT_GROUPS, spec: str = "", model: str = ""
) -> dict[str, DataFrame]:
    """``state``, all ``entries``, ``audit`` and ``info`` (K-11: source_key, extraction_info) after the papers that :func:`claim` set running:
    of a paper with failed groups only those are asked, and replace what ``old`` has of their types; any other paper is done anew. A paper with
    failed groups stays partial."""
    mine, todo = _claimed(state, papers, "extract", now_s)
    groups = P.group_table(papers.sparkSession, names, spec)
    retry = S.failed_groups(todo).select("source_key", F.explode("groups").alias("grp"), F.lit(True).alias("retry"))
    fresh = todo.join(retry, "source_key", "left_anti").select("source_key").crossJoin(groups.select("grp")).withColumn("retry", F.lit(False))
    asked = materialise(retry.unionByName(fresh).distinct(), "asked")
    ids = todo.select("source_key", "doc_id")
    out = extract_stage(todo.select("source_key", "text"), ids, client, names, spec, asked)
    result = asked.join(out["replies"].select("source_key", "grp", "reply"), ["source_key", "grp"], "left")
    bad = lambda c: F.nullif(F.array_join(F.array_sort(F.collect_set(F.when(c, F.col("grp")))), ","), F.lit(""))
    facts = result.groupBy("source_key").agg(bad(F.col("reply").isNull()).alias("__failed"), bad(F.col("retry")).alias("__retried")).join(out["usage"].withColumnsRenamed({"extract_prompt_tokens": "__p", "extract_completion_tokens": "__c"}), "source_key", "left")
    facts = materialise(facts, "facts")

    new = out["entries"]
    if old is not None:
        again = asked.where("retry").join(groups, "grp").join(ids, "source_key").select("doc_id", F.explode("types").alias("type")).distinct()
        kept = old.join(ids.join(asked.where("NOT retry"), "source_key", "left_semi").select("doc_id"), "doc_id", "left_anti").join(again, ["doc_id", "type"], "left_anti")
        links = ["public_id", "head_entry_id", "tail_entry_id"]
        every = N.merge_retry(kept.drop(*links), new.drop(*links))
        every = N.public_ids(every.withColumn("ord", F.struct((F.col("type") != "concept").alias("late"), "pos")), order="ord").drop("ord")
        linked = N.link_relations(every.where("type = 'relation'"), N.alias_map(every.where("type = 'concept'"), id_col="public_id"))
        new = every.where("type <> 'relation'").unionByName(linked, allowMissingColumns=True)
    new = materialise(new, "entries")

    s = state.join(facts, "source_key", "left").withColumns({"__mine": F.coalesce(mine, F.lit(False)), "__known": F.col("__p").isNotNull()})
    ran = F.col("__mine") & F.col("__known")
    s = S._update(s, F.col("__mine"), {"claimed_at": F.lit(None), "updated_at": F.lit(now)})
    s = S._update(s, ran, {"extract_prompt_tokens": F.col("__p"), "extract_completion_tokens": F.col("__c"), "extract_model": F.lit(model), "extract_failed_groups": F.col("__failed")})
    s = S.mark_done(s, ran & F.col("__failed").isNull(), "extract", now)
    s = S._update(s, ran & F.col("__failed").isNotNull(), {"extract_status": F.lit("partial")})
    s = S.mark_failed(s, F.col("__mine") & ~F.col("__known"), "extract", F.lit("no text, or none of its groups is chosen"), now)
    info = N.extraction_info(F.lit(model), F.lit(now), F.col("__retried"), F.col("__failed"))
    return {"state": s.select(*state.columns), "entries": new, "audit": out["audit"], "replies": out["replies"], "info": facts.where("__p IS NOT NULL").select("source_key", info.alias("extraction_info"))}


def extract_stage(papers: DataFrame, doc_ids: DataFrame, client: P.Client, names: tuple[str, ...] = P.DEFAULT_GROUPS, spec: str = "", only: DataFrame | None = None) -> dict[str, DataFrame]:
    """Prompts, replies, entries, audit and failed groups of the papers (source_key, text); ``doc_ids``: source_key, doc_id; ``only``: the
    (source_key, grp) to ask, all without it. Replies are written before they are read, so that none is asked for twice."""
    groups = P.group_table(papers.sparkSession, names, spec)
    prompts = P.group_prompts(papers, groups)
    if only is not None:
        prompts = prompts.join(only, ["source_key", "grp"], "left_semi")
    replies = materialise(P.call(prompts.repartition(F.col("source_key")), client), "replies")
    items = N.unify_reply(replies.where("reply IS NOT NULL").select("source_key", "ord", "reply"))
    # one position across the groups: their order, concepts first, then the place in the reply
    items = items.join(doc_ids, "source_key").withColumn("pos", F.expr("shiftleft(CAST(ord AS BIGINT), 40)") + F.col("pos"))
    out = N.assemble(items.select("doc_id", "source_key", "pos", "type", "item"), papers)
    failed = replies.where("error IS NOT NULL").groupBy("source_key").agg(F.array_join(F.array_sort(F.collect_set("grp")), ",").alias("extract_failed_groups"))
    usage = replies.groupBy("source_key").agg(F.sum("prompt_tokens").cast("int").alias("extract_prompt_tokens"), F.sum("completion_tokens").cast("int").alias("extract_completion_tokens"))
    return out | {"replies": replies, "failed": failed, "usage": usage}


def inspect(state: DataFrame, papers: DataFrame, entries: DataFrame, doc_ids: DataFrame, raw: DataFrame | None = None) -> DataFrame:
    """J-9, U-1, A-5, A-6, A-12, A-13: a row a paper known anywhere: which artifacts there are, characters and pages, entries and located ones,
    and with ``raw`` (source_key, grp) the recorded replies."""
    keys = state.select("source_key").unionByName(papers.select("source_key")).unionByName(doc_ids.select("source_key")).distinct()
    text = papers.select("source_key", F.length("text").alias("chars"), F.regexp_count("text", F.lit(X.PAGE_MARKER_ANY)).alias("pages"), F.lit(True).alias("has_text")).dropDuplicates(["source_key"])
    ent = entries.groupBy("doc_id").agg(F.count("*").alias("entries"), F.count_if(F.col("evidence.page").isNotNull()).alias("located"))
    ids = doc_ids.select("source_key", "doc_id").dropDuplicates(["source_key"]).withColumn("has_json", F.lit(True))
    st = state.select("source_key", "convert_status", "preprocess_status", "extract_status")
    out = keys.join(st, "source_key", "left").join(text, "source_key", "left").join(ids.join(ent, "doc_id", "left"), "source_key", "left")
    if raw is not None:
        out = out.join(raw_counts(raw), "source_key", "left").withColumn("raw_replies", F.coalesce("raw_replies", F.lit(0)))
    return out.withColumns({"has_text": F.coalesce("has_text", F.lit(False)), "has_json": F.coalesce("has_json", F.lit(False))})


def raw_counts(raw: DataFrame) -> DataFrame:
    """A-13: (source_key, raw_replies): the recorded replies of each paper."""
    return raw.groupBy("source_key").agg(F.count("*").alias("raw_replies"))
