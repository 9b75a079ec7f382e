"""Queries over the state, identities and archives."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.functions import identity, text as X
from paperloom.operators import state as S
from paperloom.plans import duck
from paperloom.plans.registry import query
from paperloom.sources import archives
from paperloom.tables import table

NOW, NOW_S = "01/01/2026/00:00:00", 1_767_225_600.0
SHOW = ("source_key", "convert_status", "preprocess_status", "extract_status", "char_count", "retry_count", "error_msg", "skip_reason", "skip_code", "skip_detail", "duplicate_of", "doc_id", "claimed_at", "extract_failed_groups", "extract_prompt_tokens", "updated_at")
COLS = ", ".join(SHOW)


def _state(spark: SparkSession, d: str) -> DataFrame:
    return S.current(table(spark, d, "papers"))


def _set(where: str, **values: str) -> str:
    """An update of the state as a projection."""
    cols = ", ".join(f"CASE WHEN {where} THEN {values[c]} ELSE {c} END AS {c}" if c in values else c for c in SHOW)
    return f"SELECT {cols} FROM {duck.STATE}"


@query("g00_current_state", f"SELECT {COLS} FROM {duck.STATE}")
def g00_current_state(spark, d):
    return _state(spark, d).select(*SHOW)


@query("g02_register", f"SELECT source_key, convert_status, updated_at FROM {duck.STATE} UNION ALL SELECT DISTINCT source_key, 'pending', '{NOW}' FROM documents WHERE source_key NOT IN (SELECT source_key FROM papers)")
def g02_register(spark, d):
    return S.register(_state(spark, d), table(spark, d, "documents"), NOW).select("source_key", "convert_status", "updated_at")


_EXPIRED = f"(extract_status = 'running' AND claimed_at < {NOW_S - S.LEASE})"


@query(
    "g03_claim_extract",
    f"SELECT source_key, CASE WHEN ok THEN 'running' WHEN ex THEN 'pending' ELSE extract_status END AS extract_status, CASE WHEN ok THEN {NOW_S} WHEN ex THEN NULL ELSE claimed_at END AS claimed_at FROM (SELECT *, coalesce({_EXPIRED}, false) AS ex, coalesce((extract_status IN ('pending', 'partial') OR {_EXPIRED}) AND skip_reason IS NULL AND skip_code IS NULL AND preprocess_status = 'done', false) AS ok FROM {duck.STATE})",
)
def g03_claim_extract(spark, d):
    return S.claim(_state(spark, d), "extract", NOW_S, NOW).select("source_key", "extract_status", "claimed_at")


@query("g03_claim_first_50", f"SELECT source_key FROM {duck.STATE} WHERE preprocess_status = 'pending' AND convert_status = 'done' AND skip_reason IS NULL AND skip_code IS NULL ORDER BY source_key LIMIT 50")
def g03_claim_first_50(spark, d):
    """The limit is the feature: a batch of at most so many papers is claimed."""
    s = _state(spark, d).withColumn("claimed_at", F.lit(None).cast("double")).where("preprocess_status <> 'running'")
    return S.claim(s, "preprocess", NOW_S, NOW, 50).where("preprocess_status = 'running'").select("source_key")


@query("g04_mark_done", _set("preprocess_status = 'running'", preprocess_status="'done'", error_msg="NULL", skip_reason="NULL", skip_code="NULL", skip_detail="NULL", duplicate_of="NULL", updated_at=f"'{NOW}'"))
def g04_mark_done(spark, d):
    return S.mark_done(_state(spark, d), F.col("preprocess_status") == "running", "preprocess", NOW).select(*SHOW)


@query("g05_mark_failed", _set("extract_status = 'running'", extract_status="'failed'", retry_count="retry_count + 1", error_msg="substr(repeat('late ', 200), 1, 500)", updated_at=f"'{NOW}'"))
def g05_mark_failed(spark, d):
    return S.mark_failed(_state(spark, d), F.col("extract_status") == "running", "extract", F.lit("late " * 200), NOW).select(*SHOW)


@query(
    "g06_skip_short",
    _set("char_count < 500", skip_reason="'insufficient_text: ' || char_count || ' characters'", skip_code="'insufficient_text'", skip_detail="char_count || ' characters'", duplicate_of="NULL", preprocess_status="'skipped'", extract_status="'skipped'", claimed_at="NULL", updated_at=f"'{NOW}'"),
)
def g06_skip_short(spark, d):
    return S.skip(_state(spark, d), F.col("char_count") < 500, "insufficient_text", F.concat(F.col("char_count").cast("string"), F.lit(" characters")), NOW).select(*SHOW)


@query("g07_release", _set("extract_status = 'running'", extract_status="'pending'", claimed_at="NULL", updated_at=f"'{NOW}'"))
def g07_release(spark, d):
    return S.release(_state(spark, d), F.col("extract_status") == "running", "extract", NOW).select(*SHOW)


@query("g08_processed", f"SELECT source_key FROM {duck.STATE} WHERE extract_status IN ('done', 'partial')")
def g08_processed(spark, d):
    return S.processed(_state(spark, d), "extract")


@query("g09_reset_failed", _set("preprocess_status = 'failed'", preprocess_status="'pending'", updated_at=f"'{NOW}'"))
def g09_reset_failed(spark, d):
    return S.reset_failed(_state(spark, d), "preprocess", NOW).select(*SHOW)


_NOTSKIPPED = "skip_reason IS NULL AND skip_code IS NULL"


@query("g10_reset_convert", _set("convert_status = 'failed'", convert_status="'pending'", preprocess_status="'pending'", extract_status="'pending'", char_count="NULL", doc_id="NULL", skip_reason="NULL", skip_code="NULL", skip_detail="NULL", duplicate_of="NULL", claimed_at="NULL", error_msg="NULL", extract_failed_groups="NULL", extract_prompt_tokens="NULL", updated_at=f"'{NOW}'"))
def g10_reset_convert(spark, d):
    return S.reset_stage(_state(spark, d), "convert", F.col("convert_status") == "failed", NOW).select(*SHOW)


@query("g10_reset_preprocess", _set(f"preprocess_status = 'done' AND {_NOTSKIPPED}", preprocess_status="'pending'", extract_status="'pending'", claimed_at="NULL", error_msg="NULL", extract_failed_groups="NULL", extract_prompt_tokens="NULL", updated_at=f"'{NOW}'"))
def g10_reset_preprocess(spark, d):
    return S.reset_stage(_state(spark, d), "preprocess", F.col("preprocess_status") == "done", NOW).select(*SHOW)


@query("g10_reset_extract", _set(f"extract_status = 'partial' AND {_NOTSKIPPED}", extract_status="'pending'", claimed_at="NULL", error_msg="NULL", extract_failed_groups="NULL", extract_prompt_tokens="NULL", updated_at=f"'{NOW}'"))
def g10_reset_extract(spark, d):
    return S.reset_stage(_state(spark, d), "extract", F.col("extract_status") == "partial", NOW).select(*SHOW)


@query(
    "g11_reset_skipped",
    _set("(skip_reason IS NOT NULL OR skip_code IS NOT NULL)", **{f"{s}_status": f"CASE WHEN {s}_status = 'skipped' THEN 'pending' ELSE {s}_status END" for s in S.STAGES}, skip_reason="NULL", skip_code="NULL", skip_detail="NULL", duplicate_of="NULL", updated_at=f"'{NOW}'"),
)
def g11_reset_skipped(spark, d):
    return S.reset_skipped(_state(spark, d), NOW).select(*SHOW)


@query("g12_record_counts", f"SELECT s.source_key, coalesce(c.char_count, s.char_count) AS char_count, CASE WHEN c.source_key IS NOT NULL THEN '{NOW}' ELSE s.updated_at END AS updated_at FROM {duck.STATE} s LEFT JOIN (SELECT source_key, max(char_count) AS char_count FROM convert_result GROUP BY 1) c USING (source_key)")
def g12_record_counts(spark, d):
    facts = table(spark, d, "convert_result").groupBy("source_key").agg(F.max("char_count").alias("char_count"))
    return S.record(_state(spark, d), facts, NOW).select("source_key", "char_count", "updated_at")


@query("g15_failed_groups", f"SELECT source_key, trim(g) AS grp FROM {duck.STATE}, unnest(string_split(extract_failed_groups, ',')) AS u(g) WHERE trim(g) <> ''")
def g15_failed_groups(spark, d):
    return S.failed_groups(_state(spark, d)).select("source_key", F.explode("groups").alias("grp"))


@query("g16_records", f"SELECT {COLS} FROM {duck.STATE} WHERE source_key IN (SELECT source_file FROM metadata)")
def g16_records(spark, d):
    return S.records(_state(spark, d), table(spark, d, "metadata").select(F.col("source_file").alias("source_key"))).select(*SHOW)


@query(
    "a01_status_stats",
    "SELECT " + ", ".join(f"coalesce(sum(CASE WHEN {s}_status = '{v}' THEN 1 ELSE 0 END), 0)::BIGINT AS {n}" for s, v, n in (("convert", "done", "conv_done"), ("convert", "pending", "conv_pending"), ("convert", "failed", "conv_fail"), ("convert", "skipped", "conv_skipped"), ("preprocess", "done", "pre_done"), ("preprocess", "pending", "pre_pending"), ("preprocess", "failed", "pre_fail"), ("extract", "done", "ext_done"), ("extract", "pending", "ext_pending"), ("extract", "failed", "ext_fail"))) + f", count(skip_reason) AS skipped, count(*) AS total FROM {duck.STATE}",
)
def a01_status_stats(spark, d):
    return S.stats(_state(spark, d))


@query("a02_char_stats", f"SELECT count(char_count) AS cnt, sum(char_count)::BIGINT AS total, round(avg(char_count), 6) AS mean FROM {duck.STATE}")
def a02_char_stats(spark, d):
    return S.char_stats(_state(spark, d))


@query("a03_token_totals", "SELECT " + ", ".join(f"coalesce(sum({s}_prompt_tokens), 0)::BIGINT AS {s}_in, coalesce(sum({s}_completion_tokens), 0)::BIGINT AS {s}_out, floor((coalesce(sum({s}_prompt_tokens), 0) + coalesce(sum({s}_completion_tokens), 0)) / greatest(count(*) FILTER ({s}_status = 'done'), 1))::BIGINT AS {s}_mean" for s in ("preprocess", "extract")) + f" FROM {duck.STATE}")
def a03_token_totals(spark, d):
    return S.token_totals(_state(spark, d))


@query("a04_skip_histogram", f"SELECT coalesce(skip_code, 'legacy_reason') AS code, count(*) AS n FROM {duck.STATE} WHERE skip_reason IS NOT NULL OR skip_code IS NOT NULL GROUP BY 1")
def a04_skip_histogram(spark, d):
    return S.skip_histogram(_state(spark, d))


@query("l03_top_tokens", f"SELECT source_key, extract_prompt_tokens AS tokens_in, extract_completion_tokens AS tokens_out, extract_prompt_tokens + extract_completion_tokens AS tokens FROM {duck.STATE} WHERE extract_prompt_tokens IS NOT NULL ORDER BY tokens DESC NULLS LAST, source_key LIMIT 20")
def l03_top_tokens(spark, d):
    return S.top_tokens(_state(spark, d))


@query("l04_slowest_conversions", "SELECT source_key, max(elapsed) AS elapsed FROM convert_result GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20")
def l04_slowest_conversions(spark, d):
    """A top-k report: the limit is the feature."""
    return table(spark, d, "convert_result").groupBy("source_key").agg(F.max("elapsed").alias("elapsed")).orderBy(F.desc("elapsed"), "source_key").limit(20)


@query("a11_run_totals", "SELECT count(*) AS papers, round(sum(elapsed), 3) AS elapsed, round(avg(elapsed), 6) AS mean FROM (SELECT DISTINCT source_key, elapsed FROM convert_result WHERE NOT skipped)")
def a11_run_totals(spark, d):
    r = table(spark, d, "convert_result").where(~F.col("skipped")).select("source_key", "elapsed").distinct()
    return r.agg(F.count("*").alias("papers"), F.round(F.sum("elapsed"), 3).alias("elapsed"), F.round(F.avg("elapsed"), 6).alias("mean"))


_FIRST = "SELECT source_key, coalesce(first_value(source_key) OVER w = source_key, true) AS is_kept, CASE WHEN first_value(source_key) OVER w <> source_key THEN first_value(source_key) OVER w END AS duplicate_of FROM {t} WHERE {f} WINDOW w AS (PARTITION BY {f0} ORDER BY {o}) UNION ALL SELECT source_key, true, NULL FROM {t} WHERE NOT coalesce({f}, false)"


@query("w01_keep_first_pdf", _FIRST.format(t=duck.STATE, f="source_pdf_sha256_96 IS NOT NULL", f0="source_pdf_sha256_96", o="convert_status <> 'done', string_split(source_key, '/')"))
def w01_keep_first_pdf(spark, d):
    return S.keep_first(_state(spark, d), "source_pdf_sha256_96", [F.col("convert_status") != "done", F.split("source_key", "/")]).select("source_key", "is_kept", "duplicate_of")


_DOCFP = "(SELECT source_key, text, substr(sha256(text), 1, 24) AS fp FROM documents)"


@query("w02_text_dedup_min_chars", _FIRST.format(t=_DOCFP, f="fp IS NOT NULL AND length(text) >= 500", f0="fp", o="string_split(source_key, '/')"))
def w02_text_dedup_min_chars(spark, d):
    docs = table(spark, d, "documents").withColumn("fp", identity.fingerprint("text"))
    return S.keep_first(docs, "fp", [F.split("source_key", "/")], F.length("text") >= 500).select("source_key", "is_kept", "duplicate_of")


@query("j03_prior_duplicate", f"SELECT p.source_key, min(o.source_key) AS prior FROM {duck.STATE} p LEFT JOIN {duck.STATE} o ON p.converted_text_sha256_96 = o.converted_text_sha256_96 AND p.source_key <> o.source_key AND o.skip_code IS NULL GROUP BY 1")
def j03_prior_duplicate(spark, d):
    return S.linked_first(_state(spark, d), "converted_text_sha256_96").select("source_key", "prior")


@query("j01_left_state", f"SELECT d.doc_id, d.source_key, s.convert_status FROM documents d LEFT JOIN {duck.STATE} s USING (source_key)")
def j01_left_state(spark, d):
    return table(spark, d, "documents").select("doc_id", "source_key").join(_state(spark, d).select("source_key", "convert_status"), "source_key", "left")


@query("j02_pending_anti", f"SELECT DISTINCT source_key FROM documents WHERE source_key NOT IN (SELECT source_key FROM {duck.STATE} WHERE extract_status = 'done')")
def j02_pending_anti(spark, d):
    done = _state(spark, d).where("extract_status = 'done'").select("source_key")
    return table(spark, d, "documents").select("source_key").distinct().join(done, "source_key", "left_anti")


@query("j09_artifact_presence", "SELECT source_key, max(a) AS has_state, max(b) AS has_text, max(c) AS has_json FROM (SELECT source_key, true AS a, false AS b, false AS c FROM papers UNION ALL SELECT source_key, false, true, false FROM documents UNION ALL SELECT source_file, false, false, true FROM metadata) GROUP BY 1")
def j09_artifact_presence(spark, d):
    parts = [table(spark, d, t).select(F.col(k).alias("source_key"), *[F.lit(i == j).alias(n) for j, n in enumerate(("has_state", "has_text", "has_json"))]) for i, (t, k) in enumerate((("papers", "source_key"), ("documents", "source_key"), ("metadata", "source_file")))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("source_key").agg(*[F.max(n).alias(n) for n in ("has_state", "has_text", "has_json")])


@query("u01_artifact_keys", "SELECT source_key FROM papers UNION SELECT source_key FROM documents UNION SELECT source_file FROM metadata")
def u01_artifact_keys(spark, d):
    return table(spark, d, "papers").select("source_key").union(table(spark, d, "documents").select("source_key")).union(table(spark, d, "metadata").select("source_file")).distinct()


@query("pred01_scope", "SELECT doc_id, source_key FROM documents WHERE source_key IN (SELECT source_key FROM papers WHERE skip_code = 'duplicate_text')")
def pred01_scope(spark, d):
    return table(spark, d, "documents").select("doc_id", "source_key").join(table(spark, d, "papers").where("skip_code = 'duplicate_text'").select("source_key"), "source_key", "left_semi")


@query("pred06_min_text", "SELECT doc_id, CASE WHEN coalesce(length(text), 0) < 10000 THEN 'insufficient_text' END AS skip_code FROM documents")
def pred06_min_text(spark, d):
    return table(spark, d, "documents").select("doc_id", F.when(F.coalesce(F.length("text"), F.lit(0)) < 10000, "insufficient_text").alias("skip_code"))


@query("pred08_eligible", f"SELECT source_key, coalesce(convert_status = 'pending' AND {_NOTSKIPPED}, false) AS can_convert, coalesce(preprocess_status = 'pending' AND convert_status = 'done' AND {_NOTSKIPPED}, false) AS can_preprocess, coalesce(extract_status IN ('pending', 'partial') AND preprocess_status = 'done' AND {_NOTSKIPPED}, false) AS can_extract FROM {duck.STATE}")
def pred08_eligible(spark, d):
    return _state(spark, d).select("source_key", *[F.coalesce(S.eligible(s), F.lit(False)).alias(f"can_{s}") for s in S.STAGES])


@query("s18_discard_skipped", f"SELECT d.source_key, length(d.text) AS chars FROM documents d WHERE d.source_key NOT IN (SELECT source_key FROM {duck.STATE} WHERE skip_code IS NOT NULL)")
def s18_discard_skipped(spark, d):
    from paperloom.sources import snapshots

    return snapshots.discard(table(spark, d, "documents").select("source_key", F.length("text").alias("chars")), _state(spark, d).where("skip_code IS NOT NULL"))


@query("i01_fingerprint", "SELECT doc_id, substr(sha256(text), 1, 24) AS fp FROM documents")
def i01_fingerprint(spark, d):
    return table(spark, d, "documents").select("doc_id", identity.fingerprint("text").alias("fp"))


@query("i02_doc_id", "SELECT source_key, CASE WHEN regexp_full_match(trim(source_pdf_sha256_96), '[0-9a-f]{24}') THEN 'doc_' || trim(source_pdf_sha256_96) END AS made, doc_id AS stored FROM papers")
def i02_doc_id(spark, d):
    return table(spark, d, "papers").select("source_key", identity.doc_id_or_null("source_pdf_sha256_96").alias("made"), F.col("doc_id").alias("stored"))


@query("i04_identity_guard", "SELECT m.doc_id, m.doc_id = 'doc_' || m.source_pdf_sha256_96 AS pdf_ok, m.converted_text_sha256_96 = substr(sha256(d.text), 1, 24) AS text_ok FROM metadata m LEFT JOIN documents d ON m.source_file = d.source_key")
def i04_identity_guard(spark, d):
    docs = table(spark, d, "documents").select("source_key", identity.fingerprint("text").alias("fp"))
    m = table(spark, d, "metadata").select("doc_id", "source_pdf_sha256_96", "converted_text_sha256_96", F.col("source_file").alias("source_key"))
    return m.join(docs, "source_key", "left").select("doc_id", (F.col("doc_id") == F.concat(F.lit("doc_"), "source_pdf_sha256_96")).alias("pdf_ok"), (F.col("converted_text_sha256_96") == F.col("fp")).alias("text_ok"))


@query("pred02_source_key", "SELECT DISTINCT raw, regexp_replace(replace(raw, chr(92), '/'), '^(\\./)+', '') || '.pdf' AS key FROM (SELECT './' || replace(regexp_replace(source_key, '\\.pdf$', ''), '/', chr(92)) AS raw FROM papers)")
def pred02_source_key(spark, d):
    raw = F.concat(F.lit("./"), F.translate(F.regexp_replace("source_key", r"\.pdf$", ""), "/", "\\"))
    return table(spark, d, "papers").select(raw.alias("raw")).distinct().select("raw", identity.source_key("raw").alias("key"))


@query("pred03_artifact_path", "SELECT DISTINCT source_key, regexp_replace(source_key, '\\.pdf$', '.md') AS path FROM papers")
def pred03_artifact_path(spark, d):
    return table(spark, d, "papers").select("source_key", identity.artifact_path("source_key", ".md").alias("path")).distinct()


@query("s02_archive_paths", "SELECT DISTINCT archive, regexp_replace(archive, '\\.zip$', '') || '.zip' AS path FROM archive_manifest")
def s02_archive_paths(spark, d):
    return table(spark, d, "archive_manifest").select("archive", identity.archive_path(F.regexp_replace("archive", r"\.zip$", "")).alias("path")).distinct()


@query("s06_batch_tally", "SELECT m.archive, m.pdf_count AS announced, coalesce(p.n, 0) AS present FROM (SELECT archive, pdf_count FROM (SELECT *, row_number() OVER (PARTITION BY archive ORDER BY prepared_at DESC NULLS LAST, archive_sha256_96 DESC NULLS LAST, pdf_count DESC NULLS LAST) AS rn FROM archive_manifest) WHERE rn = 1) m LEFT JOIN (SELECT string_split(source_key, '/')[1] || '.zip' AS archive, count(*) AS n FROM documents GROUP BY 1) p USING (archive)")
def s06_batch_tally(spark, d):
    return archives.tally(table(spark, d, "archive_manifest"), table(spark, d, "documents")).select("archive", "announced", "present")


@query("l01_path_order", "SELECT DISTINCT source_key, replace(source_key, '/', chr(1)) AS sort_key FROM papers")
def l01_path_order(spark, d):
    """A key whose order as a string is that of the path's components."""
    return table(spark, d, "papers").select("source_key", F.array_join(F.split("source_key", "/"), "\x01").alias("sort_key")).distinct()


@query("st01_event_windows", "SELECT time_bucket(INTERVAL '10 minutes', ts) AS \"start\", event_type, count(*) AS n FROM events GROUP BY 1, 2")
def st01_event_windows(spark, d):
    from paperloom.streaming.arrivals import arrivals

    return arrivals(table(spark, d, "events"), at="ts", kind="event_type").select("start", "event_type", "n")


@query("pred10_confidence", "SELECT event_id, CASE WHEN k IS NULL THEN 1.0 ELSE greatest(0.0, least(1.0, k)) END AS confidence FROM (SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events)")
def pred10_confidence(spark, d):
    return table(spark, d, "events").select("event_id", X.confidence(F.get_json_object("props", "$.k")).alias("confidence"))


@query("s03_zip_members", "SELECT source_key AS archive, 'in/paper.pdf' AS member, substr(sha256(text), 1, 24) AS sha256_96 FROM documents WHERE text IS NOT NULL")
def s03_zip_members(spark, d):
    """Each paper in an archive of its own beside members to be left out; unpacked again."""

    def pack(batches):
        import io
        import zipfile

        import pyarrow as pa

        for b in batches:
            out = []
            for text in b.column(1).to_pylist():
                buf = io.BytesIO()
                with zipfile.ZipFile(buf, "w") as z:
                    z.writestr("in/paper.pdf", text)
                    z.writestr("__MACOSX/paper.pdf", "x")
                    z.writestr("note.txt", "x")
                out.append(buf.getvalue())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], ["archive", "content"])

    docs = table(spark, d, "documents").where("text IS NOT NULL").select("source_key", "text")
    return archives.members(docs.mapInArrow(pack, "archive string, content binary"), with_bytes=False).select("archive", "member", "sha256_96")


@query("a11_stage_totals", " UNION ALL ".join(f"SELECT '{x}' AS stage, count(*) FILTER ({x}_status = 'done') AS done, sum(coalesce({x}_prompt_tokens, 0))::BIGINT AS tokens_in, sum(coalesce({x}_completion_tokens, 0))::BIGINT AS tokens_out, CASE WHEN count(*) FILTER ({x}_status = 'done') > 0 THEN (sum(coalesce({x}_prompt_tokens, 0) + coalesce({x}_completion_tokens, 0)) // count(*) FILTER ({x}_status = 'done'))::BIGINT END AS tokens_a_paper FROM {duck.STATE}" for x in ("preprocess", "extract")))
def a11_stage_totals(spark, d):
    return S.stage_totals(_state(spark, d))


@query("g15_set_failed_groups", _set("doc_id IS NOT NULL", extract_failed_groups="CASE WHEN retry_count > 0 THEN 'GA_study_design,GB_results_claims' END", extract_status="CASE WHEN retry_count > 0 THEN 'partial' ELSE extract_status END", updated_at=f"'{NOW}'"))
def g15_set_failed_groups(spark, d):
    """Two failed groups for papers that failed before, none for the others."""
    groups = F.when(F.col("retry_count") > 0, F.array(F.lit("GB_results_claims"), F.lit("GA_study_design"), F.lit(""), F.lit("GB_results_claims")))
    return S.set_failed_groups(_state(spark, d), F.col("doc_id").isNotNull(), groups, NOW).select(*SHOW)


@query("k11_extraction_info", f"SELECT source_key, coalesce(extract_model, '') || '|' || coalesce(extract_at, '') || '|anchor_grouped||' || coalesce(nullif(array_to_string(string_split(extract_failed_groups, ','), '+'), ''), 'none') AS info FROM {duck.STATE} WHERE extract_at IS NOT NULL")
def k11_extraction_info(spark, d):
    from paperloom.operators.entries import extraction_info

    i = extraction_info(F.col("extract_model"), F.col("extract_at"), F.lit(None).cast("string"), F.col("extract_failed_groups"))
    out = _state(spark, d).where("extract_at IS NOT NULL").select("source_key", i.alias("i"))
    part = lambda c: F.coalesce(F.col(c), F.lit(""))
    told = F.concat_ws("|", part("i.extraction_model"), part("i.extraction_timestamp"), "i.extraction_method", F.coalesce(F.array_join("i.retry_groups", "+"), F.lit("")), F.coalesce(F.array_join("i.failed_groups", "+"), F.lit("none")))
    return out.select("source_key", told.alias("info"))


@query("a13_raw_replies", "SELECT source_key, count(*) AS raw_replies FROM (SELECT DISTINCT source_key, elapsed, char_count FROM convert_result) GROUP BY 1")
def a13_raw_replies(spark, d):
    """The recorded results of each paper, counted as its recorded replies are."""
    from paperloom.plans.pipeline import raw_counts

    return raw_counts(table(spark, d, "convert_result").select("source_key", "elapsed", "char_count").distinct())
