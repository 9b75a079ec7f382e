"""Queries of the training-data operators, over whole tables and with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.llm import canonical, encoding, langid, markup, packing, residue, scan_noise, subjects, truncation
from paperloom.tables import materialise, spread, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of every document by byte_bpe_50k."""
    return encoding.encode_texts(_texts(spark, sf_dir), "doc_id", "text")


@query
def p8_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, sized in tokens of byte_bpe_50k, in a container of each capacity."""
    sizes = encoding.count_tokens(_texts(spark, sf_dir), "doc_id", "text")
    return packing.pack(sizes, table(spark, sf_dir, "container_spec"))


@query
def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that are residue in place of a paper."""
    return residue.classify(_texts(spark, sf_dir)).where("residue").select("doc_id")


@query
def p9_clean_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus without residue, with a flag for open slots inside ordinary documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    verdicts = residue.classify(_texts(spark, sf_dir))
    return docs.join(verdicts, "doc_id", "left").where(~F.coalesce("residue", F.lit(False))).select("doc_id", "source", "n_chars", F.coalesce("open_slots", F.lit(False)).alias("open_slots"))


def _entered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(record_id, field_name, pos, value) of the freely typed fields that are not verbatim an entry of their list."""
    meta, entry, refs = (table(spark, sf_dir, t) for t in ("metadata", "entry", "ref_list"))
    return spark.sql(
        """
        WITH v AS (
          SELECT doc_id AS record_id, pos, d FROM (
            SELECT doc_id, array(primary_discipline) AS a, 0 AS base FROM {m}
            UNION ALL SELECT doc_id, secondary_disciplines, 1 FROM {m}) LATERAL VIEW posexplode(a) t AS at, d LATERAL VIEW explode(array(at + base)) u AS pos
          WHERE d IS NOT NULL),
        all_values AS (
          SELECT record_id, 'level2' AS field_name, pos, d.level2 AS value FROM v
          UNION ALL SELECT record_id, 'level3', pos, d.level3 FROM v
          UNION ALL SELECT entry_id, 'std_label', 0, payload['std_label'] FROM {e} WHERE type = 'concept'
          UNION ALL SELECT entry_id, 'method_type', 0, payload['method_type'] FROM {e} WHERE type = 'method')
        SELECT DISTINCT a.record_id, a.field_name, a.pos, a.value FROM all_values a
        LEFT ANTI JOIN {r} r ON a.field_name = r.field_name AND a.value = r.canon
        WHERE a.value IS NOT NULL AND a.value <> ''""",
        m=meta.select("doc_id", "primary_discipline", "secondary_disciplines"),
        e=entry.select("entry_id", "type", "payload"),
        r=refs.select("field_name", "canon"),
    )


@query
def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list entry of every freely typed value, or NONE."""
    entered = materialise(_entered(spark, sf_dir), "entered")
    mapped = canonical.map_values(entered, table(spark, sf_dir, "ref_list"), head_fields=("method_type",))
    return spark.sql(
        "SELECT DISTINCT v.record_id, v.field_name, CAST(v.pos AS INT) AS pos, m.ref_id FROM {v} v JOIN {m} m ON v.field_name = m.field_name AND v.value = m.value",
        v=entered,
        m=materialise(mapped, "mapped"),
    )


def _cut_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts of problem 6: introductions, evidence and the documents behind papers.char_count."""
    meta = table(spark, sf_dir, "metadata").select(F.col("doc_id").alias("record_id"), F.lit("introduction").alias("field_name"), F.col("introduction").alias("text"))
    entry = table(spark, sf_dir, "entry").select(F.col("entry_id").alias("record_id"), F.lit("original_text").alias("field_name"), F.col("evidence.original_text").alias("text"))
    docs = table(spark, sf_dir, "documents").select(F.col("source_key").alias("record_id"), F.lit("char_count").alias("field_name"), "text")
    return spread(meta.unionByName(entry).unionByName(docs))


@query
def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The values that break off before their last sentence is complete."""
    cut = materialise(truncation.find_cut(_cut_fields(spark, sf_dir)), "p6")
    papers = table(spark, sf_dir, "papers").select(F.col("source_key").alias("record_id"))
    return cut.where("field_name <> 'char_count'").unionByName(cut.where("field_name = 'char_count'").join(papers, "record_id", "left_semi"))


def _p1_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Abstracts, keywords and evidence as arrays of strings; version orders the deliveries of a paper."""
    meta, entry = table(spark, sf_dir, "metadata"), table(spark, sf_dir, "entry")
    when = F.col("extraction_info.extraction_timestamp").alias("version")
    abstracts = meta.where(F.length("abstract") > 0).select(F.col("doc_id").alias("record_id"), F.lit("abstract").alias("field_name"), when, F.array("abstract").alias("parts"))
    keywords = meta.where(F.size("keywords") > 0).select(F.col("doc_id").alias("record_id"), F.lit("keywords").alias("field_name"), when, F.col("keywords").alias("parts"))
    evidence = entry.where(F.length("evidence.original_text") > 0).select(F.col("entry_id").alias("record_id"), F.lit("original_text").alias("field_name"), F.lit(None).cast("string").alias("version"), F.array("evidence.original_text").alias("parts"))
    return spread(abstracts.unionByName(keywords).unionByName(evidence))


def _p1_segments(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The segments of every text (one row a text) and the current labels."""
    labels = langid.current_labels(table(spark, sf_dir, "lang_label").select("record_id", "field_name", "lang_given", "labelled_at"))
    texts = _p1_texts(spark, sf_dir)
    sample = langid.sample_texts(texts.where("field_name <> 'original_text'"), labels.where("field_name <> 'original_text'"))
    found = langid.detect(texts, langid.train(sample))
    return found.groupBy("record_id", "field_name").agg(F.max_by("segs", F.struct(F.col("version"), F.to_json("segs"))).alias("segs")), labels


@query
def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The segments of every text whose label is missing or wrong or which holds several languages."""
    segs, labels = _p1_segments(spark, sf_dir)
    case = (F.size("segs") > 1) | (F.size("segs") == 1) & (F.col("label").isNull() | (F.col("label") != F.col("segs")[0]["lang"]))
    return (
        segs.join(labels, ["record_id", "field_name"], "left")
        .where(case)
        .select("record_id", "field_name", F.posexplode("segs").alias("seg_no", "s"))
        .select("record_id", "field_name", (F.col("seg_no") + 1).cast("int").alias("seg_no"), "s.lang")
    )


@query
def p1_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language and the confidence of every segment of every text."""
    segs, _ = _p1_segments(spark, sf_dir)
    return segs.select("record_id", "field_name", F.posexplode("segs").alias("seg_no", "s")).select("record_id", "field_name", (F.col("seg_no") + 1).cast("int").alias("seg_no"), "s.lang", "s.confidence")


def _p3_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles, abstracts and evidence, one row a text."""
    meta, entry = table(spark, sf_dir, "metadata"), table(spark, sf_dir, "entry")
    fields = F.explode(F.array(*(F.struct(F.lit(f).alias("field_name"), F.col(f).alias("text")) for f in ("title", "abstract")))).alias("x")
    own = meta.select(F.col("doc_id").alias("record_id"), fields).select("record_id", "x.field_name", "x.text")
    return own.unionByName(entry.select(F.col("entry_id").alias("record_id"), F.lit("original_text").alias("field_name"), F.col("evidence.original_text").alias("text"))).where(F.length("text") > 0).transform(spread)


@query
def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The markup languages of every text that holds some."""
    return markup.clean(_p3_texts(spark, sf_dir), with_text=False).select("record_id", "field_name", F.explode("markup").alias("markup")).distinct()


@query
def p3_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every title, abstract and piece of evidence as clean text."""
    return markup.clean(_p3_texts(spark, sf_dir)).select("record_id", "field_name", "clean").distinct()


def _p4_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Abstracts, introductions and evidence, one row a text."""
    meta, entry = table(spark, sf_dir, "metadata"), table(spark, sf_dir, "entry")
    fields = F.explode(F.array(*(F.struct(F.lit(f).alias("field_name"), F.col(f).alias("text")) for f in ("abstract", "introduction")))).alias("x")
    own = meta.select(F.col("doc_id").alias("record_id"), fields).select("record_id", "x.field_name", "x.text")
    return spread(own.unionByName(entry.select(F.col("entry_id").alias("record_id"), F.lit("original_text").alias("field_name"), F.col("evidence.original_text").alias("text"))))


@query
def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The kinds of scanning noise of every text."""
    return scan_noise.find_noise(_p4_texts(spark, sf_dir))


def _p5_assigned(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The areas of every paper by its abstract, and the areas that it states."""
    meta, refs = table(spark, sf_dir, "metadata"), table(spark, sf_dir, "ref_list")
    said = F.array_compact(F.concat(F.array("primary_discipline.level1"), F.coalesce(F.transform("secondary_disciplines", lambda d: d["level1"]), F.array().cast("array<string>"))))
    papers = meta.select("doc_id", "keywords", "abstract", F.array_distinct(said).alias("said"), F.col("extraction_info.extraction_timestamp").alias("at"))
    papers = papers.groupBy("doc_id").agg(F.max_by(F.struct("keywords", "abstract", "said"), F.coalesce("at", F.lit(""))).alias("p")).select("doc_id", "p.*")
    papers = materialise(papers, "papers")  # read by the terms, the texts, the thresholds and the result
    areas = [r[0] for r in refs.where("field_name = 'level1'").select("canon").distinct().collect()]  # the fixed list of areas
    stated = papers.select("doc_id", "keywords", F.array_intersect("said", F.array(*map(F.lit, areas)).cast("array<string>")).alias("areas"))
    terms = materialise(subjects.weighted_terms(stated, refs), "terms")
    measured = materialise(subjects.measure(spread(papers.select("doc_id", F.col("abstract").alias("text"))), terms), "measured")
    return subjects.assign(measured, subjects.thresholds(measured, stated)), papers.select("doc_id", "said")


@query
def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The areas that an abstract is about and that its paper does not state."""
    found, said = _p5_assigned(spark, sf_dir)
    return found.join(said, "doc_id").where(~F.coalesce(F.array_contains("said", F.col("area")), F.lit(False))).select("doc_id", F.col("area").alias("level1")).distinct()


@query
def p5_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The make-up of the corpus: papers and weight of each subject area."""
    found, _ = _p5_assigned(spark, sf_dir)
    return found.groupBy("area").agg(F.countDistinct("doc_id").alias("papers"), F.round(F.sum("share"), 4).alias("weight"))


@query
def p4_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every abstract, introduction and piece of evidence as continuous paragraphs."""
    return scan_noise.repair(_p4_texts(spark, sf_dir).where(F.length("text") > 0)).distinct()


@query
def p6_source_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each source truncates: cut and all values of each field; of papers also how many have fewer characters than ``papers``
    counts (``n_short``: a count alone is no proof of a cut)."""
    cut = truncation.find_cut(_cut_fields(spark, sf_dir)).withColumn("cut", F.lit(True))
    meta = table(spark, sf_dir, "metadata").where(F.length("introduction") > 0).select(F.col("doc_id").alias("record_id"), F.lit("introduction").alias("field_name"), F.substring_index("source_file", "/", 1).alias("source"))
    entry = table(spark, sf_dir, "entry").where(F.length("evidence.original_text") > 0).select(F.col("entry_id").alias("record_id"), F.lit("original_text").alias("field_name"), "source")
    docs = table(spark, sf_dir, "documents").where(F.length("text") > 0).select(F.col("source_key").alias("record_id"), F.lit("char_count").alias("field_name"), "source")
    every = meta.unionByName(entry).unionByName(docs).distinct()
    counted = table(spark, sf_dir, "papers").groupBy(F.col("source_key").alias("record_id")).agg(F.max("char_count").alias("said"))
    short = table(spark, sf_dir, "documents").select(F.col("source_key").alias("record_id"), F.length("text").alias("has")).join(counted, "record_id").where("said > has")
    short = short.select("record_id", F.lit("char_count").alias("field_name"), F.lit(True).alias("short")).distinct()
    keys = ["record_id", "field_name"]
    rates = every.join(cut, keys, "left").join(short, keys, "left").groupBy("source", "field_name").agg(F.count("*").alias("n"), F.count("cut").alias("cut"), F.count("short").alias("n_short"))
    return rates.withColumn("share", F.round(F.col("cut") / F.col("n"), 4))


@query
def p2_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of values that no entry takes, with their number of records."""
    entered = materialise(_entered(spark, sf_dir), "entered")
    mapped = canonical.map_values(entered, table(spark, sf_dir, "ref_list"), head_fields=("method_type",)).where("ref_id = 'NONE'")
    return entered.join(mapped.select("field_name", "value"), ["field_name", "value"], "left_semi").groupBy("field_name", "value").agg(F.countDistinct("record_id").alias("records"))


_P2_FOUND = "SELECT DISTINCT e.record_id, e.field_name, CAST(e.pos AS INTEGER) AS pos, coalesce(f.ref_id, 'NONE') AS ref_id FROM entered e LEFT JOIN found f ON e.field_name = f.field_name AND e.value = f.value"
_P2_UNMATCHED = "SELECT e.field_name, e.value, count(DISTINCT e.record_id) AS records FROM entered e ANTI JOIN found f ON e.field_name = f.field_name AND e.value = f.value GROUP BY 1, 2"


def _p2_oracle(result: str) -> str:
    """DuckDB SQL of p2_found and p2_unmatched: the same forms, every pair of value and entry compared instead of the pigeonhole join."""
    c = canonical
    esc = lambda s: s.replace("'", "''")
    plain = lambda x: f"trim(regexp_replace(translate(lower({x}), '{c.TRADITIONAL}{c.LOOKALIKE}', '{c.SIMPLIFIED}{c.MEANT}'), '[\\s\\p{{Z}}\\x{{0B}}\\x{{85}}]+', ' ', 'g'))"
    compact = lambda x: f"regexp_replace({x}, '[^\\pL\\pN]', '', 'g')"
    sub = lambda x, p: f"regexp_replace({x}, '{esc(p)}', '')"
    tail = lambda x: f"regexp_replace({x}, '{esc(c.TAIL)}', '', 'g')"
    k = "CASE WHEN regexp_matches(form, '[\\x{3400}-\\x{9fff}]') THEN CASE WHEN n >= 4 THEN 2 WHEN n = 3 THEN 1 ELSE 0 END WHEN n >= 8 THEN 2 WHEN n >= 5 THEN 1 ELSE 0 END"
    toks = lambda x: f"string_split_regex({x}, '[^\\pL\\pN]+')"
    # levenshtein counts bytes here: the signs of a pair are first mapped to one byte each
    signs = lambda a, b: f"array_to_string(list_distinct(string_split({a} || {b}, '')), '')"
    byte = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789!#$%&()*+,-./:;<=>?@^_{|}~"
    one = lambda x, a, b: f"translate({x}, {signs(a, b)}, substr('{byte}', 1, length({signs(a, b)})))"
    lev = lambda a, b: f"levenshtein({one(a, a, b)}, {one(b, a, b)})"
    return f"""
WITH d AS (
  SELECT doc_id AS record_id, 0 AS pos, primary_discipline.level2 AS l2, primary_discipline.level3 AS l3 FROM metadata
  UNION ALL SELECT doc_id, i, secondary_disciplines[i].level2, secondary_disciplines[i].level3 FROM metadata m, unnest(range(1, len(m.secondary_disciplines) + 1)) AS u(i)),
entered AS (
  SELECT DISTINCT * FROM (
    SELECT record_id, 'level2' AS field_name, pos, l2 AS value FROM d UNION ALL SELECT record_id, 'level3', pos, l3 FROM d
    UNION ALL SELECT entry_id, 'std_label', 0, payload['std_label'] FROM entry WHERE type = 'concept'
    UNION ALL SELECT entry_id, 'method_type', 0, payload['method_type'] FROM entry WHERE type = 'method') v
  WHERE value IS NOT NULL AND value <> '' AND NOT EXISTS (SELECT 1 FROM ref_list r WHERE r.field_name = v.field_name AND r.canon = v.value)),
vals AS (SELECT DISTINCT field_name, value FROM entered),
refs AS (SELECT *, {k} AS k, {toks("words")} AS toks FROM (SELECT ref_id, field_name, {compact("p")} AS form, length({compact("p")}) AS n, p AS words FROM (SELECT ref_id, field_name, {plain("x")} AS p FROM (SELECT ref_id, field_name, unnest([canon, canon_alt]) AS x FROM ref_list) WHERE x IS NOT NULL)) WHERE n > 0),
plain AS (SELECT field_name, value, {sub(plain("value"), c.CODE)} AS p FROM vals),
halves AS (SELECT DISTINCT field_name, value, unnest(list_concat(list_concat(list_concat(list_concat([p], string_split_regex(p, '\\s*/\\s*')), string_split(p, ' - ')), string_split_regex(p, '[（(]')), CASE WHEN len(string_split(p, ', ')) = 2 THEN [string_split(p, ', ')[2] || ' ' || string_split(p, ', ')[1]] ELSE []::VARCHAR[] END)) AS h FROM plain),
shorn AS (SELECT field_name, value, unnest([h, {sub("h", c.LEAD)}, {tail("h")}, {tail(sub("regexp_replace(h, '[.。；;]+" + chr(92) + "s*$', '')", c.LEAD))}]) AS h FROM halves),
forms AS (SELECT field_name, value, form, length(form) AS n, min(h) AS words FROM (SELECT field_name, value, h, {compact("h")} AS form FROM shorn) WHERE form <> '' GROUP BY 1, 2, 3),
equal AS (SELECT f.field_name, f.value, min(r.ref_id) AS ref_id FROM forms f JOIN refs r ON f.field_name = r.field_name AND (f.form = r.form OR f.form = r.form || 's') GROUP BY 1, 2),
w AS (SELECT field_name, value, {toks("words")} AS w FROM forms WHERE field_name = 'method_type'),
runs AS (SELECT field_name, value, array_to_string(w[i : j], '') AS run FROM w, range(1, 7) AS a(i), range(1, 7) AS b(j) WHERE len(w) BETWEEN 2 AND 6 AND i <= j AND j <= i + 2 AND j <= len(w)),
headed AS (
  SELECT field_name, value, min(ref_id) AS ref_id FROM (
    SELECT u.field_name, u.value, r.ref_id FROM runs u JOIN refs r ON u.field_name = r.field_name AND (u.run = r.form OR u.run = r.form || 's') WHERE r.n >= 5
    UNION ALL SELECT w.field_name, w.value, r.ref_id FROM w JOIN refs r ON w.field_name = r.field_name AND len(w.w) = len(r.toks) AND len(list_filter(range(1, len(w.w) + 1), lambda i: length(w.w[i]) >= 4 AND starts_with(r.toks[i], w.w[i]))) = len(w.w))
  GROUP BY 1, 2 HAVING count(DISTINCT ref_id) = 1),
done AS (SELECT * FROM equal UNION ALL SELECT * FROM headed h WHERE NOT EXISTS (SELECT 1 FROM equal e WHERE e.field_name = h.field_name AND e.value = h.value)),
near AS (
  SELECT field_name, value, arg_min(ref_id, edits * 1000000 - shared * 1000 + rank) AS ref_id FROM (
    SELECT *, dense_rank() OVER (ORDER BY ref_id) AS rank FROM (
      SELECT f.field_name, f.value, r.ref_id, r.k, f.form, r.form AS rform, {lev("f.form", "r.form")} AS edits, len(list_distinct(list_intersect(string_split(f.form, ''), string_split(r.form, '')))) AS shared FROM forms f JOIN refs r ON f.field_name = r.field_name
      WHERE f.n >= 3 AND r.k > 0 AND abs(f.n - r.n) <= 2 AND NOT EXISTS (SELECT 1 FROM done e WHERE e.field_name = f.field_name AND e.value = f.value)))
  WHERE edits <= k OR (k > 0 AND edits = 2 AND length(form) = length(rform) AND list_sort(string_split(form, '')) = list_sort(string_split(rform, '')))
  GROUP BY 1, 2),
found AS (SELECT * FROM done UNION ALL SELECT * FROM near)
{result}"""


ORACLES["p2_found"] = _p2_oracle(_P2_FOUND)
ORACLES["p2_unmatched"] = _p2_oracle(_P2_UNMATCHED)
