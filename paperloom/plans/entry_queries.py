"""Queries over entries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.functions import text as X
from paperloom.operators import entries as N
from paperloom.plans import duck
from paperloom.plans.registry import query
from paperloom.tables import table


def _entries(spark: SparkSession, d: str) -> DataFrame:
    """Each entry once; its id is its position."""
    e = table(spark, d, "entry")
    return e.groupBy("entry_id").agg(F.max(F.struct("doc_id", "type", F.map_entries("payload").alias("p"), "evidence", "confidence")).alias("e")).select("entry_id", "e.doc_id", "e.type", F.map_from_entries("e.p").alias("payload"), "e.evidence", "e.confidence")


_E = "(SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY entry_id ORDER BY doc_id) AS rn FROM entry) WHERE rn = 1)"
_C = f"(SELECT *, {duck.keys('payload')} AS keys FROM {_E} WHERE type = 'concept')"


@query("a05_type_counts", f"SELECT type, count(*) AS n FROM {_E} GROUP BY 1")
def a05_type_counts(spark, d):
    return N.type_counts(_entries(spark, d))


@query("a06_located", f"SELECT count(evidence.page) AS located, count(*) AS total, round(count(evidence.page) / count(*), 4) AS share FROM {_E}")
def a06_located(spark, d):
    return N.located(_entries(spark, d))


@query("a08_methods", f"SELECT evidence.match_method AS method, count(*) AS n FROM {_E} GROUP BY 1")
def a08_methods(spark, d):
    return _entries(spark, d).groupBy(F.col("evidence.match_method").alias("method")).agg(F.count("*").alias("n"))


@query("t22_terms", f"SELECT entry_id, {duck.term(chr(112) + 'ayload[' + chr(39) + 'term' + chr(39) + ']')} AS term FROM {_E} WHERE type = 'concept'")
def t22_terms(spark, d):
    return _entries(spark, d).where("type = 'concept'").select("entry_id", X.normal_term(F.col("payload")["term"]).alias("term"))


@query("t23_alias_keys", f"SELECT entry_id, array_to_string(keys, '|') AS keys FROM {_C}")
def t23_alias_keys(spark, d):
    return _entries(spark, d).where("type = 'concept'").select("entry_id", F.array_join(N.concept_keys(), "|").alias("keys"))


@query("a10_alias_map", f"SELECT doc_id, alias, min(entry_id) AS concept_id FROM (SELECT doc_id, entry_id, unnest(keys) AS alias FROM {_C}) GROUP BY 1, 2 HAVING count(DISTINCT entry_id) = 1")
def a10_alias_map(spark, d):
    return N.alias_map(_entries(spark, d).where("type = 'concept'"))


@query(
    "k02_greedy_concepts",
    f"""WITH RECURSIVE c AS MATERIALIZED (SELECT doc_id, entry_id, keys, row_number() OVER (PARTITION BY doc_id ORDER BY entry_id) AS rn FROM {_C}),
r(doc_id, entry_id, rn, held, kept) AS (
  SELECT DISTINCT doc_id, '', 0::BIGINT, []::VARCHAR[], false FROM c
  UNION ALL
  SELECT c.doc_id, c.entry_id, c.rn, CASE WHEN list_has_any(r.held, c.keys) THEN r.held ELSE list_concat(r.held, c.keys) END, NOT list_has_any(r.held, c.keys) FROM r JOIN c ON c.doc_id = r.doc_id AND c.rn = r.rn + 1)
SELECT doc_id, entry_id FROM r WHERE kept""",
)
def k02_greedy_concepts(spark, d):
    return N.greedy_concepts(_entries(spark, d).where("type = 'concept'"), order="entry_id").select("doc_id", "entry_id")


_M = f"(SELECT doc_id, alias, min(entry_id) AS id FROM (SELECT doc_id, entry_id, unnest(keys) AS alias FROM {_C}) GROUP BY 1, 2 HAVING count(DISTINCT entry_id) = 1)"
_L = f"(SELECT r.entry_id, h.id AS head_entry_id, t.id AS tail_entry_id FROM (SELECT * FROM {_E} WHERE type = 'relation') r LEFT JOIN {_M} h ON r.doc_id = h.doc_id AND h.alias = {duck.term('r.payload[' + chr(39) + 'head_term' + chr(39) + ']')} LEFT JOIN {_M} t ON r.doc_id = t.doc_id AND t.alias = {duck.term('r.payload[' + chr(39) + 'tail_term' + chr(39) + ']')})"


def _links(spark: SparkSession, d: str) -> DataFrame:
    e = _entries(spark, d)
    return N.link_relations(e.where("type = 'relation'"), N.alias_map(e.where("type = 'concept'")))


@query("j04_relation_links", f"SELECT * FROM {_L}")
def j04_relation_links(spark, d):
    return _links(spark, d).select("entry_id", "head_entry_id", "tail_entry_id")


@query("a07_link_summary", f'SELECT count(*) FILTER (head_entry_id IS NOT NULL AND tail_entry_id IS NOT NULL) AS "full", count(*) FILTER ((head_entry_id IS NULL) <> (tail_entry_id IS NULL)) AS part, count(*) FILTER (head_entry_id IS NULL AND tail_entry_id IS NULL) AS unlinked, count(*) AS total FROM {_L}')
def a07_link_summary(spark, d):
    return N.link_summary(_links(spark, d))


_P = "list_sort(list_transform(map_keys(payload), lambda k: k || chr(2) || coalesce(payload[k], chr(3))))"
_K = f"(SELECT *, md5(type || chr(1) || array_to_string({_P}, chr(1)) || chr(4) || {duck.norm('coalesce(evidence.anchor_text, ' + chr(39) + chr(39) + ')')}) AS key FROM {_E})"


@query("i03_dedup_classes", f"SELECT doc_id, type, count(*) AS entries, count(DISTINCT key) AS distinct_entries FROM {_K} GROUP BY 1, 2")
def i03_dedup_classes(spark, d):
    """The keys are internal; what counts is which entries share one."""
    e = _entries(spark, d).withColumn("key", N.dedup_key("type", "payload", F.col("evidence.anchor_text")))
    return e.groupBy("doc_id", "type").agg(F.count("*").alias("entries"), F.countDistinct("key").alias("distinct_entries"))


@query("w03_deduplicated", f"SELECT min(entry_id) AS entry_id FROM {_K} GROUP BY doc_id, key")
def w03_deduplicated(spark, d):
    e = _entries(spark, d).withColumn("key", N.dedup_key("type", "payload", F.col("evidence.anchor_text")))
    return N.deduplicate(e, order="entry_id").select("entry_id")


_DS = f"(SELECT *, count(*) OVER g AS n, row_number() OVER (g ORDER BY entry_id) AS k FROM (SELECT * FROM {_E} WHERE type = 'dataset' AND evidence.page IS NOT NULL AND coalesce(evidence.original_text, '') <> '') WINDOW g AS (PARTITION BY doc_id, evidence.original_text))"


@query("a09_collapsed_datasets", f"SELECT entry_id FROM {_E} WHERE entry_id NOT IN (SELECT entry_id FROM {_DS} WHERE n > 5 AND k > 1)")
def a09_collapsed_datasets(spark, d):
    return N.collapse_datasets(_entries(spark, d), order="entry_id")[0].select("entry_id")


@query("w04_public_ids", f"SELECT entry_id, doc_id || '_' || type || '_' || CASE WHEN n < 10000 THEN lpad(n::VARCHAR, 4, '0') ELSE n::VARCHAR END AS public_id FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, type ORDER BY entry_id) AS n FROM {_E})")
def w04_public_ids(spark, d):
    return N.public_ids(_entries(spark, d), order="entry_id").select("entry_id", "public_id")


@query("j07_relinked", f"WITH ids AS (SELECT entry_id, doc_id || '_' || type || '_' || lpad(n::VARCHAR, 4, '0') AS public_id FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, type ORDER BY entry_id) AS n FROM {_E})) SELECT l.entry_id, h.public_id AS head_entry_id, t.public_id AS tail_entry_id FROM {_L} l LEFT JOIN ids h ON l.head_entry_id = h.entry_id LEFT JOIN ids t ON l.tail_entry_id = t.entry_id")
def j07_relinked(spark, d):
    return N.relink(_links(spark, d), N.public_ids(_entries(spark, d), order="entry_id")).select("entry_id", "head_entry_id", "tail_entry_id")


@query("j10_retry_merge", f"SELECT entry_id FROM {_E} WHERE type <> 'claim' OR doc_id NOT IN (SELECT doc_id FROM {_E} WHERE type = 'claim') UNION ALL SELECT entry_id || '_again' FROM {_E} WHERE type = 'claim'")
def j10_retry_merge(spark, d):
    e = _entries(spark, d).select("doc_id", "type", "entry_id")
    return N.merge_retry(e, e.where("type = 'claim'").withColumn("entry_id", F.concat("entry_id", F.lit("_again")))).select("entry_id")


def _items(spark: SparkSession, d: str) -> DataFrame:
    """The entries as raw items of replies."""
    item = F.to_json(F.struct("type", "payload", F.struct("evidence.section", "evidence.anchor_text").alias("evidence"), "confidence"))
    return _entries(spark, d).select("doc_id", "entry_id", "type", item.alias("item"))


@query("n07_anchor_fallback", f"SELECT entry_id, coalesce(evidence.anchor_text, '') AS anchor_text FROM {_E}")
def n07_anchor_fallback(spark, d):
    return _items(spark, d).select("entry_id", N.anchor_of(F.col("item")).alias("anchor_text"))


_REQ = {"concept": ["term"], "dataset": ["name"], "method": ["name"], "relation": ["head_term", "tail_term"]}


@query("k04_valid_items", f"SELECT entry_id, CASE type " + " ".join(f"WHEN '{t}' THEN " + " AND ".join(f"coalesce({duck.strip(f'payload[{chr(39)}{n}{chr(39)}]')}, '') <> ''" for n in ns) for t, ns in _REQ.items() if t != "method") + " WHEN 'method' THEN payload['name'] IS NOT NULL ELSE true END AND len(list_filter(map_keys(payload), lambda k: payload[k] IS NULL AND k <> 'value')) = 0 AS valid FROM " + _E)
def k04_valid_items(spark, d):
    return N.parse_items(_items(spark, d)).select("entry_id", "valid")


@query("pred09_type_counts_valid", f"SELECT type, count(*) AS n FROM {_E} WHERE confidence >= 0.5 GROUP BY 1")
def pred09_type_counts_valid(spark, d):
    return N.parse_items(_items(spark, d)).where("confidence >= 0.5").groupBy("type").agg(F.count("*").alias("n"))


def _replies(spark: SparkSession, d: str) -> DataFrame:
    """Each entry as a reply of its own."""
    return _items(spark, d).select("doc_id", "entry_id", F.concat(F.lit('{"entries": ['), "item", F.lit("]}")).alias("reply"))


@query("n05_unified_replies", f"SELECT entry_id, type, 0 AS pos FROM {_E}")
def n05_unified_replies(spark, d):
    return N.unify_reply(_replies(spark, d)).select("entry_id", "type", "pos")


@query("n06_payloads", f"SELECT entry_id, coalesce(payload['head_term'], payload['name'], payload['term'], payload['metric'], '') AS main FROM {_E} WHERE type IN ('relation', 'dataset', 'concept', 'performance_result')")
def n06_payloads(spark, d):
    p = N.parse_items(N.unify_reply(_replies(spark, d))).where(F.col("type").isin("relation", "dataset", "concept", "performance_result"))
    return p.select("entry_id", F.coalesce(F.col("payload")["head_term"], F.col("payload")["name"], F.col("payload")["term"], F.col("payload")["metric"]).alias("main"))


@query("n08_legacy_links", f"SELECT entry_id, CASE WHEN ord(right(entry_id, 1)) % 3 < 2 THEN head_entry_id END AS head, CASE WHEN ord(right(entry_id, 1)) % 3 > 0 THEN tail_entry_id END AS tail FROM {_L}")
def n08_legacy_links(spark, d):
    """Relations as documents of the present form, of the older one, and of both."""
    k = F.pmod(F.ascii(F.right("entry_id", F.lit(1))), F.lit(3))
    payload = F.struct(F.when(k == 0, F.col("head_entry_id")).alias("head_entry_id"), F.when(k > 0, F.col("tail_entry_id")).otherwise("").alias("tail_entry_id"))
    json = F.to_json(F.struct(payload.alias("payload"), F.when(k == 1, F.col("head_entry_id")).alias("head"), F.when(k == 2, F.lit("other")).alias("tail")))
    head, tail = N.legacy_links(json)
    return _links(spark, d).select("entry_id", head.alias("head"), F.when(F.col("tail_entry_id").isNotNull() | (k < 2), tail).alias("tail"))


@query("n05_reply_shapes", f"SELECT entry_id, pos, CASE k WHEN 0 THEN type WHEN 1 THEN 'concept' WHEN 2 THEN 'method' ELSE 'novelties' END AS type FROM (SELECT entry_id, type, ord(right(entry_id, 1)) % 5 AS k FROM {_E}) e, (VALUES (0), (1)) AS p(pos) WHERE k < 4 AND (pos = 0 OR k = 2)")
def n05_reply_shapes(spark, d):
    """The entries in replies of five shapes: an array with what is no item, plural lists beside other values and twice, a list of an unknown
    name, and none."""
    x, k = F.col("item"), F.pmod(F.ascii(F.right("entry_id", F.lit(1))), F.lit(5))
    c = lambda *p: F.concat(*[F.lit(s) if s != "x" else x for s in p])
    reply = F.when(k == 0, c('{"entries":[', "x", ',"no item",null]}')).when(k == 1, c('{"concepts":[', "x", '],"other":3}')).when(k == 2, c('{"entries":[],"methods":[', "x", ",", "x", "]}")).when(k == 3, c('{"novelties":[', "x", "]}")).otherwise("[]")
    return N.unify_reply(_items(spark, d).select("doc_id", "entry_id", reply.alias("reply"))).select("entry_id", "pos", "type")


@query("n06_flat_payloads", f"SELECT entry_id, k AS shape, CASE k WHEN 1 THEN 'quoted' WHEN 2 THEN 'own' WHEN 3 THEN 'whole' ELSE '' END AS anchor_text, CASE WHEN type = 'concept' AND k < 3 THEN coalesce(payload['term'], '') WHEN type = 'dataset' AND k < 3 THEN coalesce(payload['name'], '') END AS main, CAST(CASE k WHEN 0 THEN 1.0 WHEN 1 THEN 0.0 WHEN 2 THEN 0.5 WHEN 3 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS confidence FROM (SELECT *, ord(right(entry_id, 1)) % 5 AS k FROM {_E} WHERE type IN ('concept', 'dataset', 'claim')) WHERE k < 3 OR type = 'claim'")
def n06_flat_payloads(spark, d):
    """Items whose fields stand beside the type, with each fallback of the anchor and each form of a confidence."""
    p, k = F.col("payload"), F.pmod(F.ascii(F.right("entry_id", F.lit(1))), F.lit(5))
    some = lambda i, v: F.when(k == i, v)
    item = F.to_json(
        F.struct(
            "type", p["term"].alias("term"), p["name"].alias("name"), some(1, F.struct(F.lit("quoted").alias("anchor_text"), F.lit("x").alias("original_text"))).alias("evidence"), some(2, F.lit("own")).alias("anchor_text"), some(3, F.lit("whole")).alias("original_text"),
            F.when(k == 1, "low").when(k == 2, "0.5").when(k == 3, "7").when(k == 4, "-2").alias("confidence"),
        )
    )
    rows = _entries(spark, d).where(F.col("type").isin("concept", "dataset", "claim")).where((k < 3) | (F.col("type") == "claim")).select("doc_id", "entry_id", F.col("type"), k.alias("shape"), item.alias("item"))
    main = F.when((F.col("type") == "concept") & (F.col("shape") < 3), F.col("payload")["term"]).when((F.col("type") == "dataset") & (F.col("shape") < 3), F.col("payload")["name"])
    return N.parse_items(rows).select("entry_id", "shape", "anchor_text", main.alias("main"), "confidence")


@query("k01_assembled_entries")
def k01_assembled_entries(spark, d):
    """The entries as raw items, assembled anew against the texts of their papers."""
    keys = table(spark, d, "metadata").select("doc_id", F.col("source_file").alias("source_key")).distinct()
    items = _items(spark, d).join(keys, "doc_id").select("doc_id", "source_key", F.col("entry_id").alias("pos"), "type", "item")
    out = N.assemble(items, table(spark, d, "documents").select("source_key", "text"))["entries"]
    return out.select("public_id", "doc_id", "type", F.to_json("payload").alias("payload"), "evidence.page", "evidence.match_method", "evidence.original_text", "confidence", "head_entry_id", "tail_entry_id")
