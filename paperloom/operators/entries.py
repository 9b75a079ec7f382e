"""Assembly of entries: reading raw items, validation, concepts, links, deduplication, collapse, ids (N-5 to N-7, K-*, A-5 to A-10)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from paperloom.functions import text as X

#: Types of entries with the prefix of their keys, their payload fields, and the plural under which a reply may list them.
TYPES = {
    "concept": ("c", ("term", "normalized", "std_label"), "concepts"),
    "relation": ("r", ("head_term", "relation_type", "relation_surface", "tail_term"), "relations"),
    "dataset": ("d", ("name", "modality", "domain"), "datasets"),
    "method": ("m", ("name", "method_type"), "methods"),
    "experiment": ("x", ("task", "setup"), "experiments"),
    "performance_result": ("p", ("metric", "compared_to"), "performances"),
    "quantitative_result": ("qr", ("quantity", "value", "unit", "context", "result_type"), "quantitative_results"),
    "data_specification": ("ds", ("spec_type", "description"), "data_specifications"),
    "conclusion": ("cl", (), "conclusions"),
    "claim": ("ca", (), "claims"),
    "future_work": ("fw", (), "future_works"),
    "limitation": ("lm", (), "limitations"),
}
REQUIRED = {"concept": "term", "dataset": "name", "method": "name"}
#: Concepts of a paper that share keys and are folded as one list; more are settled in rounds first.
FOLD = 10_000
#: Fixed value: datasets that may share one located evidence.
SHARED = 5


def unify_reply(replies: DataFrame, reply: str = "reply") -> DataFrame:
    """N-5: (…, pos, item): a row an item of a recovered reply: the elements of ``entries`` where it has any, else those of its plural
    lists with the type that the name stands for (an unknown name is its own type)."""
    v = replies.withColumn("__v", F.try_parse_json(F.col(reply)))
    entries = F.from_json(F.get_json_object(F.col(reply), "$.entries"), "array<variant>")
    lists = F.map_entries(F.from_json(F.col(reply), "map<string,string>"))
    kind = F.create_map(*[F.lit(x) for t, (_, _, many) in TYPES.items() for x in (many, t)])
    others = F.flatten(
        F.transform(
            F.filter(lists, lambda e: (e["key"] != "entries") & e["value"].startswith("[")),
            lambda e: F.transform(F.from_json(e["value"], "array<string>"), lambda s: F.struct(s.alias("item"), F.coalesce(kind[e["key"]], e["key"]).alias("type"))),
        )
    )
    own = F.transform(entries, lambda x: F.struct(F.to_json(x).alias("item"), F.lit(None).cast("string").alias("type")))
    keep = [c for c in replies.columns if c != reply]
    items = v.select(*keep, F.posexplode(F.when(F.size(entries) > 0, own).otherwise(others)).alias("pos", "i"))
    items = items.select(*keep, "pos", "i.item", F.coalesce("i.type", F.get_json_object("i.item", "$.type")).alias("type"))
    return items.where(F.col("item").startswith("{"))


def anchor_of(item: Column) -> Column:
    """N-7: the anchor of an item: the first of its evidence's and its own anchor and original text that is not empty."""
    g = lambda p: F.nullif(F.get_json_object(item, p), F.lit(""))
    return F.coalesce(g("$.evidence.anchor_text"), g("$.anchor_text"), g("$.evidence.original_text"), g("$.original_text"), F.lit(""))


def parse_items(items: DataFrame) -> DataFrame:
    """N-6, N-7, P-9, P-10, K-4: items (doc_id, pos, type, item) with ``payload`` (map of strings), ``anchor_text``, ``section``, ``confidence`` and
    ``valid``.

    A payload is the object ``payload``, else the known fields of the item itself. Its fields must be JSON strings (``value`` may be a
    number or null) and the required one must be there; a concept needs a term, a relation both ends, a dataset a name.
    """
    item = F.col("item")
    d = items.withColumn("__v", F.try_parse_json(item))
    # the payload's fields as variants: the object ``payload``, else the item itself
    own = F.coalesce(F.when(F.schema_of_variant(F.try_variant_get("__v", "$.payload", "variant")).startswith("OBJECT"), F.try_variant_get("__v", "$.payload", "map<string,variant>")), F.try_variant_get("__v", "$", "map<string,variant>"))
    d = d.withColumn("__m", own).withColumn("__fields", _by_type({t: list(names) for t, (_, names, _) in TYPES.items()}, "array<string>"))
    kind = F.transform_values("__m", lambda _, x: F.schema_of_variant(x))
    d = d.withColumn("__kind", kind).withColumn("__text", F.transform_values("__m", lambda _, x: F.try_variant_get(x, "$", "string")))
    text, kinds = F.col("__text"), F.col("__kind")
    blank = lambda x: F.nullif(X.strip(F.coalesce(x, F.lit(""))), F.lit(""))

    def end(n: str) -> Column:
        return F.coalesce(blank(text[f"{n}_term"]), blank(text[n]), blank(F.get_json_object(item, f"$.{n}")), F.lit(""))

    d = d.withColumn("__head", F.when(F.col("type") == "relation", end("head"))).withColumn("__tail", F.when(F.col("type") == "relation", end("tail")))
    value = lambda n: F.when(n == "head_term", F.col("__head")).when(n == "tail_term", F.col("__tail")).otherwise(F.coalesce(text[n], F.when(n != "value", "")))
    fine = lambda n: (
        F.when(n.isin("head_term", "tail_term"), value(n) != "").when(n == "value", kinds[n].isNull() | ~kinds[n].rlike("^(?:OBJECT|ARRAY)")).otherwise(kinds[n].isNull() | (kinds[n] == "STRING"))
    )
    required = _by_type(REQUIRED, "string")
    has = required.isNull() | (F.coalesce(kinds[required], F.lit("")) == "STRING") & ((F.col("type") == "method") | (F.coalesce(F.when(F.col("type") == "concept", X.strip(text[required])).otherwise(text[required]), F.lit("")) != ""))
    none = F.coalesce(F.schema_of_variant(F.try_variant_get("__v", "$.confidence", "variant")) == "VOID", F.lit(False))
    return d.select(
        *items.columns, F.map_from_entries(F.transform("__fields", lambda n: F.struct(n.alias("k"), value(n).alias("v")))).alias("payload"), anchor_of(item).alias("anchor_text"), F.coalesce(F.get_json_object(item, "$.evidence.section"), F.lit("")).alias("section"),
        F.when(none, 0.0).otherwise(X.confidence(F.get_json_object(item, "$.confidence"))).alias("confidence"), F.coalesce(F.forall("__fields", fine) & has, F.lit(False)).alias("valid"),
    )


def _by_type(values: dict, kind: str) -> Column:
    """Column: what ``values`` has for the row's type, null for an unknown type."""
    out = F.lit(None).cast(kind)
    for t, v in values.items():
        out = F.when(F.col("type") == t, F.array(*map(F.lit, v)).cast(kind) if isinstance(v, list) else F.lit(v)).otherwise(out)
    return out


def concept_keys(payload: Column | str = "payload") -> Column:
    """T-23 on a payload."""
    p = F.col(payload) if isinstance(payload, str) else payload
    return X.alias_keys(p["term"], p["normalized"], p["std_label"])


def greedy_concepts(concepts: DataFrame, by: str = "doc_id", order: str = "pos") -> DataFrame:
    """K-2: the concepts that are kept: in order, one is dropped when a concept kept before it in its paper has one of its keys.

    Concepts with the same keys are reduced to their first one before a paper's list is formed; the fold then runs over what
    differs, inside the JVM.
    """
    d = concepts.withColumn("__keys", concept_keys()).withColumn("__sorted", F.array_sort("__keys"))
    from paperloom.tables import materialise

    bare = d.where(F.size("__keys") == 0).select(by, order)
    first = materialise(d.where(F.size("__keys") > 0).groupBy(by, "__sorted").agg(F.min_by(F.struct(F.col(order).alias("o"), F.col("__keys").alias("k")), F.col(order)).alias("c")).select(by, "c"), "concepts")
    # a concept none of whose keys another one has is kept without comparison, and so round by round are those that come first under all their
    # keys, until the lists that are left to be folded are short
    settled = None
    while True:
        under = first.select(by, F.col("c.o").alias("__o"), F.explode("c.k").alias("__k"))
        heads = under.groupBy(by, "__k").agg(F.min("__o").alias("__least"), F.count("*").alias("__many"))
        stand = under.join(heads, [by, "__k"]).groupBy(by, "__o").agg(F.min(F.col("__o") == F.col("__least")).alias("__leads"), F.max("__many").alias("__most"))
        stand = materialise(stand, "stand")
        sure = stand.where("__most = 1").select(by, F.col("__o").alias(order))
        left = first.join(stand.where("__most > 1").select(by, F.col("__o")), (first[by] == stand[by]) & (F.col("c.o") == F.col("__o")), "left_semi")
        longest = left.groupBy(by).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
        if longest > FOLD:
            lead = stand.where("__leads").select(by, F.col("__o").alias(order))
            taken = under.join(lead.withColumnRenamed(order, "__o"), [by, "__o"], "left_semi").select(by, "__k").distinct()
            gone = under.join(taken, [by, "__k"], "left_semi").select(by, "__o").distinct()
            sure = lead
            left = first.join(gone.select(F.col(by).alias("__b"), "__o"), (F.col(by) == F.col("__b")) & (F.col("c.o") == F.col("__o")), "left_anti")
        settled = sure if settled is None else settled.unionByName(sure)
        first = materialise(left, "concepts")
        if longest <= FOLD:
            break
    start = F.struct(F.array().cast("array<string>").alias("held"), F.array().cast(f"array<{concepts.schema[order].dataType.simpleString()}>").alias("kept"))
    fold = lambda acc, x: F.when(F.arrays_overlap(acc["held"], x["k"]), acc).otherwise(F.struct(F.concat(acc["held"], x["k"]).alias("held"), F.concat(acc["kept"], F.array(x["o"])).alias("kept")))
    kept = first.groupBy(by).agg(F.aggregate(F.array_sort(F.collect_list("c")), start, fold)["kept"].alias("kept")).select(by, F.explode("kept").alias(order))
    return concepts.join(settled.unionByName(kept).unionByName(bare), [by, order], "left_semi")


def alias_map(concepts: DataFrame, by: str = "doc_id", id_col: str = "entry_id") -> DataFrame:
    """A-10: (by, alias, concept_id) of the aliases that one concept alone claims in its paper."""
    a = concepts.select(by, F.col(id_col).alias("__id"), F.explode(concept_keys()).alias("alias"))
    return a.groupBy(by, "alias").agg(F.min("__id").alias("concept_id"), F.max("__id").alias("__other")).where("concept_id = __other").drop("__other")


def link_relations(relations: DataFrame, aliases: DataFrame, by: str = "doc_id") -> DataFrame:
    """J-4, K-3: relations with ``head_entry_id`` and ``tail_entry_id``; null where no concept, or more than one, has the term."""
    out = relations
    for end in ("head", "tail"):
        a = aliases.select(F.col(by).alias("__d"), F.col("alias").alias("__a"), F.col("concept_id").alias(f"{end}_entry_id"))
        out = out.join(a, (F.col(by) == F.col("__d")) & (X.normal_term(F.col("payload")[f"{end}_term"]) == F.col("__a")), "left").drop("__d", "__a")
    return out


def dedup_key(type_: Column | str, payload: Column | str, anchor: Column | str) -> Column:
    """I-3: entries of one key are the same knowledge with the same anchor; links do not count."""
    p = F.col(payload) if isinstance(payload, str) else payload
    stable = F.array_sort(F.map_entries(F.map_filter(p, lambda k, _: ~k.isin("head_entry_id", "tail_entry_id"))))
    t = F.col(type_) if isinstance(type_, str) else type_
    prefix = F.create_map(*[F.lit(x) for k, (s, _, _) in TYPES.items() for x in (k, s)])[t]
    identity = F.to_json(F.struct(t.alias("t"), stable.alias("p"), X.normalise_match(F.coalesce(F.col(anchor) if isinstance(anchor, str) else anchor, F.lit(""))).alias("a")))
    return F.concat(F.lit("_tmp_"), prefix, F.lit("_"), F.substring(F.sha2(identity, 256), 1, 24))


def deduplicate(entries: DataFrame, key: str = "key", by: str = "doc_id", order: str = "pos") -> DataFrame:
    """W-3, K-6: of entries with one key in a paper the first."""
    first = entries.groupBy(by, key).agg(F.min(order).alias(order))
    return entries.join(first, [by, key, order], "left_semi")


def collapse_datasets(entries: DataFrame, by: str = "doc_id", order: str = "pos") -> tuple[DataFrame, DataFrame]:
    """A-9, K-7: (entries, report): more than five datasets of one located evidence collapse to the first; the report has the names of the
    removed ones in order."""
    text = F.col("evidence.original_text")
    shared = (F.col("type") == "dataset") & F.col("evidence.page").isNotNull() & (F.coalesce(text, F.lit("")) != "")
    groups = entries.where(shared).groupBy(by, text.alias("__text")).agg(F.count("*").alias("__n"), F.min(order).alias("__first")).where(F.col("__n") > SHARED)
    hit = entries.alias("e").where(shared).join(groups.alias("g"), (F.col(f"e.{by}") == F.col(f"g.{by}")) & (F.col("e.evidence.original_text") == F.col("g.__text")))
    hit = hit.select(F.col(f"e.{by}").alias(by), F.col(f"e.{order}").alias(order), F.col("e.payload")["name"].alias("name"), F.col("e.evidence.page").alias("page"), "__text", (F.col(f"e.{order}") == F.col("g.__first")).alias("first"))
    removed = hit.where(~F.col("first")).select(by, order)
    names = F.transform(F.array_sort(F.collect_list(F.when(~F.col("first"), F.struct(order, "name")))), lambda x: x["name"])
    report = hit.groupBy(by, "__text").agg(F.max(F.when(F.col("first"), F.col("name"))).alias("kept_name"), names.alias("removed_names"), F.max(F.when(F.col("first"), F.col("page"))).alias("page")).drop("__text")
    return entries.join(removed, [by, order], "left_anti"), report


def public_ids(entries: DataFrame, by: str = "doc_id", order: str = "pos") -> DataFrame:
    """W-4: entries with ``public_id``: paper, type and the entry's number among its paper's entries of the type."""
    from paperloom.tables import materialise

    # numbered within ranges of the order, and the ranges added up: a paper with a third of all entries is no single sort
    r = materialise(entries.repartitionByRange(by, "type", order).withColumn("__part", F.spark_partition_id()), "ranged")
    here = r.groupBy(by, "type", "__part").agg(F.count("*").alias("__n"))
    earlier = Window.partitionBy(by, "type").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    before = here.select(F.col(by).alias("__b"), F.col("type").alias("__t"), F.col("__part").alias("__q"), F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    j = r.join(before, F.col(by).eqNullSafe(F.col("__b")) & F.col("type").eqNullSafe(F.col("__t")) & (F.col("__part") == F.col("__q")), "left")
    n = F.row_number().over(Window.partitionBy(by, "type", "__part").orderBy(order)) + F.col("__before")
    return j.withColumn("public_id", F.format_string("%s_%s_%04d", F.col(by), F.col("type"), n)).select(*entries.columns, "public_id")


def relink(relations: DataFrame, ids: DataFrame, by: str = "doc_id", old: str = "entry_id") -> DataFrame:
    """J-7, K-8: links of relations rewritten to public ids; a link to a removed entry becomes null."""
    out = relations
    for end in ("head_entry_id", "tail_entry_id"):
        m = ids.select(F.col(by).alias("__d"), F.col(old).alias("__o"), F.col("public_id").alias("__p"))
        out = out.join(m, (F.col(by) == F.col("__d")) & (F.col(end) == F.col("__o")), "left").withColumn(end, F.col("__p")).drop("__d", "__o", "__p")
    return out


def merge_retry(old: DataFrame, new: DataFrame, by: str = "doc_id") -> DataFrame:
    """J-10: the entries of the types that are not replaced, then the new ones."""
    replaced = new.select(by, "type").distinct()
    return old.join(replaced, [by, "type"], "left_anti").unionByName(new, allowMissingColumns=True)


def type_counts(entries: DataFrame) -> DataFrame:
    """A-5."""
    return entries.groupBy("type").agg(F.count("*").alias("n"))


def located(entries: DataFrame) -> DataFrame:
    """A-6: entries with a page, all, and their share."""
    return entries.agg(F.count_if(F.col("evidence.page").isNotNull()).alias("located"), F.count("*").alias("total")).withColumn("share", F.when(F.col("total") > 0, F.round(F.col("located") / F.col("total"), 4)))


def link_summary(relations: DataFrame) -> DataFrame:
    """A-7: relations with both ends linked, one, none."""
    h, t = F.col("head_entry_id").isNotNull(), F.col("tail_entry_id").isNotNull()
    return relations.agg(F.count_if(h & t).alias("full"), F.count_if(h != t).alias("part"), F.count_if(~h & ~t).alias("unlinked"), F.count("*").alias("total"))


def assemble(items: DataFrame, papers: DataFrame, docs_key: str = "source_key") -> dict[str, DataFrame]:
    """K-1, K-5: raw items (doc_id, source_key, pos, type, item) and papers (source_key, text) to ``entries`` and ``audit``.

    Concepts come first in a group so that links find them; every order is an explicit position.
    """
    from paperloom.operators import evidence as E
    from paperloom.tables import materialise

    # written once each: several steps read them, and their expressions are not repeated in what follows
    valid = materialise(parse_items(items), "items").where("valid")
    concepts = greedy_concepts(valid.where("type = 'concept'"))
    rest = valid.where("type <> 'concept'")
    all_ = concepts.unionByName(rest).withColumn("key", dedup_key("type", "payload", "anchor_text"))
    kept = materialise(deduplicate(all_), "kept")
    found = E.locate_and_expand(kept.select("doc_id", docs_key, "pos", "type", "payload", "section", "confidence", "key", "anchor_text"), papers, docs_key)
    found = materialise(found.drop("pages", "items", "needle"), "located")
    ev = F.struct(F.col("section"), F.col("page"), F.col("anchor_text"), F.col("original_text"), F.col("match_method")).alias("evidence")
    entries = found.select("doc_id", "pos", "type", "payload", ev, "confidence", F.col("key").alias("entry_id"), "source_kind")
    entries, collapsed = collapse_datasets(entries)
    # concepts before all else (L-7), then the order of the replies
    entries = public_ids(entries.withColumn("ord", F.struct((F.col("type") != "concept").alias("late"), "pos")), order="ord").drop("ord")
    links = link_relations(entries.where("type = 'relation'"), alias_map(entries.where("type = 'concept'"), id_col="public_id"))
    # J-8, J-7: the audit without what was collapsed, with the public ids
    at = ["doc_id", "pos", "type"]
    audit = E.audit(found, at).join(entries.select(*at, F.col("public_id").alias("entry_id")), at)
    return {"entries": entries.where("type <> 'relation'").unionByName(links, allowMissingColumns=True), "collapsed": collapsed, "audit": audit}


def legacy_links(entry: Column) -> tuple[Column, Column]:
    """N-8: (head, tail) of a relation's JSON: the links of its payload, else those that older documents hold beside it."""
    g = lambda p: F.nullif(F.get_json_object(entry, p), F.lit(""))
    return tuple(F.coalesce(g(f"$.payload.{end}_entry_id"), g(f"$.{end}")) for end in ("head", "tail"))


def extraction_info(model: Column, at: Column, retried: Column, failed: Column) -> Column:
    """K-11: the stamp of an extraction; ``retried`` and ``failed`` are comma-separated groups, null without any."""
    groups = lambda c: F.when(c != "", F.split(c, ","))
    return F.struct(model.alias("extraction_model"), at.alias("extraction_timestamp"), F.lit("anchor_grouped").alias("extraction_method"), groups(retried).alias("retry_groups"), groups(failed).alias("failed_groups"))
