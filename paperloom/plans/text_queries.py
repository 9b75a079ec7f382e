"""Queries over texts: clean-up, views, segments, metadata read from papers, evidence."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.functions import jsonfix, text as X
from paperloom.operators import evidence as E
from paperloom.operators import metadata as M
from paperloom.operators import prompts as P
from paperloom.operators import segments as G
from paperloom.plans import duck
from paperloom.plans.duck import norm, q, rx, section, sentences, squeeze, strip
from paperloom.plans.registry import ORACLES, query
from paperloom.tables import materialise, spread, table


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return spread(table(spark, d, "documents").select("doc_id", "source_key", "text"))


#: The forms of T-2 for DuckDB: the same patterns, whose white space is Unicode-aware by a flag here and by classes there.
_BM = [p.replace("(?iU)", "(?i)").replace(r"[\s\x1c-\x1f]", duck.WS) for p in X.BACK_MATTER]
_NUM = X._NUMBERED.replace("(?m)(?d)(?U)", "(?m)").replace(r"[\s\x1c-\x1f]", duck.WS)


def _back_matter(t: str) -> str:
    """T-2 in DuckDB SQL: the headings, then the list of numbered lines."""
    marks, gaps = f"regexp_extract_all({t}, {q(_NUM)})", f"list_transform(string_split_regex({t}, {q(_NUM)}), lambda s: length(s))"
    start = lambda i: f"(list_sum(gaps[1 : {i}]) + coalesce(list_sum(list_transform(marks[1 : {i} - 1], lambda m: length(m))), 0))"
    listed = f"(SELECT CASE WHEN len(marks) >= 5 THEN substr({t}, 1, CAST({start('k')} AS BIGINT)) ELSE {t} END FROM (SELECT marks, gaps, coalesce(list_max(list_filter(range(2, len(marks) + 1), lambda i: gaps[i] > 500)), len(marks) - 4) AS k FROM (SELECT {marks} AS marks, {gaps} AS gaps)))"
    return "CASE " + " ".join(f"WHEN regexp_matches({t}, {q(p)}) THEN string_split_regex({t}, {q(p)})[1]" for p in _BM) + f" ELSE {listed} END"


@query("t01_drop_pictures", f"SELECT doc_id, {rx('text', chr(92) + '*' + chr(92) + '*==> picture ' + chr(92) + '[.*?' + chr(92) + '] intentionally omitted <==' + chr(92) + '*' + chr(92) + '*' + chr(92) + 'n?', '')} AS text FROM documents")
def t01_drop_pictures(spark, d):
    return _docs(spark, d).select("doc_id", X.drop_pictures("text").alias("text"))


_TAILS = ("\n## References\nx", "\nBibliography \n[1] x", "\n# **Acknowledgments**\nwe thank", "\n" + "".join(f"- [{i}] a work\n" for i in range(1, 8)), "\n" + "z" * 600 + "".join(f"\n[ {i} ] b" for i in range(3)) + "\n" + "".join(f"• {i} c\n" for i in range(6)))


def _sql_text(t: str) -> str:
    return q(t).replace("\n", "' || chr(10) || '")


@query("t02_back_matter_tails", f"SELECT doc_id, {_back_matter('t')} AS body FROM (SELECT doc_id, text || CASE doc_id % {len(_TAILS)} " + " ".join(f"WHEN {i} THEN {_sql_text(x)}" for i, x in enumerate(_TAILS)) + " END AS t FROM documents)")
def t02_back_matter_tails(spark, d):
    """Every paper with a back matter of one of five forms added, for the tiers that few papers have."""
    tail = F.element_at(F.array(*map(F.lit, _TAILS)), F.pmod("doc_id", F.lit(len(_TAILS))).cast("int") + 1)
    return _docs(spark, d).select("doc_id", X.truncate_back_matter(F.concat("text", tail)).alias("body"))


@query("t02_back_matter", f"SELECT doc_id, {_back_matter('text')} AS body FROM documents")
def t02_back_matter(spark, d):
    return _docs(spark, d).select("doc_id", X.truncate_back_matter("text").alias("body"))


_ABS = rf"(?is)\A(.*?)(##{duck.WS}+\*?\*?Abstract\*?\*?{duck.WS}*\n)(.*?)(\n##.*|\z)"


def _abstract_order(t: str) -> str:
    """T-3 in DuckDB SQL."""
    part = lambda i: f"regexp_extract({t}, {q(_ABS)}, {i})"
    ps = f"list_filter(list_transform(string_split({strip(part(3))}, chr(10) || chr(10)), lambda s: {strip('s')}), lambda s: s <> '')"
    low = lambda x: f"regexp_matches({x}, '^\\p{{Ll}}')"
    merged = f"list_reduce(list_concat(ps[2:], ps[1:1]), lambda a, s: CASE WHEN {low('s')} THEN a || ' ' || s ELSE a || chr(10) || chr(10) || s END)"
    return f"(SELECT CASE WHEN len(ps) >= 2 AND {low('ps[1]')} THEN {part(1)} || {part(2)} || {merged} || {part(4)} ELSE {t} END FROM (SELECT {ps} AS ps))"


@query("t03_abstract_order", f"SELECT doc_id, {_abstract_order('text')} AS text FROM documents")
def t03_abstract_order(spark, d):
    return _docs(spark, d).select("doc_id", X.fix_abstract_order("text").alias("text"))


_TURNED = "'# A title' || chr(10) || chr(10) || '## **Abstract**' || chr(10) || chr(10) || 'and ends here.' || chr(10) || chr(10) || 'It begins, ' || chr(10) || chr(10) || 'goes on,' || chr(10) || chr(10) || 'Then more' || chr(10) || '## Next' || chr(10) || text"


@query("t03_turned_abstracts", f"SELECT doc_id, {_abstract_order('t')} AS text FROM (SELECT doc_id, {_TURNED} AS t FROM documents)")
def t03_turned_abstracts(spark, d):
    """Every paper behind an abstract whose paragraphs are out of order."""
    head = "# A title\n\n## **Abstract**\n\nand ends here.\n\nIt begins, \n\ngoes on,\n\nThen more\n## Next\n"
    return _docs(spark, d).select("doc_id", X.fix_abstract_order(F.concat(F.lit(head), "text")).alias("text"))


_TL = r"(?m)^\s*\|.*\|\s*$\n?"


@query("t04_strip_tables", f"SELECT doc_id, {rx('text', _TL, '')} AS text FROM documents")
def t04_strip_tables(spark, d):
    return _docs(spark, d).select("doc_id", X.strip_tables("text").alias("text"))


_GAP = q(X.GAP).replace("\n", "' || chr(10) || '")


@query("t05_front_tail", f"SELECT doc_id, CASE WHEN length(text) <= 600 THEN text ELSE {rx('substr(text, 1, 200)', duck.WS + '+$', '')} || {_GAP} || {rx('right(text, 400)', '^' + duck.WS + '+', '')} END AS view, CASE WHEN text IS NULL OR length(text) > 600 THEN 'front_200_tail_400' ELSE 'full' END AS label FROM documents")
def t05_front_tail(spark, d):
    view, label = X.front_tail("text", 600)
    return _docs(spark, d).select("doc_id", view.alias("view"), label.alias("label"))


@query("t06_prefix_view", f"SELECT doc_id, substr({rx('text', _TL, '')}, 1, 600) AS view FROM documents")
def t06_prefix_view(spark, d):
    """A view of a given budget is the operator's result; the whole text is read."""
    return _docs(spark, d).select("doc_id", F.substring(X.strip_tables("text"), 1, 600).alias("view"))


@query("t07_normalise", f"SELECT doc_id, {norm('text')} AS norm FROM documents")
def t07_normalise(spark, d):
    return _docs(spark, d).select("doc_id", X.normalise_match("text").alias("norm"))


@query("t08_pages", f"SELECT * FROM {duck.PAGES}")
def t08_pages(spark, d):
    return G.pages(_docs(spark, d))


@query("t09_blocks", f"SELECT * FROM {duck.BLOCKS}")
def t09_blocks(spark, d):
    return G.blocks(_docs(spark, d)).drop("is_table")


@query("t10_sentences", f"SELECT doc_id, i - 1 AS sidx, s[i] AS sentence FROM (SELECT doc_id, {sentences('text')} AS s FROM documents) t, unnest(range(1, len(s) + 1)) AS u(i)")
def t10_sentences(spark, d):
    return _docs(spark, d).select("doc_id", F.posexplode(X.sentences("text")).alias("sidx", "sentence"))


_TABLES = f"len(list_filter(string_split_regex(raw, '\\r\\n|\\n|\\r'), lambda l: regexp_matches(l, {q(X.TABLE_LINE)}))) >= 2"
_ITEMS = f"(SELECT source_key, row_number() OVER (PARTITION BY source_key ORDER BY pidx, bidx, i) - 1 AS sidx, pidx, bidx, s[i] AS raw FROM (SELECT source_key, pidx, bidx, {sentences('raw')} AS s FROM {duck.BLOCKS} WHERE NOT ({_TABLES})) b, unnest(range(1, len(s) + 1)) AS u(i))"


@query("t11_sentence_items", f"SELECT source_key, sidx, pidx, bidx, raw FROM {_ITEMS}")
def t11_sentence_items(spark, d):
    return G.sentences(_docs(spark, d)).select("source_key", "sidx", "pidx", "bidx", "raw")


@query("pred11_table_blocks", f"SELECT source_key, pidx, bidx FROM (SELECT *, len(list_filter(string_split_regex(raw, '\\r\\n|\\n|\\r'), lambda l: regexp_matches(l, {q(X.TABLE_LINE)}))) AS n FROM {duck.BLOCKS}) WHERE n >= 2")
def pred11_table_blocks(spark, d):
    return G.blocks(_docs(spark, d)).where("is_table").select("source_key", "pidx", "bidx")


@query("t13_sections", f"SELECT doc_id, {section('text', 'Abstract')} AS abstract, {section('text', 'Results')} AS results, {section('text', 'Conclusion')} AS conclusion FROM documents")
def t13_sections(spark, d):
    return _docs(spark, d).select("doc_id", *[X.section("text", h).alias(h.lower()) for h in ("Abstract", "Results", "Conclusion")])


@query("t14_unbold", f"SELECT doc_id, {strip(rx('text', chr(92) + '*' + chr(92) + '*(.*?)' + chr(92) + '*' + chr(92) + '*', chr(92) + '1'))} AS text FROM documents")
def t14_unbold(spark, d):
    return _docs(spark, d).select("doc_id", X.unbold("text").alias("text"))


def _bare(n: int) -> str:
    return strip(rx(rx(f"substr(l, {n})", "`(.*?)`", r"\1"), r"\*\*(.*?)\*\*", r"\1"))


def _none_of(phrases) -> str:
    return "NOT (" + " OR ".join(f"contains(lower(l), {q(p)})" for p in dict.fromkeys(x.lower() for x in phrases)) + ")"


_H1 = f"list_filter(list_transform(list_filter(lines, lambda l: starts_with(l, '# ') AND NOT starts_with(l, '# #')), lambda l: {_bare(3)}), lambda l: length(l) >= 15 AND {_none_of(X.NO_TITLE)})[1]"
def _without_note(x: str, pattern: str) -> str:
    """A title without a note, as of :func:`text.without_note`."""
    p = q(pattern.replace("(?iU)", "(?i)"))
    b, a = f"{strip(f'string_split_regex(x, {p})[1]')}", f"{strip(f'substr(x, length(string_split_regex(x, {p})[1]) + length(regexp_extract(x, {p})) + 1)')}"
    return f"(SELECT CASE WHEN NOT regexp_matches(x, {p}) THEN x WHEN length(b) > 10 AND length(a) > 3 THEN b || ' ' || a WHEN length(b) > 15 THEN b WHEN length(a) > 15 THEN a ELSE x END FROM (SELECT x, {b} AS b, {a} AS a FROM (SELECT {x} AS x)))"


for _p in X.TITLE_NOTES:
    _H1 = _without_note(_H1, _p)
_H1 = squeeze(rx(rx(rx(_H1, r"\s+[\*†§#‡]+\s*$", "", "s"), r"\s+[0-9]+-[0-9]+\s*$", "", "s"), r"\s*\([12][0-9]{3}\)\s*$", "", "s"))
_H2 = f"list_filter(list_transform(list_filter(lines, lambda l: starts_with(l, '## ') AND NOT starts_with(l, '## #')), lambda l: {squeeze(_bare(4))}), lambda l: length(l) >= 15 AND {_none_of(X.SECTION_NAMES + X.NO_TITLE)})[1]"


def _title_sql(docs: str) -> str:
    return f"SELECT doc_id, coalesce(CASE WHEN length(h1) >= 10 THEN h1 END, h2, translate(regexp_replace(regexp_replace(source_key, '^.*/', ''), '\\.[^.]*$', ''), '_-', '  ')) AS title FROM (SELECT doc_id, source_key, {_H1} AS h1, {_H2} AS h2 FROM (SELECT *, string_split(text, chr(10)) AS lines FROM {docs}))"


@query("t15_title", _title_sql("documents"))
def t15_title(spark, d):
    return _docs(spark, d).select("doc_id", X.title("text", X.stem("source_key")).alias("title"))


_NOTED = ("# Sediments of the lower bay DOI 10.1000/abc.123 and what it means\n", "# Cite this Sediments of the lower bay (2019)\n", "# DOI10.1234/x.y Sediments of the bay\n", "# Sediments of the lower bay cite this 10 *\n", "# Bay DOI 10.1000/abc.123 now\n", "# Sediments of the lower bay 10-20\n")


@query("t15_noted_titles", _title_sql("(SELECT doc_id, source_key, CASE doc_id % 6 " + " ".join(f"WHEN {i} THEN {_sql_text(x)}" for i, x in enumerate(_NOTED)) + " END || text AS text FROM documents)"))
def t15_noted_titles(spark, d):
    """Every paper behind a title line with a note of one of six forms."""
    line = F.element_at(F.array(*map(F.lit, _NOTED)), F.pmod("doc_id", F.lit(len(_NOTED))).cast("int") + 1)
    return _docs(spark, d).select("doc_id", X.title(F.concat(line, "text"), X.stem("source_key")).alias("title"))


@query("t16_doi", "SELECT doc_id, coalesce(nullif(rtrim(regexp_extract(text, '(?i)doi\\.org/(10\\.\\d{4,}/\\S+)', 1), '.'), ''), nullif(rtrim(regexp_extract(substr(text, 1, 3000), '(10\\.\\d{4,}/[^\\s\"'']+)', 1), '.,;:)]}'), '')) AS doi FROM documents")
def t16_doi(spark, d):
    return _docs(spark, d).select("doc_id", X.doi_candidate("text").alias("doi"))


_LEAD = r"(?im)^\s*(?:[#*_`-]+\s*)?(?:"


def _year(words: str) -> str:
    y = f"TRY_CAST(regexp_extract(head, {q(_LEAD + words + ')' + chr(92) + 'b[^' + chr(92) + 'n]*?(' + chr(92) + 'd{4})')}, 1) AS INTEGER)"
    return f"CASE WHEN {y} BETWEEN 1990 AND 2030 THEN {y} END"


@query("t17_year", f"SELECT doc_id, coalesce({_year('Date|Published|Publication' + chr(92) + 's*date|Submitted|Posted')}, {_year('Received|Accepted|Revised')}, TRY_CAST(regexp_extract(head, '©\\s*(\\d{{4}})', 1) AS INTEGER)) AS year FROM (SELECT doc_id, substr(text, 1, 5000) AS head FROM documents)")
def t17_year(spark, d):
    return _docs(spark, d).select("doc_id", X.year_candidate("text").alias("year"))


_LOOSE = strip("regexp_extract(text, " + q(r"(?is)((?:\A|\n)\*?\*?_?\*?\*?\s*(?:Abstract|摘要)[:.\s]?[\s—–\-]*.*?)(?:\n\s*\n|\n##|\n# )") + ", 1)")


@query(
    "t18_abstract",
    f"SELECT doc_id, coalesce(nullif(a, ''), nullif(z, ''), CASE WHEN length(l) > 100 THEN l END, list_filter(list_transform(string_split(text, chr(10)), lambda s: {strip('s')}), lambda s: length(s) > 200 AND NOT starts_with(s, '#') AND len(regexp_extract_all(s, '\\[\\d+(?:,\\d+)*\\]')) < 3 AND NOT contains(s, '✉'))[1]) AS abstract FROM (SELECT doc_id, text, {section('text', 'Abstract')} AS a, {section('text', '摘要')} AS z, {_LOOSE} AS l FROM documents)",
)
def t18_abstract(spark, d):
    return _docs(spark, d).select("doc_id", X.abstract_candidate("text").alias("abstract"))


_INTRO = q(r"(?is)\A#{1,2}\s+\*?\*?\s*[IVX0-9.]*(?:Introduction|引言|Background\s*(?:&|and)\s*Summary|Background)[:.]?\*?\*?\s*\n(.*?)(?:\n##|\z)")


@query("t19_introduction", "SELECT doc_id, coalesce(" + ", ".join(f"nullif({section('text', h)}, '')" for h in X.INTRODUCTIONS) + f", CASE WHEN regexp_matches(text, {_INTRO}) THEN {strip(f'regexp_extract(text, {_INTRO}, 1)')} END) AS introduction FROM documents")
def t19_introduction(spark, d):
    return _docs(spark, d).select("doc_id", X.introduction_candidate("text").alias("introduction"))


@query("t20_keywords", f"SELECT doc_id, i - 1 AS pos, k[i] AS keyword FROM (SELECT doc_id, list_filter(list_transform(string_split_regex({strip(rx(section('text', 'Keywords'), chr(92) + '*' + chr(92) + '*(.*?)' + chr(92) + '*' + chr(92) + '*', chr(92) + '1'))}, '[;,]'), lambda s: {strip('s')}), lambda s: s <> '') AS k FROM (SELECT doc_id, text || chr(10) || '## Keywords' || chr(10) || lang || '; ' || source || ' ,x' AS text FROM documents)) t, unnest(range(1, len(k) + 1)) AS u(i)")
def t20_keywords(spark, d):
    """Every paper with a section of keywords added."""
    t = F.concat("text", F.lit("\n## Keywords\n"), "lang", F.lit("; "), "source", F.lit(" ,x"))
    return table(spark, d, "documents").select("doc_id", F.posexplode(X.keywords_of(t)).alias("pos", "keyword"))


@query("t21_normal_doi", f"SELECT doc_id, CASE WHEN starts_with(x, '10.') THEN x END AS doi FROM (SELECT doc_id, rtrim(regexp_replace({strip(q('https://doi.org/') + ' || doi || ' + q('.'))}, '(?i)^(?:https?://(?:dx\\.)?doi\\.org/|doi:\\s*)', ''), '.,;)') AS x FROM metadata)")
def t21_normal_doi(spark, d):
    return table(spark, d, "metadata").select("doc_id", X.normal_doi(F.concat(F.lit("https://doi.org/"), "doi", F.lit("."))).alias("doi"))


@query("t24_prompt_content", f"SELECT doc_id, lower({squeeze(rx('text', '[*_`#]', ''))}) AS content FROM documents")
def t24_prompt_content(spark, d):
    return _docs(spark, d).select("doc_id", X.prompt_content("text").alias("content"))


@query("t26_head", "SELECT doc_id, substr(text, 1, 5000) AS head FROM documents")
def t26_head(spark, d):
    """The head for a prompt: its length is the operator's parameter."""
    return _docs(spark, d).select("doc_id", F.substring("text", 1, 5000).alias("head"))


@query("a12_page_counts", "SELECT source_key, length(text) AS chars, len(regexp_extract_all(text, '<!--\\s*PAGE\\s+\\d+\\s*-->')) AS pages FROM documents")
def a12_page_counts(spark, d):
    return _docs(spark, d).select("source_key", F.length("text").alias("chars"), F.regexp_count("text", F.lit(X.PAGE_MARKER_ANY)).alias("pages"))


_LV = ", ".join(q(x) for x in M.LEVEL1)


@query("k09_primary_discipline", f"SELECT DISTINCT doc_id, CASE WHEN l1 IN ({_LV}) THEN l1 END AS level1, CASE WHEN l1 IN ({_LV}) THEN nullif({strip('primary_discipline.level2')}, '') END AS level2, CASE WHEN l1 IN ({_LV}) THEN nullif({strip('primary_discipline.level3')}, '') END AS level3 FROM (SELECT *, {strip('primary_discipline.level1')} AS l1 FROM metadata)")
def k09_primary_discipline(spark, d):
    return M.validate_disciplines(table(spark, d, "metadata")).select("doc_id", *[F.col(f"primary_valid.{n}").alias(n) for n in ("level1", "level2", "level3")]).distinct()


@query("k09_secondary_disciplines", f"SELECT DISTINCT doc_id, s.level1 AS level1, nullif({strip('s.level2')}, '') AS level2, nullif({strip('s.level3')}, '') AS level3 FROM (SELECT doc_id, primary_discipline AS p, unnest(secondary_disciplines) AS s FROM metadata) WHERE {strip('s.level1')} IN ({_LV}) AND NOT coalesce({strip('s.level1')} = {strip('p.level1')} AND nullif({strip('s.level2')}, '') IS NOT DISTINCT FROM nullif({strip('p.level2')}, '') AND nullif({strip('s.level3')}, '') IS NOT DISTINCT FROM nullif({strip('p.level3')}, ''), false)")
def k09_secondary_disciplines(spark, d):
    v = M.validate_disciplines(table(spark, d, "metadata")).select("doc_id", F.explode("secondary_valid").alias("s"))
    return v.select("doc_id", "s.level1", "s.level2", "s.level3").distinct()


def _entry_anchors(spark: SparkSession, d: str) -> DataFrame:
    """The anchors of all entries: (source_key, doc_id, entry_id, type, anchor_text), a repeated delivery once. The key of an entry's paper is
    null where no metadata has it; such an anchor is not located and still counts."""
    keys = table(spark, d, "metadata").groupBy("doc_id").agg(F.min("source_file").alias("source_key"))
    e = table(spark, d, "entry").where(F.col("evidence.anchor_text").isNotNull()).select("doc_id", "entry_id", "type", F.col("evidence.anchor_text").alias("anchor_text")).distinct()
    return e.join(keys, "doc_id", "left").select("source_key", "doc_id", "entry_id", "type", "anchor_text")


def _anchors(spark: SparkSession, d: str) -> DataFrame:
    """The starts of the abstracts as anchors, for e01_locate_exact and its SQL: (source_key, doc_id, anchor_text)."""
    a = table(spark, d, "metadata").where(F.length("abstract") >= 20)
    return a.select(F.col("source_file").alias("source_key"), "doc_id", F.substring("abstract", 1, 100).alias("anchor_text")).distinct()


_A = f"(SELECT *, {norm('anchor_text')} AS needle FROM (SELECT DISTINCT source_file AS source_key, doc_id, substr(abstract, 1, 100) AS anchor_text FROM metadata WHERE length(abstract) >= 20))"
_RUNS = f"(SELECT source_key, pidx, page, bidx, s, string_agg(n, ' ' ORDER BY k) AS joined FROM (SELECT b.source_key, b.pidx, b.page, b.bidx, s, k.bidx AS k, k.norm AS n, b.m FROM (SELECT *, count(*) OVER (PARTITION BY source_key, pidx) AS m FROM blocks) b, range(1, 5) AS r(s), blocks k WHERE k.source_key = b.source_key AND k.pidx = b.pidx AND k.bidx BETWEEN b.bidx AND b.bidx + s - 1 AND b.bidx + s <= b.m) GROUP BY ALL)"
_RUNS = _RUNS.replace("GROUP BY ALL", "GROUP BY source_key, pidx, page, bidx, s")
_LOCATE = f"""
WITH blocks AS (SELECT * FROM {duck.BLOCKS}), anchors AS (SELECT * FROM {_A}),
hits AS (
  SELECT a.doc_id, a.anchor_text, r.pidx, r.page, r.bidx, 1 AS tier, r.s FROM anchors a JOIN {_RUNS} r ON a.source_key = r.source_key AND a.needle <> '' AND contains(r.joined, a.needle)
  UNION ALL
  SELECT a.doc_id, a.anchor_text, p.pidx, p.page, b.bidx, 2, 9 FROM anchors a JOIN (SELECT *, {norm('raw')} AS pn FROM {duck.PAGES}) p ON a.source_key = p.source_key AND a.needle <> '' AND contains(p.pn, a.needle)
    JOIN blocks b ON b.source_key = p.source_key AND b.pidx = p.pidx AND contains(b.norm, substr(a.needle, 1, 80))),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, anchor_text ORDER BY pidx, tier, s, bidx) AS rn FROM hits) WHERE rn = 1)
SELECT a.doc_id, a.anchor_text, b.page, b.bidx FROM anchors a LEFT JOIN best b ON a.doc_id = b.doc_id AND a.anchor_text = b.anchor_text"""


@query("e01_locate_exact", _LOCATE)
def e01_locate_exact(spark, d):
    f = E.locate(_anchors(spark, d), G.structure(_docs(spark, d).drop("doc_id").repartition("source_key")))
    exact = F.col("match_method") == "exact"
    return f.select("doc_id", "anchor_text", F.when(exact, F.col("page")).alias("page"), F.when(exact, F.col("bidx")).alias("bidx"))


_ENTRY_A = f"(SELECT *, {norm('anchor_text')} AS needle FROM (SELECT DISTINCT m.source_key, e.doc_id, e.evidence.anchor_text AS anchor_text FROM entry e LEFT JOIN (SELECT doc_id, min(source_file) AS source_key FROM metadata GROUP BY doc_id) m ON e.doc_id = m.doc_id WHERE e.evidence.anchor_text IS NOT NULL))"


@query("e01_locate_entries", _LOCATE.replace(_A, _ENTRY_A))
def e01_locate_entries(spark, d):
    """The anchors of all entries; the same of two entries of a paper once."""
    f = E.locate(_entry_anchors(spark, d).select("source_key", "doc_id", "anchor_text").distinct(), G.structure(_docs(spark, d).drop("doc_id").repartition("source_key")))
    exact = F.col("match_method") == "exact"
    return f.select("doc_id", "anchor_text", F.when(exact, F.col("page")).alias("page"), F.when(exact, F.col("bidx")).alias("bidx"))


@query("e03_anchor_page", _LOCATE.replace(_A, _ENTRY_A).replace("SELECT a.doc_id, a.anchor_text, b.page, b.bidx FROM", "SELECT a.doc_id, a.anchor_text, b.page FROM"))
def e03_anchor_page(spark, d):
    """E-3: the page of every anchor that a run of blocks or its page holds."""
    return e01_locate_entries(spark, d).drop("bidx")


def _pieces(sizes: str) -> str:
    """The pieces of the needles of ``wanted``, the longest first: (doc_id, anchor_text, source_key, ord, f)."""
    return f"""SELECT doc_id, anchor_text, source_key, pidx, si * 100000 + ti AS ord, substr(needle, starts[ti] + 1, size) AS f FROM (
      SELECT *, list_concat(range(0, n - size + 1, step), CASE WHEN list_contains(range(0, n - size + 1, step), n - size) THEN []::BIGINT[] ELSE [n - size] END) AS starts FROM (
        SELECT *, sizes[si] AS size, greatest(20, sizes[si] // 3) AS step FROM (SELECT *, length(needle) AS n, {sizes} AS sizes FROM wanted WHERE length(needle) >= 80) w, unnest(range(1, len(sizes) + 1)) AS u(si))
      WHERE size >= 80 AND size <= n) x, unnest(range(1, len(starts) + 1)) AS v(ti)"""


def _located(anchors: str) -> str:
    """The steps of E-1 and E-2 in DuckDB SQL, up to ``loc``: the anchors with method, page, pidx, bidx."""
    exact = _LOCATE.replace(_A, anchors).replace("WITH blocks AS", "WITH blocks AS MATERIALIZED")
    head = exact[: exact.rindex("SELECT a.doc_id")].replace("SELECT a.doc_id, a.anchor_text, r.pidx", "SELECT a.doc_id, a.anchor_text, r.pidx").rstrip()
    down = "list_reverse_sort(list_distinct([80, least(120, length(needle)), least(160, length(needle))]))"
    return f"""{head},
wanted AS (SELECT a.*, NULL AS pidx FROM anchors a ANTI JOIN best b ON a.doc_id = b.doc_id AND a.anchor_text = b.anchor_text),
pieces AS (SELECT * FROM (SELECT * REPLACE ({strip('f')} AS f) FROM ({_pieces(down)})) WHERE length(f) >= 80),
single AS (SELECT p.doc_id, p.anchor_text, p.ord, count(*) AS c, min(b.pidx) AS pidx, min(b.page) AS page, min(b.bidx) AS bidx FROM pieces p JOIN blocks b ON p.source_key = b.source_key AND contains(b.norm, p.f) GROUP BY ALL HAVING count(*) = 1),
piece AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, anchor_text ORDER BY ord) AS rn FROM single) WHERE rn = 1),
loc AS MATERIALIZED (SELECT a.*, CASE WHEN b.doc_id IS NOT NULL THEN 'exact' WHEN p.doc_id IS NOT NULL THEN 'unique_fragment' ELSE 'unmatched' END AS match_method, coalesce(b.page, p.page) AS page, coalesce(b.pidx, p.pidx) AS pidx, coalesce(b.bidx, p.bidx) AS bidx
  FROM anchors a LEFT JOIN best b ON a.doc_id = b.doc_id AND a.anchor_text = b.anchor_text LEFT JOIN piece p ON a.doc_id = p.doc_id AND a.anchor_text = p.anchor_text)"""


_EVERY = "(SELECT DISTINCT doc_id, entry_id, type, evidence.anchor_text AS anchor_text FROM entry WHERE evidence.anchor_text IS NOT NULL)"
_WRONG = "SELECT DISTINCT source_file AS source_key, doc_id, '@@@@ ' || substr(abstract, 1, 190) AS anchor_text FROM metadata WHERE length(abstract) >= 200"
_WITH_WRONG = _ENTRY_A.replace("FROM (SELECT DISTINCT m.source_key", f"FROM ({_WRONG} UNION SELECT DISTINCT m.source_key")


@query("e02_unique_fragment", _located(_WITH_WRONG) + f" SELECT l.doc_id, e.entry_id, l.anchor_text, match_method, page, bidx FROM loc l JOIN (SELECT doc_id, entry_id, anchor_text FROM {_EVERY} UNION ALL SELECT doc_id, NULL, anchor_text FROM ({_WRONG})) e ON l.doc_id = e.doc_id AND l.anchor_text = e.anchor_text")
def e02_unique_fragment(spark, d):
    """The anchors of all entries, and abstracts with a wrong start, which only a fragment can locate (without entry_id)."""
    built = table(spark, d, "metadata").where(F.length("abstract") >= 200).select(F.col("source_file").alias("source_key"), "doc_id", F.concat(F.lit("@@@@ "), F.substring("abstract", 1, 190)).alias("anchor_text")).distinct()
    a = _entry_anchors(spark, d).drop("type").unionByName(built, allowMissingColumns=True)
    return E.locate(a, G.structure(_docs(spark, d).drop("doc_id").repartition("source_key"))).select("doc_id", "entry_id", "anchor_text", "match_method", "page", "bidx")


def _expanded(spark: SparkSession, d: str) -> DataFrame:
    return E.locate_and_expand(_entry_anchors(spark, d), _docs(spark, d).drop("doc_id"))


def _expanded_sql(anchors: str = _ENTRY_A) -> str:
    """E-4 and E-5 in DuckDB SQL, up to ``expanded``: every anchor with source_kind and original_text."""
    caption, cut = f"regexp_matches({{}}, {q(E.CAPTION)})", lambda x: strip(f"substr({x}, 1, {E.CAP})")
    lines = f"list_filter(list_transform(list_filter(string_split_regex(t.raw, '\\r\\n|\\n|\\r'), lambda l: {strip('l')} <> ''), lambda l: {strip('l')}), lambda l: regexp_matches(l, {q(X.TABLE_LINE)}))"
    rule = f"list_position(list_transform(lines, lambda l: regexp_matches(l, {q(E.SEPARATOR)})), true)"
    hits = f"list_filter(lines, lambda l: needle <> '' AND contains({norm('l')}, needle))"
    rows = "CASE WHEN len(hits) = 0 THEN lines ELSE list_concat(head, list_filter(hits, lambda l: NOT list_contains(head, l))) END"
    return f"""{_located(anchors)},
flat AS MATERIALIZED (SELECT *, {_TABLES} AS is_table FROM blocks),
items AS MATERIALIZED (SELECT * FROM {_ITEMS}),
kind AS (SELECT l.*, b.is_table AS table_here, NOT b.is_table AND {caption.format('b.raw')} AND coalesce(n.is_table, false) AS caption_here
  FROM loc l LEFT JOIN flat b ON l.source_key = b.source_key AND l.pidx = b.pidx AND l.bidx = b.bidx LEFT JOIN flat n ON l.source_key = n.source_key AND l.pidx = n.pidx AND l.bidx + 1 = n.bidx),
kinds AS (SELECT *, CASE WHEN bidx IS NULL THEN 'unmatched' WHEN table_here THEN 'table' WHEN caption_here THEN 'table_caption' ELSE 'text' END AS source_kind, CASE WHEN table_here THEN bidx WHEN caption_here THEN bidx + 1 END AS tb FROM kind),
cells AS (SELECT k.doc_id, k.anchor_text, k.needle, t.raw AS traw, {lines} AS lines, CASE WHEN {caption.format('p.raw')} THEN p.raw END AS above, CASE WHEN NOT a.is_table THEN a.raw END AS below
  FROM kinds k JOIN flat t ON k.source_key = t.source_key AND k.pidx = t.pidx AND k.tb = t.bidx LEFT JOIN flat p ON k.source_key = p.source_key AND k.pidx = p.pidx AND k.tb - 1 = p.bidx LEFT JOIN flat a ON k.source_key = a.source_key AND k.pidx = a.pidx AND k.tb + 1 = a.bidx),
tables AS (SELECT doc_id, anchor_text, {cut(f"concat_ws(chr(10) || chr(10), above, CASE WHEN len(lines) = 0 THEN {strip('traw')} ELSE substr(array_to_string({rows}, chr(10)), 1, {E.CAP}) END, below)")} AS original_text FROM (SELECT *, CASE WHEN {rule} > 0 THEN lines[1 : {rule}] ELSE lines[1:1] END AS head, {hits} AS hits FROM cells)),
wanted2 AS (SELECT * FROM kinds WHERE source_kind = 'text'),
needles AS (SELECT doc_id, anchor_text, source_key, pidx, 0 AS ord, needle AS f FROM wanted2 WHERE needle <> '' UNION ALL SELECT * FROM ({_pieces('[160, 120, 80]').replace('FROM wanted ', "FROM wanted2 ").replace('WHERE length(needle) >= 80', "WHERE length(needle) >= 80 AND match_method = 'unique_fragment'")})),
runs AS MATERIALIZED (SELECT source_key, pidx, st, span, {norm('j')} AS joined FROM (
  SELECT i.source_key, i.pidx, i.sidx AS st, s AS span, string_agg(k.raw, ' ' ORDER BY k.sidx) AS j FROM items i JOIN range(1, {E.WINDOW + 1}) AS r(s) ON true JOIN items k ON k.source_key = i.source_key AND k.pidx = i.pidx AND k.sidx BETWEEN i.sidx AND i.sidx + s - 1 GROUP BY ALL HAVING count(*) = s)),
windows AS (SELECT * FROM (SELECT n.doc_id, n.anchor_text, r.st, r.span, row_number() OVER (PARTITION BY n.doc_id, n.anchor_text ORDER BY n.ord, r.span, r.st) AS rn FROM needles n JOIN runs r ON n.source_key = r.source_key AND n.pidx = r.pidx AND contains(r.joined, n.f)) WHERE rn = 1),
firsts AS (SELECT source_key, pidx, bidx, min(sidx) AS sidx FROM items GROUP BY ALL),
frames AS (SELECT w.doc_id, w.anchor_text, w.source_key, coalesce(v.st, f.sidx) AS lo, coalesce(v.st + v.span - 1, f.sidx) AS hi FROM wanted2 w LEFT JOIN windows v ON w.doc_id = v.doc_id AND w.anchor_text = v.anchor_text LEFT JOIN firsts f ON w.source_key = f.source_key AND w.pidx = f.pidx AND w.bidx = f.bidx),
framed AS (SELECT f.doc_id, f.anchor_text, string_agg(i.raw, ' ' ORDER BY i.sidx) AS t FROM frames f JOIN items i ON f.source_key = i.source_key AND i.sidx BETWEEN f.lo - {E.AROUND} AND f.hi + {E.AROUND} GROUP BY ALL),
expanded AS (SELECT k.*, CASE WHEN k.source_kind = 'unmatched' THEN k.anchor_text WHEN k.tb IS NOT NULL THEN t.original_text WHEN f.t IS NULL THEN {cut('k.anchor_text')} ELSE {cut('f.t')} END AS original_text
  FROM kinds k LEFT JOIN tables t ON k.doc_id = t.doc_id AND k.anchor_text = t.anchor_text LEFT JOIN framed f ON k.doc_id = f.doc_id AND k.anchor_text = f.anchor_text)"""


_EXPANDED = _expanded_sql()
_AUDIT = f"SELECT e.doc_id, e.entry_id, e.type, x.anchor_text, x.bidx IS NOT NULL AS matched, x.match_method, x.page, x.source_kind, length(x.anchor_text) AS anchor_chars, length(x.original_text) AS evidence_chars, x.bidx IS NOT NULL AND length(x.original_text) > length(x.anchor_text) AS expanded FROM expanded x JOIN {_EVERY} e ON x.doc_id = e.doc_id AND x.anchor_text = e.anchor_text"


@query("e05_expand", f"{_EXPANDED} SELECT e.doc_id, e.entry_id, x.anchor_text, x.match_method, x.page, x.source_kind, x.original_text FROM expanded x JOIN {_EVERY} e ON x.doc_id = e.doc_id AND x.anchor_text = e.anchor_text")
def e05_expand(spark, d):
    return _expanded(spark, d).select("doc_id", "entry_id", "anchor_text", "match_method", "page", "source_kind", "original_text")


@query("e06_audit", f"{_EXPANDED} {_AUDIT}")
def e06_audit(spark, d):
    return E.audit(_expanded(spark, d), ["doc_id", "entry_id", "type"])


def _histogram(column: str) -> str:
    return f"(SELECT string_agg({column} || '=' || n, ',' ORDER BY {column}) FROM (SELECT {column}, count(*) AS n FROM audit GROUP BY 1))"


@query("a08_anchor_audit", f"{_EXPANDED}, audit AS MATERIALIZED ({_AUDIT}) SELECT count(*) AS total, count(*) FILTER (matched) AS matched, round(count(*) FILTER (matched) / count(*), 4) AS rate, {_histogram('source_kind')} AS by_source_kind, {_histogram('match_method')} AS by_method FROM audit")
def a08_anchor_audit(spark, d):
    got = E.audit_summary(materialise(E.audit(_expanded(spark, d), ["doc_id", "entry_id", "type"]), "audit"))
    told = lambda c: F.array_join(F.transform(F.map_entries(c), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",")
    return got.select("total", "matched", "rate", told("by_source_kind").alias("by_source_kind"), told("by_method").alias("by_method"))


def _groups_sql() -> str:
    """The groups in the order of their results."""
    types = {full: t for full, _, t in P.GROUPS}
    rows = [f"({k}, {q(g)}, {list(types[g])!r}, {'true' if set(types[g]) & set(P.NUMERIC) else 'false'})" for k, g in enumerate(P.ORDER)]
    return f"(SELECT * FROM (VALUES {', '.join(rows)}) AS g(ord, grp, types, tables))"


def _prompts_sql() -> str:
    plain, wide = f"substr({rx('text', _TL, '')}, 1, 100000)", f"CASE WHEN length(text) <= 100000 THEN text ELSE {rx('substr(text, 1, 10000)', duck.WS + '+$', '')} || {_GAP} || {rx('right(text, 90000)', '^' + duck.WS + '+', '')} END"
    ask = f"'List what the paper says as JSON with an array `entries`. Types: ' || array_to_string(types, ', ') || {_sql_text(chr(46) + chr(10) + 'Quote for each a short passage word for word as evidence.anchor_text; give no page.' + chr(10) * 2)}"
    return f"SELECT source_key, grp, CASE WHEN NOT tables THEN 'prefix' WHEN length(text) <= 100000 THEN 'full' ELSE 'front_10000_tail_90000' END AS view, length({ask} || CASE WHEN tables THEN {wide} ELSE {plain} END) AS chars FROM documents, {_groups_sql()} WHERE text IS NOT NULL AND grp IN ('GA_study_design', 'GB_results_claims')"


_ADDED = ("\n\nTable 3. Means of ", "\n\n| h | k |\n|---|---|\n| a | ", " |\n| b | 2 |\n\nAfter the table. It goes on.\n\nFig 4 shows it.\n")
_BUILT_DOCS = f"documents AS MATERIALIZED (SELECT doc_id, source_key, text || {_sql_text(_ADDED[0])} || doc_id || {_sql_text(_ADDED[1])} || doc_id || {_sql_text(_ADDED[2])} AS text FROM main.documents)"
_BUILT_A = f"(SELECT *, {norm('anchor_text')} AS needle FROM (SELECT DISTINCT source_key, doc_id, CASE i WHEN 0 THEN '| a | ' || doc_id || ' |' WHEN 1 THEN 'Table 3. Means of ' || doc_id WHEN 2 THEN substr(text, 400, 130) WHEN 3 THEN '@@@@ ' || substr(text, 600, 200) WHEN 4 THEN 'After the table. It' ELSE 'Fig 4 shows' END AS anchor_text FROM documents, range(6) AS r(i) WHERE text IS NOT NULL))"


@query("e05_expand_built", _expanded_sql(_BUILT_A).replace("WITH blocks", f"WITH {_BUILT_DOCS}, blocks", 1) + " SELECT doc_id, anchor_text, match_method, page, source_kind, original_text FROM expanded")
def e05_expand_built(spark, d):
    """Six anchors a paper, to which a captioned table is added: a line of the table, its caption, a stretch over sentences and blocks, one with a
    wrong start, two after the table."""
    n = F.col("doc_id").cast("string")
    docs = _docs(spark, d).where("text IS NOT NULL").withColumn("text", F.concat("text", F.lit(_ADDED[0]), n, F.lit(_ADDED[1]), n, F.lit(_ADDED[2])))
    forms = F.array(F.concat(F.lit("| a | "), n, F.lit(" |")), F.concat(F.lit("Table 3. Means of "), n), F.substring("text", 400, 130), F.concat(F.lit("@@@@ "), F.substring("text", 600, 200)), F.lit("After the table. It"), F.lit("Fig 4 shows"))
    anchors = docs.select("source_key", "doc_id", F.explode(forms).alias("anchor_text")).distinct()
    return E.locate_and_expand(anchors, docs.drop("doc_id")).select("doc_id", "anchor_text", "match_method", "page", "source_kind", "original_text")


_FILES = "array_to_string(list_transform(string_split(text, chr(12)), lambda p, i: '<!-- PAGE ' || i || ' -->' || chr(10) || chr(10) || p), chr(10) || chr(10))"
_PICTURES = rx("t", r"\*\*==> picture \[.*?\] intentionally omitted <==\*\*\n?", "")


@query("s10_converted", f"SELECT source_key, length(t) AS char_count, substr(sha256(t), 1, 24) AS converted_text_sha256_96 FROM (SELECT source_key, {_abstract_order('t')} AS t FROM (SELECT source_key, {_back_matter('t')} AS t FROM (SELECT source_key, {_PICTURES} AS t FROM (SELECT source_key, {_FILES} AS t FROM documents WHERE text IS NOT NULL))))")
def s10_converted(spark, d):
    """All texts as files through the converter: pages split, back matter cut, abstracts put in order."""
    from paperloom.sources import documents

    docs = spread(table(spark, d, "documents")).where("text IS NOT NULL").select("source_key", F.col("text").cast("binary").alias("content"))
    return documents.convert(docs).select("source_key", "char_count", "converted_text_sha256_96")


_K10_READ = " JOIN ".join(f"({ORACLES[n]}) {n[:3]}" + (" USING (doc_id)" if n != "t18_abstract" else "") for n in ("t18_abstract", "t19_introduction"))


@query(
    "k10_assembled",
    f"WITH read AS (SELECT d.source_key, r.abstract, r.introduction, {section('d.text', 'Keywords')} AS kw FROM documents d JOIN (SELECT doc_id, abstract, introduction FROM {_K10_READ}) r ON d.doc_id = r.doc_id), own AS (SELECT *, list_filter(list_transform(string_split_regex({strip(rx('kw', chr(92) + '*' + chr(92) + '*(.*?)' + chr(92) + '*' + chr(92) + '*', chr(92) + '1'))}, '[;,]'), lambda s: {strip('s')}), lambda s: s <> '') AS own FROM read), "
    f"answers AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY coalesce(extraction_info.extraction_timestamp, '') DESC) AS rn FROM metadata) WHERE rn = 1) "
    f"SELECT a.source_file AS source_key, a.title, a.year, CASE WHEN starts_with(x, '10.') THEN x END AS doi, array_to_string(CASE WHEN len(o.own) > 0 THEN o.own ELSE coalesce(a.keywords, []) END, '|') AS keywords, a.primary_discipline.level1 AS level1, o.abstract, o.introduction FROM (SELECT *, rtrim(regexp_replace({strip('doi')}, '(?i)^(?:https?://(?:dx\\.)?doi\\.org/|doi:\\s*)', ''), '.,;)') AS x FROM answers) a JOIN own o ON a.source_file = o.source_key WHERE {strip(chr(99) + 'oalesce(a.title, ' + chr(39) + chr(39) + ')')} <> ''",
)
def k10_assembled(spark, d):
    answers = M.current(table(spark, d, "metadata")).select(F.col("source_file").alias("source_key"), "title", "year", "doi", "keywords", "primary_discipline")
    out = M.assemble(answers, M.cascade(table(spark, d, "documents")))
    return out.select("source_key", "title", "year", "doi", F.array_join("keywords", "|").alias("keywords"), F.col("primary_discipline.level1").alias("level1"), "abstract", "introduction")


@query("q03_group_prompts", _prompts_sql())
def q03_group_prompts(spark, d):
    p = P.group_prompts(_docs(spark, d).drop("doc_id").where("text IS NOT NULL"), P.group_table(spark))
    return p.select("source_key", "grp", "view", F.length("prompt").alias("chars"))


@query("q06_groups", f"SELECT ord, grp, array_to_string(types, '+') AS types, tables FROM {_groups_sql()}")
def q06_groups(spark, d):
    return P.group_table(spark, tuple(full for full, _, _ in P.GROUPS)).withColumn("types", F.array_join("types", "+"))


@query("l06_group_order", f"SELECT e.doc_id, g.grp, count(*) AS entries, row_number() OVER (PARTITION BY e.doc_id ORDER BY g.ord) AS place FROM (SELECT DISTINCT entry_id, doc_id, type FROM entry) e JOIN {_groups_sql()} g ON list_contains(g.types, e.type) WHERE g.grp IN ('GA_study_design', 'G1_concept_relation', 'GC_concept', 'G4_quant_perf', 'GCA_claim') GROUP BY e.doc_id, g.grp, g.ord")
def l06_group_order(spark, d):
    """The groups whose types a paper's entries have, in the order in which their results are put together."""
    from pyspark.sql.window import Window

    g = P.group_table(spark, ("claim", "quant_perf", "concept_relation", "nothing", "study_design", "concept")).select("ord", "grp", F.explode("types").alias("type"))
    e = table(spark, d, "entry").select("entry_id", "doc_id", "type").distinct().join(F.broadcast(g), "type")
    n = e.groupBy("doc_id", "ord", "grp").agg(F.count("*").alias("entries"))
    return n.withColumn("place", F.row_number().over(Window.partitionBy("doc_id").orderBy("ord"))).drop("ord")


@query("q04_group_choice", "SELECT i AS choice, grp FROM (VALUES (0, 'GA_study_design'), (0, 'GB_results_claims'), (1, 'GR_relation'), (1, 'GCA_claim'), (3, 'GX_custom_1'), (3, 'GX_custom_0'), (4, 'GX_custom_0')) AS t(i, grp)")
def q04_group_choice(spark, d):
    """P-13, T-25: choices by short and full names, with unknown ones, and specs with unknown types."""
    chosen = (P.group_table(spark), P.group_table(spark, ("claim", "GR_relation", "nothing")), P.group_table(spark, ("nothing",)), P.group_table(spark, spec="claim+none|nothing|concept"), P.group_table(spark, spec="dataset"))
    out = None
    for i, g in enumerate(chosen):
        g = g.select(F.lit(i).alias("choice"), "grp")
        out = g if out is None else out.unionByName(g)
    return out


@query("n01_recover_json", "SELECT event_id, props AS json FROM events")
def n01_recover_json(spark, d):
    """Replies around the events' JSON: in a fence, in prose, compact with a quoted brace before it, in a plain fence, and as it is."""
    e = table(spark, d, "events")
    k = F.pmod("event_id", F.lit(5))
    reply = F.when(k == 3, F.concat(F.lit("```\n"), F.replace("props", F.lit(" "), F.lit("")), F.lit("\n``` done"))).when(k == 4, F.concat(F.lit("\n\n"), F.replace("props", F.lit(": "), F.lit(" :\n")), F.lit("\n} trailing"))).when(k == 0, F.concat(F.lit("Here:\n```json\n"), "props", F.lit("\n```"))).when(k == 1, F.concat(F.lit("It is "), "props", F.lit(" I think"))).otherwise(F.col("props"))
    return e.select("event_id", jsonfix.recover_json(reply).alias("json"))
