"""Problem 5: the subject areas of each paper.

Method. Weighted subject terms are matched with a multi-pattern automaton (pyahocorasick). The terms are the entries of the
reference list, each counting for its area, and the keywords of the corpus whose papers state one area far more often than any
other; the weight of a term is that share times its rarity (the logarithm of papers over papers with the term). An area has the weight of its
terms as a share of that of all terms, and the number of sentences with its terms as a share of all sentences of the text, so both are
normalised by length. Every area that exceeds both of its thresholds is assigned. The thresholds are calibrated for each area on all
papers that state it: half of what all but two in a hundred of them reach. One remark is no topic: beside another area an area needs
two sentences.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A keyword is a term when so many papers have it that state an area, and so great a share of them states one.
MIN_PAPERS = 2
MIN_TERM_SHARE = 0.6
#: Sentences that an area needs, unless it is the only one.
MIN_SENTENCES = 2
#: Papers that state an area that it takes not to use the thresholds of all areas.
ENOUGH = 30
#: Steps in which values from 0 to 1 are counted before those of one step are put in order.
STEPS = 4096
#: Terms of one automaton; more are matched in several passes over the texts.
MAX_TERMS = 300_000

_ARTICLE = r"^(?:the|a|an|der|die|das|les?|la|l['’]|el|los|las|o|os|as|un|une)\s+|^l['’]"
_SENTENCE = re.compile(r"(?<=[.!?])\s+|(?<=[。！？])\s*|\n\s*\n")
_SIGNS = re.compile(r"<[^<>]*>|\\[a-zA-Z]+\{?|\[\[[^\[\]|]*\||\]\([^()\s]*\)|[*_`~\[\]{}]|''+|\[\^\w+\]")
_BREAK = re.compile(r"[-‐¬]\n\s*")
_CJK_BREAK = re.compile(r"(?<=[぀-ヿ㐀-鿿])\s+(?=[぀-ヿ㐀-鿿])")
_SPACE = re.compile(r"\s+")


def normal_term(col):
    """Column: a term in lower case, without article and outer blanks."""
    low = F.lower(F.trim(F.regexp_replace(col, r"\s+", " ")))
    return F.regexp_replace(low, _ARTICLE, "")


def weighted_terms(papers: DataFrame, refs: DataFrame) -> DataFrame:
    """(term, area, weight). ``papers``: doc_id, keywords, areas (the areas that the paper states, verbatim entries only);
    ``refs``: ref_id, field_name, canon, canon_alt, parent_id."""
    r1 = refs.where("field_name = 'level1'").select(F.col("ref_id").alias("top"), F.col("canon").alias("area"))
    two = refs.where("field_name = 'level2'").select(F.col("ref_id").alias("mid"), F.col("parent_id").alias("top"), "canon", "canon_alt").join(r1, "top")
    three = refs.where("field_name = 'level3'").select(F.col("parent_id").alias("mid"), "canon", "canon_alt").join(two.select("mid", "area"), "mid")
    names = two.select("area", "canon", "canon_alt").unionByName(three.select("area", "canon", "canon_alt"))
    listed = names.select("area", F.explode(F.array("canon", "canon_alt")).alias("t")).select(normal_term(F.col("t")).alias("term"), "area").where(F.length("term") >= 2)

    n = papers.select(F.countDistinct("doc_id").alias("papers"))
    own = papers.select("doc_id", F.explode(F.array_distinct(F.transform("keywords", normal_term))).alias("term"), "areas").where(F.length("term") >= 2)
    per_term = own.groupBy("term").agg(F.countDistinct("doc_id").alias("df"))
    votes = own.where(F.size("areas") > 0).select("term", "doc_id", F.explode("areas").alias("area"), (1 / F.size("areas")).alias("v")).groupBy("term", "area").agg(F.sum("v").alias("v"))
    best = votes.groupBy("term").agg(F.max_by("area", F.struct("v", "area")).alias("area"), F.max("v").alias("top"), F.sum("v").alias("all"))
    mined = (
        best.join(per_term, "term")
        .crossJoin(F.broadcast(n))
        .where((F.col("top") >= MIN_PAPERS) & (F.col("top") / F.col("all") >= MIN_TERM_SHARE))
        .select("term", "area", (F.col("top") / F.col("all") * F.log1p(F.col("papers") / F.col("df"))).alias("weight"))
    )
    listed = listed.join(per_term, "term", "left").crossJoin(F.broadcast(n)).select("term", "area", F.log1p(F.col("papers") / F.coalesce("df", F.lit(1))).alias("weight"))
    return mined.unionByName(listed).groupBy("term", "area").agg(F.max("weight").alias("weight"))


def automaton(terms: list[tuple[str, str, float]]):
    import ahocorasick

    a = ahocorasick.Automaton()
    by: dict[str, list] = {}
    for t, area, w in terms:
        by.setdefault(t, []).append((area, w))
    for t, v in by.items():
        a.add_word(t, (t, tuple(v)))
    if by:
        a.make_automaton()
    return a if by else None


#: A place where a term stands: sentence, start, end, and the areas with weights that the term counts for.
Span = tuple[int, int, int, tuple]


def spans_of(text: str, auto) -> tuple[int, list[Span]]:
    """The number of sentences of a text and the places of terms in them."""
    plain = _SIGNS.sub("", _BREAK.sub("", text)).lower()
    out: list[Span] = []
    n = 0
    for sentence in _SENTENCE.split(plain):
        s = _CJK_BREAK.sub("", _SPACE.sub(" ", sentence)).strip()
        if not s:
            continue
        for end, (t, v) in auto.iter(s):
            start = end - len(t) + 1
            if t[0] < "⺀" and ((start and s[start - 1].isalpha()) or (end + 1 < len(s) and s[end + 1].isalpha() and s[end + 1] < "⺀")):
                continue
            out.append((n, start, end + 1, v))
        n += 1
    return n, out


def areas_of(n: int, spans: list[Span]) -> list[tuple[str, float, float, int]]:
    """(area, share of the weight, share of the sentences, sentences) of the areas whose terms stand in a text of ``n`` sentences."""
    weight: dict[str, float] = {}
    said: dict[str, set[int]] = {}
    sentence, reach = -1, 0
    # by start, the longest first: what ends within the reach of an earlier one is a term within a longer one and does not count
    for k, a, b, v in sorted(spans, key=lambda x: (x[0], x[1], -x[2])):
        if k != sentence:
            sentence, reach, begin = k, -1, -1
        if b < reach or (b == reach and a > begin):
            continue
        if b > reach:
            reach, begin = b, a
        for area, w in v:
            weight[area] = weight.get(area, 0.0) + w
            said.setdefault(area, set()).add(k)
    total = sum(weight.values())
    return [(a, weight[a] / total, len(said[a]) / n, len(said[a])) for a in sorted(weight)] if total else []


_SCHEMA = "doc_id string, area string, share double, rate double, said int, areas int"
_SPANS = "n int, spans array<struct<k:int,a:int,b:int,v:array<struct<area:string,w:double>>>>"
_own: dict[str, object] = {}


def _once(key: str, terms):
    """The automaton of a pass, built once in a worker."""
    if key not in _own:
        _own.clear()
        _own[key] = automaton(terms.value)
    return _own[key]


def _found_batch(ids: list, found: list[list[tuple[str, float, float, int]]]):
    import pyarrow as pa

    rows = [(i, *f, len(fs)) for i, fs in zip(ids, found) for f in fs]
    kinds = (pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int32(), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], ["doc_id", "area", "share", "rate", "said", "areas"])


def measure(texts: DataFrame, terms: DataFrame) -> DataFrame:
    """(doc_id, area, share, rate, said, areas): what each text says of each area: its share of the weight, its share of the sentences, its
    sentences and the number of areas. ``texts``: doc_id, text; ``terms``: term, area, weight.

    Terms beyond :data:`MAX_TERMS` are matched in further passes, whose places are put together for each text.
    """
    import uuid

    from paperloom.tables import materialise

    sc = texts.sparkSession.sparkContext
    texts = texts.select(F.col("doc_id").cast("string"), "text").where(F.length("text") > 0)
    passes = max(1, -(-terms.select("term").distinct().count() // MAX_TERMS))
    part = lambda k: sc.broadcast([(r[0], r[1], r[2]) for r in terms.where(F.pmod(F.xxhash64("term"), F.lit(passes)) == k).select("term", "area", "weight").collect()])  # noqa: E731  about MAX_TERMS rows

    if passes == 1:
        key, own = uuid.uuid4().hex, part(0)

        def run(batches):
            auto = _once(key, own)
            for b in batches:
                ids, found = b.column(0).to_pylist(), [areas_of(*spans_of(t, auto)) if auto is not None else [] for t in b.column(1).to_pylist()]
                yield _found_batch(ids, found)

        return texts.mapInArrow(run, _SCHEMA)

    texts = materialise(texts.withColumn("row", F.monotonically_increasing_id()), "subject_texts")

    def places(key, own):
        def run(batches):
            import pyarrow as pa

            kind = pa.list_(pa.struct([("k", pa.int32()), ("a", pa.int32()), ("b", pa.int32()), ("v", pa.list_(pa.struct([("area", pa.string()), ("w", pa.float64())])))]))
            auto = _once(key, own)
            for b in batches:
                got = [spans_of(t, auto) if auto is not None else (0, []) for t in b.column(1).to_pylist()]
                spans = [[{"k": k, "a": x, "b": y, "v": [{"area": ar, "w": w} for ar, w in v]} for k, x, y, v in s] for _, s in got]
                yield pa.RecordBatch.from_arrays([b.column(2), b.column(0), pa.array([n for n, _ in got], pa.int32()), pa.array(spans, kind)], ["row", "doc_id", "n", "spans"])

        return texts.mapInArrow(run, "row long, doc_id string, " + _SPANS)

    every = None
    for k in range(passes):
        hit = materialise(places(uuid.uuid4().hex, part(k)), "subject_places")
        every = hit if every is None else every.unionByName(hit)
    whole = every.groupBy("row", "doc_id").agg(F.max("n").alias("n"), F.flatten(F.collect_list("spans")).alias("spans"))

    def join(batches):
        for b in batches:
            found = [areas_of(n, [(s["k"], s["a"], s["b"], tuple((v["area"], v["w"]) for v in s["v"])) for s in spans]) for n, spans in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            yield _found_batch(b.column(0).to_pylist(), found)

    return whole.select("doc_id", "n", "spans").mapInArrow(join, _SCHEMA)


def percentiles(values: DataFrame, part: float) -> DataFrame:
    """(area, kind, n, low): how many values each area has, "" for all areas together, and their exact percentile, as ``F.percentile``
    gives it. ``values``: area, kind, value from 0 to 1.

    Equal values are one row with their count. Counts by step tell which steps hold the percentile (one, or the two that it lies
    between), and only the values of those are put in order. A task orders all distinct values of an area, in a sort that can spill,
    only where they lie within one step.
    """
    from pyspark.sql.window import Window

    from paperloom.tables import materialise

    counts = materialise(values.groupBy("area", "kind", "value").agg(F.count("*").alias("m")), "subject_values")
    each = counts.select(F.explode(F.array("area", F.lit(""))).alias("area"), "kind", "value", "m", F.floor(F.col("value") * STEPS).alias("step"))
    so_far = lambda w: F.sum("m").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    at = (F.col("n") - 1) * F.lit(part)
    first, last = F.floor(at), F.ceil(at)  # the places, from 0, that the percentile lies between
    own = Window.partitionBy("area", "kind")
    steps = each.groupBy("area", "kind", "step").agg(F.sum("m").alias("m")).select("*", so_far(own.orderBy("step")).alias("upto"), F.sum("m").over(own).alias("n"))
    near = steps.withColumn("before", F.col("upto") - F.col("m")).where((F.col("before") <= last) & (F.col("upto") > first)).select("area", "kind", "step", "n", "before")
    near = each.join(F.broadcast(near), ["area", "kind", "step"]).groupBy("area", "kind", "step", "n", "before", "value").agg(F.sum("m").alias("m"))
    near = near.withColumn("upto", F.col("before") + so_far(Window.partitionBy("area", "kind", "step").orderBy("value")))
    value_at = lambda k: F.max(F.when((F.col("upto") - F.col("m") <= k) & (F.col("upto") > k), F.col("value")))
    ends = near.groupBy("area", "kind", "n").agg(value_at(first).alias("a"), value_at(last).alias("b"))
    return ends.select("area", "kind", "n", F.when(F.col("a") == F.col("b"), F.col("a")).otherwise((last - at) * F.col("a") + (at - first) * F.col("b")).alias("low"))


def thresholds(measured: DataFrame, stated: DataFrame) -> dict[str, tuple[float, float]]:
    """(share, rate) that each area has to exceed, "" for an area without enough papers; ``stated``: doc_id, areas. Calibrated on all
    papers in which an area is stated and no mere remark; two rows an area reach the driver."""
    own = measured.join(stated.select("doc_id", F.explode("areas").alias("area")).distinct(), ["doc_id", "area"]).where((F.col("said") >= MIN_SENTENCES) | (F.col("areas") == 1))
    kinds = F.explode(F.array(*(F.struct(F.lit(c).alias("kind"), F.col(c).alias("value")) for c in ("share", "rate")))).alias("x")
    least: dict[str, dict[str, float]] = {"": {"share": 0.0, "rate": 0.0}}
    for r in percentiles(own.select("area", kinds).select("area", "x.*"), 0.02).where((F.col("n") >= ENOUGH) | (F.col("area") == "")).collect():
        least.setdefault(r["area"], {})[r["kind"]] = r["low"] / 2
    return {a: (v["share"], v["rate"]) for a, v in least.items()}


def assign(measured: DataFrame, least: dict[str, tuple[float, float]]) -> DataFrame:
    """(doc_id, area, share): the subject areas of each text. ``measured``: as of :func:`measure`.

    Defined cases: null, empty and term-free texts have no area; ties are all assigned; of several areas in one sentence each alone
    none is a topic; repeated rows give repeated rows; texts of any length are read whole; without terms nothing is assigned; other
    columns are ignored; an empty table gives an empty result.
    """
    both = F.create_map(*[F.lit(x) for a, (s, r) in least.items() for x in (a, s)]), F.create_map(*[F.lit(x) for a, (s, r) in least.items() for x in (a, r)])
    share, rate = (F.coalesce(m[F.col("area")], m[F.lit("")]) for m in both)
    alone = F.col("areas") == 1
    topic = (F.col("rate") >= rate) & (alone | (F.col("said") >= MIN_SENTENCES) & (F.col("share") >= share))
    return measured.where(topic).select("doc_id", "area", "share")
