"""Evidence: locating an anchor in its paper and expanding it to what surrounds it (E-1 to E-6, J-5, J-6, W-5 to W-10).

A paper is one row with its pages, blocks and sentences nested; anchors join it on the paper's key, so containment is tested only
within a paper and inside the JVM. The paper's structure is shuffled once, whatever the number of its anchors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions import text as X
from paperloom.operators import segments

#: Longest evidence, sentences on either side, characters of a fragment, sentences of a window.
CAP = 5000
AROUND = 5
FRAGMENT = 80
FRAGMENTS = (160, 120, 80)
WINDOW = 12
CAPTION = r"(?i)\b(?:table|fig(?:ure)?\.?)\s*\d+"
SEPARATOR = r"^\s*\|(?:\s*:?-+:?\s*\|)+\s*$"


def _first(xs: Column, kind: str, test) -> Column:
    """The first element that passes a test; the test is not made for those behind it."""
    return F.aggregate(xs, F.lit(None).cast(kind), lambda acc, x: F.when(acc.isNotNull(), acc).when(test(x), x))


def _best_in_page(p: Column, needle: Column) -> Column:
    """The block where an anchor starts on a page: shortest run of 1..4 blocks first, then the earliest; else, where only the page as a
    whole holds the anchor, the first block with its first 80 characters.

    The page as a whole is normalised only where its blocks, without what normalising takes out, hold the anchor.
    """
    norms = F.transform(p["blocks"], lambda b: b["norm"])
    n = F.size(p["blocks"])
    one = F.array_position(F.transform(p["blocks"], lambda b: F.contains(b["norm"], needle)), True).cast("int")
    runs = F.flatten(F.transform(F.sequence(F.lit(2), F.lit(4)), lambda s: F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda b: F.struct(s.alias("s"), b.alias("b")))))
    fits = lambda r: (r["b"] + r["s"] <= n) & F.contains(F.array_join(F.slice(norms, r["b"] + 1, r["s"]), " "), needle)
    may = p["raw"].contains("](") | F.contains(X.bare(F.array_join(norms, "")), X.bare(needle))
    whole = F.when(may & F.contains(X.normalise_match(p["raw"]), needle), F.array_position(F.transform(p["blocks"], lambda b: F.contains(b["norm"], F.substring(needle, 1, FRAGMENT))), True).cast("int"))
    found = lambda i: F.when(i > 0, i - 1)
    return F.coalesce(X.let(one, found), F.when(F.contains(F.array_join(norms, " "), needle), _first(runs, "struct<s:int,b:int>", fits)["b"]), X.let(whole, found))


def fragments(needle: Column, sizes: Column | None = None) -> Column:
    """The pieces of an anchor of at least 80 characters, the longest first: array of strings."""
    n = F.length(needle)
    sizes = F.reverse(F.array_sort(F.array_distinct(F.array(F.lit(FRAGMENT), F.least(F.lit(120), n), F.least(F.lit(160), n))))) if sizes is None else sizes

    def of(size: Column) -> Column:
        step = F.greatest(F.lit(20), F.floor(size / 3).cast("int"))
        starts = F.array_distinct(F.concat(F.sequence(F.lit(0), F.greatest(n - size, F.lit(0)), step), F.array(F.greatest(n - size, F.lit(0)))))
        return F.transform(starts, lambda s: F.substring(needle, s + 1, size))

    return F.when(n >= FRAGMENT, F.flatten(F.transform(F.filter(sizes, lambda s: (s >= FRAGMENT) & (s <= n)), of))).otherwise(F.array().cast("array<string>"))


def locate(anchors: DataFrame, papers: DataFrame, key: str = "source_key", anchor: str = "anchor_text") -> DataFrame:
    """E-1, E-2: the anchors with ``needle``, ``pidx``, ``bidx``, ``page`` and ``match_method`` (exact, unique_fragment, unmatched) and
    the paper's ``pages`` and ``items``. ``papers``: as of :func:`segments.structure`.

    Both sides are hashed by the paper's key and merged: a paper's structure is many times its text, and no estimate of its size is
    trusted for a broadcast. The page comes before the kind of match: a run of blocks on an early page wins over a block of a later one.
    """
    j = anchors.withColumn("needle", X.normalise_match(F.coalesce(F.col(anchor), F.lit("")))).join(papers.hint("merge"), key, "left")
    here = lambda p: X.let(_best_in_page(p, F.col("needle")), lambda b: F.when(b.isNotNull(), F.struct(p["pidx"].alias("pidx"), p["page"].alias("page"), b.alias("bidx"))))
    at = F.aggregate("pages", F.lit(None).cast("struct<pidx:int,page:int,bidx:int>"), lambda acc, p: F.when(acc.isNotNull(), acc).otherwise(here(p)))
    j = j.withColumn("__at", F.when(F.col("needle") != "", at))
    blocks = F.flatten(F.transform("pages", lambda p: F.transform(p["blocks"], lambda b, i: F.struct(p["pidx"].alias("pidx"), p["page"].alias("page"), i.alias("bidx"), b["norm"].alias("norm")))))
    hits = lambda f: F.filter(F.col("__blocks"), lambda b: F.contains(b["norm"], f))
    j = j.withColumn("__blocks", F.when(F.col("__at").isNull() & (F.length("needle") >= FRAGMENT), blocks))
    pieces = F.filter(F.transform(fragments(F.col("needle")), X.strip), lambda f: F.length(f) >= FRAGMENT)
    kind = "array<struct<pidx:int,page:int,bidx:int,norm:string>>"
    found = F.aggregate(pieces, F.lit(None).cast(kind), lambda acc, f: F.when(acc.isNotNull(), acc).otherwise(X.let(hits(f), lambda h: F.when(F.size(h) == 1, h))))
    j = j.withColumn("__piece", F.when(F.col("__blocks").isNotNull(), F.get(found, F.lit(0))))
    pick = lambda f: F.coalesce(F.col(f"__at.{f}"), F.col(f"__piece.{f}"))
    method = F.when(F.col("__at").isNotNull(), "exact").when(F.col("__piece").isNotNull(), "unique_fragment").otherwise("unmatched")
    return j.withColumns({"pidx": pick("pidx"), "bidx": pick("bidx"), "page": pick("page"), "match_method": method}).drop("__at", "__blocks", "__piece")


def _compact(raw: Column, needle: Column) -> Column:
    """T-12: the head of a table and its lines that hold the anchor; all its lines where none does."""
    lines = F.filter(F.transform(F.filter(F.split(raw, r"\R"), lambda s: X.strip(s) != ""), X.strip), lambda s: s.rlike(X.TABLE_LINE))
    rule = F.array_position(F.transform(lines, lambda s: s.rlike(SEPARATOR)), True)
    head = F.when(rule > 0, F.slice(lines, F.lit(1), rule.cast("int"))).otherwise(F.slice(lines, 1, 1))
    hits = F.filter(lines, lambda s: (needle != "") & F.contains(X.normalise_match(s), needle))
    rows = F.when(F.size(hits) == 0, lines).otherwise(F.concat(head, F.filter(hits, lambda s: ~F.array_contains(head, s))))
    return F.when(F.size(lines) == 0, X.strip(raw)).otherwise(F.substring(F.array_join(rows, "\n"), 1, CAP))


_RUN = "struct<start:int,span:int>"


def _window(raws: Column, line: Column, needle: Column) -> Column:
    """W-6: (start, span) of the shortest, then earliest run of 1..12 sentences that holds the needle; null without one.

    A run can hold it only if the run's bare sentences hold the bare needle, and so only around a place where the page's do. The run from the
    first to the last sentence of that place is tried at once. Where it fails (a hyphen at a line's end, a sign beyond a sentence) the runs
    are gone through in their order, and where the place is the only one and no bracket is about, those that go on by a sentence on either
    side: what lies behind a sentence that is not empty when bare changes nothing.
    """
    n = F.size(raws)
    holds = lambda r: F.contains(X.normalise_match(F.array_join(F.slice(raws, r["start"] + 1, r["span"]), " ")), needle)

    def place(letters: Column, b: Column, p: Column) -> Column:
        """Number of the sentence where the place at ``p`` begins, its sentences, and whether it is the only one."""
        ends = F.aggregate(line["bare"], F.struct(F.lit(0).alias("at"), F.lit(0).alias("i"), F.lit(0).alias("j")), lambda a, s: X.let(a["at"] + F.length(s), lambda e: F.struct(e.alias("at"), (a["i"] + (e < p).cast("int")).alias("i"), (a["j"] + (e < p + F.length(b) - 1).cast("int")).alias("j"))))
        return X.let(ends, lambda e: F.struct(e["i"].alias("start"), (e["j"] - e["i"] + 1).alias("span"), (~F.contains(F.substring(letters, p + 1, F.length(letters)), b)).alias("once")))

    def bounds(w: Column) -> Column:
        edge = lambda i: F.coalesce(F.get(line["bare"], i) != "", F.lit(True))
        near = w["once"] & edge(F.when(w["start"] > 0, w["start"] - 1)) & edge(w["start"] + w["span"]) & ~F.exists(raws, lambda r: r.contains("["))
        return F.when(near, F.struct(F.greatest(w["start"] - 1, F.lit(0)).alias("lo"), F.least(w["start"] + w["span"], n - 1).alias("hi"))).otherwise(F.struct(F.lit(0).alias("lo"), (n - 1).alias("hi")))

    def tried(b: Column, w: Column) -> Column:
        may = lambda r: (r["start"] + r["span"] <= n) & (line["loose"] | F.contains(F.array_join(F.slice(line["bare"], r["start"] + 1, r["span"]), ""), b))
        runs = lambda x: F.flatten(F.transform(F.sequence(F.lit(1), F.lit(WINDOW)), lambda s: F.filter(F.transform(F.sequence(x["lo"], x["hi"]), lambda i: F.struct(i.alias("start"), s.alias("span"))), lambda r: r["start"] + r["span"] <= x["hi"] + 1)))
        direct = F.when((w["once"] | (w["span"] == 1)) & (w["span"] <= WINDOW), F.array(F.struct(w["start"].alias("start"), w["span"].alias("span")))).otherwise(F.array().cast("array<struct<start:int,span:int>>"))
        of = lambda k: _first(F.when(k == 0, direct).otherwise(X.let(bounds(w), runs)), _RUN, lambda r: F.when(may(r), holds(r)).otherwise(False))
        return F.when(~F.coalesce(w["once"] & (w["span"] > WINDOW), F.lit(False)), F.aggregate(F.array(F.lit(0), F.lit(1)), F.lit(None).cast(_RUN), lambda acc, k: F.when(acc.isNotNull(), acc).otherwise(of(k))))

    def search(letters: Column, b: Column) -> Column:
        all_runs = line["loose"] | (b == "")
        at = F.when(~all_runs, X.let(F.position(b, letters), lambda p: place(letters, b, p)))
        return F.when(all_runs | F.contains(letters, b), X.let(at, lambda w: tried(b, w)))

    return F.when((needle != "") & (n > 0), X.let(F.array_join(line["bare"], ""), lambda letters: X.let(X.bare(needle), lambda b: search(letters, b))))


def expand(located: DataFrame, anchor: str = "anchor_text") -> DataFrame:
    """E-4, E-5, P-12: the located anchors with ``original_text`` and ``source_kind``.

    In a table: its caption, its head with the lines that hold the anchor, and the block after it. In a text: the sentences of the
    anchor with five on either side. Cut at 5,000 characters; an unlocated anchor stands for itself, uncut.
    """
    d = located.withColumn("__blocks", F.get("pages", F.col("pidx"))["blocks"])
    block = lambda i: F.get("__blocks", i)
    here = F.col("bidx")
    table_here = F.coalesce(block(here)["is_table"], F.lit(False))
    caption = ~table_here & F.coalesce(block(here + 1)["is_table"], F.lit(False)) & block(here)["raw"].rlike(CAPTION)
    d = d.withColumn("__table", F.when(table_here, here).when(caption, here + 1)).withColumn("source_kind", F.when(F.col("bidx").isNull(), "unmatched").when(table_here, "table").when(caption, "table_caption").otherwise("text"))
    t = F.col("__table")
    parts = F.array(
        F.when((t > 0) & block(t - 1)["raw"].rlike(CAPTION), block(t - 1)["raw"]), F.when(t.isNotNull(), _compact(block(t)["raw"], F.col("needle"))), F.when(~F.coalesce(block(t + 1)["is_table"], F.lit(True)), block(t + 1)["raw"])
    )
    d = d.withColumn("__line", F.when(F.col("pidx").isNotNull() & t.isNull(), F.get("lines", F.col("pidx"))))
    d = d.withColumn("__first", F.when(F.col("__line").isNotNull(), F.aggregate(F.slice("lines", F.lit(1), F.col("pidx")), F.lit(0), lambda a, x: a + F.size(x["bare"]))))
    d = d.withColumn("__mine", F.slice("items", F.col("__first") + 1, F.size("__line.bare"))).withColumn("__raws", F.transform("__mine", lambda s: s["raw"]))
    pieces = F.when(F.col("match_method") == "unique_fragment", fragments(F.col("needle"), F.array(*map(F.lit, FRAGMENTS)))).otherwise(F.array().cast("array<string>"))
    tries = F.concat(F.array("needle"), pieces)
    span = F.aggregate(tries, F.lit(None).cast(_RUN), lambda acc, f: F.when(acc.isNotNull(), acc).otherwise(_window(F.col("__raws"), F.col("__line"), f)))
    d = d.withColumn("__span", F.when(F.col("__line").isNotNull(), span))
    block_first = X.let(F.array_position(F.transform("__mine", lambda s: s["bidx"]), F.col("bidx")).cast("int"), lambda i: F.when(i > 0, F.col("__first") + i - 1))
    start = F.coalesce(F.col("__first") + F.col("__span.start"), block_first)
    end = F.coalesce(F.col("__first") + F.col("__span.start") + F.col("__span.span") - 1, block_first)
    lo = F.greatest(start - AROUND, F.lit(0))
    frame = F.array_join(F.transform(F.slice("items", lo + 1, end + AROUND + 1 - lo), lambda s: s["raw"]), " ")
    cut = lambda s: X.strip(F.substring(s, 1, CAP))
    text = F.when(F.col("bidx").isNull(), F.col(anchor)).when(t.isNotNull(), cut(F.array_join(parts, "\n\n"))).when(start.isNull(), cut(F.col(anchor))).otherwise(cut(frame))
    return d.withColumn("original_text", text).drop("lines", "__blocks", "__table", "__line", "__mine", "__raws", "__first", "__span")


def audit(expanded: DataFrame, keep: list[str], anchor: str = "anchor_text") -> DataFrame:
    """E-6: the audit row of each anchor."""
    return expanded.select(
        *keep, F.col(anchor).alias("anchor_text"), F.col("bidx").isNotNull().alias("matched"), "match_method", "page", "source_kind", F.length(anchor).alias("anchor_chars"), F.length("original_text").alias("evidence_chars"),
        (F.col("bidx").isNotNull() & (F.length("original_text") > F.length(anchor))).alias("expanded"),
    )


def audit_summary(rows: DataFrame) -> DataFrame:
    """A-8: number of anchors, of matched ones, rate, and histograms by kind of source and method."""
    hist = lambda c: F.map_from_entries(F.sort_array(F.collect_list(F.struct(c, "n"))))
    total = rows.agg(F.count("*").alias("total"), F.count_if("matched").alias("matched"))
    kinds = rows.groupBy("source_kind").agg(F.count("*").alias("n")).agg(hist("source_kind").alias("by_source_kind"))
    methods = rows.groupBy("match_method").agg(F.count("*").alias("n")).agg(hist("match_method").alias("by_method"))
    return total.crossJoin(kinds).crossJoin(methods).withColumn("rate", F.when(F.col("total") > 0, F.round(F.col("matched") / F.col("total"), 4)))


def locate_and_expand(anchors: DataFrame, docs: DataFrame, key: str = "source_key", anchor: str = "anchor_text") -> DataFrame:
    """The whole of it: papers cut up once, anchors located and expanded. Papers without anchors are not cut up; the texts are hashed by
    key before they are, so that the cutting is spread and the join needs no further shuffle of them."""
    wanted = docs.join(anchors.select(key).distinct(), key, "left_semi").repartition(key)
    return expand(locate(anchors, segments.structure(wanted, key), key, anchor), anchor)
