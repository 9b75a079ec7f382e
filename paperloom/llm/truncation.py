"""Problem 6: texts cut off by field limits or in transfer.

Method. A self-join by prefix over the sentences of all texts: a text is cut when its last sentence, which lacks its end, is a strict
prefix of longer, complete sentences elsewhere. The complete sentences are hashed by prefixes of doubling length (16, 32, 64, ...
characters, digits masked); a last sentence of n characters meets those that share its longest such prefix, and of each of them exactly
the first n characters are compared with it. So every candidate is shown to be a strict prefix of a longer copy, whatever its length,
and no pair of sentences is formed: a sentence meets the lengths that occur behind its prefix, not the texts.

* An ending counts only if at least as many longer copies hold it as records end with it: captions, keywords and notes, which also
  lack a full stop, stand at the end of many texts and begin few sentences.
* A last sentence that varies in a place (a name, a number in words) and has no copy as a whole is tried with its first half.
* An ending that only looks like an end ("i.e.", the point of a decimal number) must go on within the sentence in its copies. An
  opened bracket is tried from the bracket on, against the bracketed phrases of complete sentences.
* Where the last sign itself says that something must follow (an opening bracket, comma or colon, half a character, an abbreviation
  as "e.g."), the text is cut without comparison.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm import residue
from paperloom.llm.scan_noise import _NUMBER
from paperloom.tables import materialise

#: The shortest hashed prefix; the others are its doubles.
RUNG = 16
#: Characters that a first half must have to stand for its sentence: of alphabetic scripts and of Chinese and Japanese.
HALF = 12
HALF_CJK = 5
#: Longer copies that a first half must have.
MIN_COPIES = 2

_CJK = re.compile(r"[぀-ヿ㐀-鿿]")
#: Abbreviations that demand a continuation.
_ABBREVIATIONS = ("i.e.", "e.g.", "et al.", "Fig.", "Figs.", "vs.", "cf.", "z.B.", "d.h.", "vgl.", "p.ex.", "p. ex.", "т.е.", "см.")
_ABBREVIATED = re.compile(r"\b(?:" + "|".join(map(re.escape, _ABBREVIATIONS)) + r")\Z")
_STOP = re.compile(r"[.!?]\s+|[。！？]\s*")
_PARAGRAPH = re.compile(r"\n\s*\n")
_DIGITS = re.compile(r"\d+")
_WRAPPED = re.compile(r"[-‐¬\u00ad]\n\s*")
_CLOSERS = re.compile(r"[\"”»’'）」』)\]】]+$")
_MARK = re.compile(r"(?:\s*(?:\.\.\.|…|\[\.\.\.\]|\[…\]|[(\[（](?:continued|cont\.?|to be continued|more|未完|待续|续|suite|Fortsetzung|continúa|continua|continuação|продолжение)[)\]）]?))+$", re.I)
_END_TAGS = re.compile(r"(?:\s*</?\w[^<>]*>|\s*\\end\{\w+\*?\})+$")
_SIGNS = re.compile(r"\\(?:begin|end)\{[a-z]+\*?\}|<[^<>]*>|\]\([^()\s]*\)|\\[a-zA-Z]+\*?\{?|''+|[*_`~{}\[\]$]+")
_SPECIAL = re.compile(r"[\\<\]'*_`~{}\[$]")
_FURNITURE = re.compile(r"(?:\s*<!--[^<>]*-->)+\s*$")
_LEAD = " \t-+•/>#'\"“«0.)"
_POINT = re.compile(r"0\.$")
_PHRASE = re.compile(r"[(（][^()（）]*[)）]")
_OPENERS, _SHUTTERS = "(（[【「", ")）]】」"


def sentences(text: str) -> list[str]:
    """The sentences of a text with digits masked, markup signs and page numbers left out and wrapped lines joined."""
    out: list[str] = []
    for p in _PARAGRAPH.split(_DIGITS.sub("0", text)):
        if _SPECIAL.search(p):
            p = _SIGNS.sub("", p)
        if "\n" in p:
            p = " ".join(x for x in _WRAPPED.sub("", p).split("\n") if len(x) > 24 or not _NUMBER.fullmatch(x.strip()))
        p = " ".join(p.split())
        at = 0
        for m in _STOP.finditer(p):
            stop = m.start() + 1
            if not (p.endswith(_ABBREVIATIONS, 0, stop) and _ABBREVIATED.search(p[max(0, stop - 12) : stop])):
                out.append(p[at:stop])
                at = m.end()
        if at < len(p):
            out.append(p[at:])
    return out


def scan(text: str, copies: dict[str, int]) -> list[tuple[str, str]]:
    """Count the complete sentences of a text, and their bracketed phrases, in ``copies``; give the candidates (kind, ending) for a cut of
    its last sentence: ``tail`` (no end at all), ``closed`` (a doubtful end), ``phrase`` (an open bracket) or ``open`` (cut in any case)."""
    body = _FURNITURE.sub("", text).rstrip()
    body = _END_TAGS.sub("", body) or body
    stripped = _MARK.sub("", body)
    marked = stripped != body
    half = stripped.endswith("\ufffd")
    found = sentences(stripped.rstrip("-‐¬ \u00ad\ufffd"))
    if not found:
        return []
    last = found.pop()
    bare = _CLOSERS.sub("", last)
    shut = bare[-1:] in (".", "!", "?", "。", "！", "？")
    out: list[tuple[str, str]] = []
    if half or last[-1] in "(（[【「,，、:：;；" or last.endswith(_ABBREVIATIONS):
        out.append(("open", ""))
    elif not shut or marked or _POINT.search(bare):
        depth = at = 0
        for k, c in enumerate(last):
            if c in _OPENERS:
                depth, at = depth + 1, k
            elif c in _SHUTTERS:
                depth = max(0, depth - 1)
        if depth and at < len(last) - 1:
            out.append(("phrase", last[at:]))
        tail = last.lstrip(_LEAD)
        if any(c.isalpha() for c in tail):
            out.append(("closed" if shut and not marked else "tail", tail))
    if shut and not out:
        found.append(last)
    for s in found:
        b = _CLOSERS.sub("", s)
        if b[-1:] in (".", "!", "?", "。", "！", "？"):
            b = b.lstrip(_LEAD)
            if b:
                copies[b] = copies.get(b, 0) + 1
            if "(" in s or "（" in s:
                for q in _PHRASE.findall(s):
                    copies[q] = copies.get(q, 0) + 1
    return out


def _copies(sents: DataFrame, needles: DataFrame) -> DataFrame:
    """(text, copies, going_on) of the ``needles`` (text) that are strict prefixes of ``sents`` (key, n): how many sentences are longer, and in
    how many of them the sentence goes on where the text ends. The needles of one prefix are an array of lengths on one row."""
    n = F.length("text")
    needles = needles.select("text").distinct().withColumn("len", n)
    going = lambda s, at: ~F.substring(s, at + 1, F.lit(2)).rlike(r"^\s?(?:\p{Lu}|[぀-ヿ㐀-鿿])|^\s$")

    # endings shorter than the first rung: the few different heads of all sentences, cut at every length
    heads = sents.groupBy(F.substring("key", 1, RUNG + 2).alias("p")).agg(F.sum("n").alias("n"))
    short = heads.select("p", "n", F.explode(F.sequence(F.lit(1), F.least(F.length("p"), F.lit(RUNG)))).alias("len")).where("len < length(p) AND len < 16")
    short = short.select(F.substring("p", F.lit(1), F.col("len")).alias("text"), "n", going(F.col("p"), F.col("len")).alias("on"))
    short = short.groupBy("text").agg(F.sum("n").alias("copies"), F.sum(F.when(F.col("on"), F.col("n")).otherwise(0)).alias("going_on"))

    rung = lambda x: F.floor(F.pow(F.lit(2), F.floor(F.log2(x.cast("double"))))).cast("int")
    long_ = needles.where(F.col("len") >= RUNG).withColumn("r", rung(F.col("len")))
    lens = long_.groupBy("r", F.substring("text", F.lit(1), F.col("r")).alias("head")).agg(F.collect_set("len").alias("lens"))
    steps = F.transform(F.sequence(F.lit(4), rung_log(F.length("key"))), lambda k: F.pow(F.lit(2), k).cast("int"))
    ladder = sents.where(F.length("key") > RUNG).select("key", "n", F.explode(steps).alias("r"))
    ladder = ladder.select("r", F.substring("key", F.lit(1), F.col("r")).alias("head"), F.substring("key", F.lit(1), 2 * F.col("r") + 2).alias("p"), "n")
    ladder = ladder.join(lens, ["r", "head"]).select("p", "n", F.explode(F.filter("lens", lambda x: x < F.length("p"))).alias("len"))
    ladder = ladder.select(F.substring("p", F.lit(1), F.col("len")).alias("text"), "n", going(F.col("p"), F.col("len")).alias("on"))
    ladder = ladder.groupBy("text").agg(F.sum("n").alias("copies"), F.sum(F.when(F.col("on"), F.col("n")).otherwise(0)).alias("going_on"))
    return short.unionByName(ladder).join(needles.select("text"), "text", "left_semi")


def rung_log(length):
    """Column: the logarithm of the highest rung below a length."""
    return F.greatest(F.lit(4), F.floor(F.log2((length - 1).cast("double"))).cast("int"))


def find_cut(texts: DataFrame) -> DataFrame:
    """(record_id, field_name) of the texts that are cut. ``texts``: record_id, field_name, text.

    Defined cases: null, empty and blank texts are no cases; a text that is residue in place of a paper neither counts nor is a
    case; a record in several rows gives one row; texts and sentences of any length are read whole; a table in which no sentence occurs
    twice has only the cases whose last sign shows them; empty tables give an empty result; other columns are ignored.
    """
    schema = "kind string, record_id string, field_name string, key string, n long"

    def run(batches):
        import pyarrow as pa

        for b in batches:
            copies: dict[str, int] = {}
            kinds, ids, fields, ks = [], [], [], []
            for i, f, t in zip(*(b.column(c).to_pylist() for c in range(3))):
                if not t or (f == "char_count" and not residue.sectioned(t) and residue.looks_residue(t)):
                    continue
                for kind, key in scan(t, copies):
                    kinds.append(kind)
                    ids.append(i)
                    fields.append(f)
                    ks.append(key)
            n = [1] * len(ks) + [*copies.values()]
            none = [None] * len(copies)
            kinds += ["sentence"] * len(copies)
            yield pa.RecordBatch.from_arrays(
                [pa.array(kinds, pa.string()), pa.array(ids + none, pa.string()), pa.array(fields + none, pa.string()), pa.array([*ks, *copies], pa.string()), pa.array(n, pa.int64())],
                ["kind", "record_id", "field_name", "key", "n"],
            )

    seen = materialise(texts.select("record_id", "field_name", "text").where(F.length("text") > 0).mapInArrow(run, schema), "cut")
    sents = seen.where("kind = 'sentence'").select("key", "n")
    ids = ["record_id", "field_name"]
    ends = seen.where("kind IN ('tail', 'closed', 'phrase')").select("kind", *ids, F.col("key").alias("text")).distinct()
    # what differs is compared once, however many records end with it
    least = F.when(F.col("text").rlike("[぀-ヿ㐀-鿿]"), 2 * HALF_CJK).otherwise(2 * HALF)
    half = F.when((F.col("kind") == "tail") & (F.length("text") >= least), F.substring("text", F.lit(1), F.floor((F.length("text") + 1) / 2).cast("int")))
    per = materialise(ends.groupBy("kind", "text").agg(F.count("*").alias("records")).withColumn("half", half), "ends")
    needles = per.select("text").unionByName(per.where("half IS NOT NULL").select(F.col("half").alias("text")))
    copies = materialise(_copies(sents, needles), "copies")
    own = copies.select("text", "copies", "going_on")
    first = copies.select(F.col("text").alias("half"), F.col("copies").alias("half_copies"))
    whole = F.when(F.col("kind") == "closed", F.col("going_on")).otherwise(F.col("copies")) >= F.col("records")
    part = (F.col("half_copies") >= F.col("records")) & (F.col("half_copies") >= MIN_COPIES)
    cut = per.join(own, "text", "left").join(first, "half", "left").where(F.coalesce(whole, F.lit(False)) | F.coalesce(part, F.lit(False))).select("kind", "text")
    return ends.join(cut, ["kind", "text"], "left_semi").select(*ids).unionByName(seen.where("kind = 'open'").select(*ids)).distinct()
