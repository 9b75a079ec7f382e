"""Text functions: Column in, Column out, all inside the JVM.

Patterns are Java's. ``(?U)`` makes ``\\s``, ``\\w`` and ``\\d`` Unicode-aware and ``(?d)`` makes the line feed the only line end, which is
how the data's producers read them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Page markers of converted papers.
PAGE_MARKER = r"(?m)(?d)^<!--\s*PAGE\s+(\d+)\s*-->\s*$"
PAGE_MARKER_ANY = r"<!--\s*PAGE\s+\d+\s*-->"
TABLE_LINE = r"^\s*\|.*\|\s*$"
GAP = "\n\n<!-- SOURCE WINDOW GAP: middle text omitted for input budget -->\n\n"

#: Abbreviations whose period ends no sentence.
ABBREVIATIONS = ("e.g", "i.e", "et al", "fig", "figs", "eq", "eqs", "sec", "secs", "tab", "table", "no", "vs", "dr", "prof")

_SYMBOL = "A-Za-zͰ-Ͽ\\x{1d400}-\\x{1d7ff}"

#: All Unicode white space and the separators U+001C to U+001F, which the data's producers count as such.
SPACES = "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def let(x: Column, *steps) -> Column:
    """``x`` through the steps one after the other; each may name its argument several times, which is computed once."""
    x = F.array(x)
    for step in steps:
        x = F.transform(x, step)
    return F.get(x, F.lit(0))


def strip(x: Column | str) -> Column:
    """Without white space at both ends (all Unicode white space, not spaces only)."""
    return F.btrim(c(x), F.lit(SPACES))


def squeeze(x: Column | str) -> Column:
    """Runs of white space as one space, none at the ends."""
    high = lambda x: (F.octet_length(x) > F.length(x)) & x.rlike("[\u1680-\u3000]")  # noqa: E731  (all that is beyond U+00A0 lies there)
    return let(
        c(x),
        lambda x: F.when(high(x), F.regexp_replace(x, r"(?U)[\s\x1c-\x1f]", " ")).otherwise(F.regexp_replace(x, r"[\t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\xa0]", " ")),
        lambda x: F.trim(F.when(x.contains("  "), F.regexp_replace(x, "  +", " ")).otherwise(x)),
    )


def drop_pictures(x: Column | str) -> Column:
    """T-1: without placeholders of omitted pictures."""
    return F.regexp_replace(c(x), r"\*\*==> picture \[.*?\] intentionally omitted <==\*\*\n?", "")


#: T-2, fixed values: headings from which on a text is back matter, in the order in which they are tried.
BACK_MATTER = (
    r"(?iU)\n#{1,2}[\s\x1c-\x1f]+\*?\*?[\s\x1c-\x1f]*(?:References?|Bibliography|参考文献|引用文献)[\s\x1c-\x1f]*\*?\*?[\s\x1c-\x1f]*\n",
    r"(?iU)\n\*?\*?[\s\x1c-\x1f]*(?:References?|Bibliography|参考文献)[\s\x1c-\x1f]*\*?\*?[\s\x1c-\x1f]*\n",
    r"(?iU)\n#{1,2}[\s\x1c-\x1f]+\*?\*?[\s\x1c-\x1f]*(?:Acknowledg(?:e?)ments?|Author[\s\x1c-\x1f]+Contributions?|Supplementary|Appendices|Data[\s\x1c-\x1f]+Availability)[\s\x1c-\x1f]*\*?\*?[\s\x1c-\x1f]*\n",
)
_NUMBERED = r"(?m)(?d)(?U)^[\s\x1c-\x1f]*[-–••*\[][\s\x1c-\x1f]*\[?\d{1,4}\]?[\s\x1c-\x1f]"


def truncate_back_matter(x: Column | str) -> Column:
    """T-2: cut at the first back-matter heading; without one, at a list of at least five numbered lines.

    The list is cut at its last line that follows a gap of more than 500 characters, else at its fifth line from the end.
    """
    x = c(x)
    tiers = [F.when(x.rlike(p), F.split(x, p, 2)[0]) for p in BACK_MATTER]
    marks = F.regexp_extract_all(x, F.lit(f"({_NUMBERED})"), F.lit(1))
    # where each numbered line starts: the lengths of what lies between them, added up
    gaps = F.transform(F.split(x, _NUMBERED), lambda s: F.length(s))
    start = lambda i: F.aggregate(F.slice(gaps, 1, i), F.lit(0), lambda a, g: a + g) + F.aggregate(F.slice(marks, 1, i - 1), F.lit(0), lambda a, m: a + F.length(m))
    n = F.size(marks)
    wide = F.array_max(F.filter(F.sequence(F.lit(2), F.greatest(n, F.lit(2))), lambda i: F.element_at(gaps, i) > 500))
    listed = F.when(n >= 5, start(F.coalesce(F.when(wide <= n, wide), n - 4)))
    return F.coalesce(*tiers, F.when(listed.isNotNull(), F.substring(x, F.lit(1), listed.cast("int"))), x)


def fix_abstract_order(x: Column | str) -> Column:
    """T-3: an abstract whose first paragraph continues a sentence gets that paragraph last; paragraphs that start in lower case
    join the one before."""
    x = c(x)
    pattern = r"(?isU)\A(.*?)(##[\s\x1c-\x1f]+\*?\*?Abstract\*?\*?[\s\x1c-\x1f]*\n)(.*?)(\n##.*|\z)"
    part = lambda i: F.regexp_extract(x, pattern, i)
    paragraphs = F.filter(F.transform(F.split(strip(part(3)), "\n\n"), strip), lambda p: p != "")
    low = lambda p: p.rlike(r"^\p{Ll}")
    turned = F.concat(F.slice(paragraphs, 2, F.greatest(F.size(paragraphs) - 1, F.lit(0))), F.slice(paragraphs, 1, 1))
    merged = F.aggregate(turned, F.lit(""), lambda a, p: F.when(a == "", p).when(low(p), F.concat(a, F.lit(" "), p)).otherwise(F.concat(a, F.lit("\n\n"), p)))
    turn = (F.size(paragraphs) >= 2) & low(paragraphs[0])
    return F.when(turn, F.concat(part(1), part(2), merged, part(4))).otherwise(x)


def strip_tables(x: Column | str) -> Column:
    """T-4: without the lines of Markdown tables."""
    return F.regexp_replace(c(x), r"(?m)(?d)^\s*\|.*\|\s*$\n?", "")


def front_tail(x: Column | str, budget: int, front: int = 10000) -> tuple[Column, Column]:
    """T-5: (view, label): the whole text if it fits, else its front and its tail around a gap marker."""
    if budget <= 0:
        raise ValueError("the budget must be positive")
    x = c(x)
    head = min(front, budget // 3)
    tail = budget - head
    cut = F.concat(F.regexp_replace(F.substring(x, 1, head), r"(?U)[\s\x1c-\x1f]+\z", ""), F.lit(GAP), F.regexp_replace(F.right(x, F.lit(tail)), r"(?U)^[\s\x1c-\x1f]+", ""))
    fits = F.length(x) <= budget
    return F.when(fits, x).otherwise(cut), F.when(fits, F.lit("full")).otherwise(F.lit(f"front_{head}_tail_{tail}"))


def normalise_match(x: Column | str) -> Column:
    """T-7: a text with typographic differences removed, for literal matching of quotations.

    Most texts lack most of what the rules are about, so a rule's sign is looked for before its pattern is tried. The patterns begin with
    that sign and look back from it, or take in what stands before it: no look-back is tried at every character.
    """
    r = F.regexp_replace
    apart = "\u00a0\u2019\u2018\u201c\u201d\u2010\u2011\u2013\u00ad"  # the last has no counterpart and is left out
    hyphens = (
        lambda x: F.when(x.rlike(r"(?U)-(?<![A-Za-z]-)\s*[A-Za-z]"), r(x, r"(?U)(\d)\s*-\s*(?=[A-Za-z])", "$1-")).otherwise(x),
        lambda x: F.when(x.contains("\n") & x.rlike(r"(?U)-\s*\n"), r(x, r"(?U)(\w)-\s*\n\s*(?=\w)", "$1")).otherwise(x),
        lambda x: r(x, r"-(?<=[A-Za-z]-)(?=[A-Za-z])", ""),
    )
    return let(
        c(x),
        lambda x: F.when((F.octet_length(x) > F.length(x)) & x.rlike("[\u00a0\u00ad\u2010-\u201d]"), F.translate(x, apart, " ''\"\"---")).otherwise(x),
        lambda x: F.when(x.contains("]("), r(x, r"\[([^\]]+)\]\([^)]+\)", "$1")).otherwise(x),
        lambda x: F.when(x.contains("["), r(x, r"\[([(){}Ͱ-Ͽ\x{1d400}-\x{1d7ff}]+)\]", "$1")).otherwise(x),
        lambda x: F.when(x.contains("*") | x.contains("_") | x.contains("`"), r(x, r"[*_`]+", "")).otherwise(x),
        lambda x: F.when(x.contains("["), r(x, rf"([{_SYMBOL}])\[(\d+)\]", "$1$2")).otherwise(x),
        lambda x: F.when(x.contains("^"), r(x, rf"([{_SYMBOL}])\^(\d+)", "$1$2")).otherwise(x),
        lambda x: F.when(x.contains("-"), let(x, *hyphens)).otherwise(x),
        squeeze,
        # only single spaces are left: those behind an opening bracket, before a closing sign and between brackets go
        lambda x: r(x, r" (?:(?<=[(\[{] )|(?!\w)(?:(?=[,.;:!?%)\]}，。；：！？])|(?<=\) )(?=\()))", ""),
    )


def bare(x: Column | str) -> Column:
    """A squeezed text without anything that T-7 takes out, puts in or changes, save links: equal for a text and its normal form, and that
    of a part is part of that of the whole. Line feeds stay."""
    return let(c(x), lambda x: F.regexp_replace(x, r"[ '\"*_`^\[\]\xad-]+", ""), lambda x: F.when(x.rlike("[\u2010-\u201d]"), F.regexp_replace(x, "[\u2010\u2011\u2013\u2018\u2019\u201c\u201d]+", "")).otherwise(x))


def is_table(block: Column | str) -> Column:
    """P-11: whether a block has at least two table lines."""
    return c(block).contains("|") & (F.size(F.filter(F.split(c(block), r"\R"), lambda line: line.rlike(TABLE_LINE))) >= 2)


def pages(x: Column | str) -> Column:
    """T-8: array of (pidx, page, raw) of the pages that markers begin; text before the first marker is ignored."""
    x = c(x)
    marker = PAGE_MARKER.replace("^<!--", "<!--(?<=^<!--)")  # the same, and its sign is looked for before the line's start is
    numbers = F.regexp_extract_all(x, F.lit(marker), F.lit(1))
    bodies = F.slice(F.split(x, marker), 2, F.greatest(F.size(numbers), F.lit(1)))
    return F.when(
        F.size(numbers) > 0,
        F.transform(F.arrays_zip(numbers.alias("n"), bodies.alias("b")), lambda p, i: F.struct(i.alias("pidx"), p["n"].cast("int").alias("page"), strip(p["b"]).alias("raw"))),
    ).otherwise(F.array().cast("array<struct<pidx:int,page:int,raw:string>>"))


def blocks(x: Column | str) -> Column:
    """T-9: array of (raw, norm) of the blocks between blank lines that are not empty once normalised."""
    parts = F.transform(F.transform(F.split(c(x), r"(?U)\n\s*\n+"), strip), lambda b: F.struct(b.alias("raw"), normalise_match(b).alias("norm")))
    return F.filter(parts, lambda b: b["norm"] != "")


def sentences(x: Column | str) -> Column:
    """T-10: the sentences of a text; periods of abbreviations, initials and decimals end none."""
    dot = "\ue000"
    r = F.regexp_replace
    # every pattern begins with the period and looks back from it; squeezed, a text has single spaces only and no line feed
    pairs, single = [a.split(".") for a in ABBREVIATIONS if "." in a], [a for a in ABBREVIATIONS if "." not in a]

    def pair(first: str, second: str):
        return lambda x: F.when(x.contains(f".{second}.") | x.contains(f".{second.upper()}."), r(x, rf"(?i)\.(?<=\b{first}\.)({second})\.", f"{dot}$1{dot}")).otherwise(x)

    lines = let(
        squeeze(x), *[pair(*p) for p in pairs],
        lambda x: r(x, rf"\.(?:(?<=(?U:\d)\.)(?=(?U:\d))|(?<=\b[A-Za-z]\.)(?=[A-Za-z]\.)|(?<=\b(?i:{'|'.join(single)})\.))", dot),
        lambda x: F.when(x.contains(dot), r(x, rf"\.(?<={dot}[A-Za-z]\.)", dot)).otherwise(x),
        lambda x: r(x, r" (?<=[.!?。！？] )", "\n"),
        lambda x: F.when(x.contains(dot), F.replace(x, F.lit(dot), F.lit("."))).otherwise(x),
    )
    return F.filter(F.split(lines, "\n"), lambda s: s != "")


def section(x: Column | str, heading: str) -> Column:
    """T-13: the body under the first ``## heading``, up to the next ``##``; null where there is none."""
    import re

    pattern = rf"(?is)##\s+\*?\*?{re.escape(heading)}\*?\*?\s*\n(.*?)(?:\n##|\z)"
    x = c(x)
    return F.when(x.rlike(pattern), strip(F.regexp_extract(x, pattern, 1)))


def unbold(x: Column | str) -> Column:
    """T-14: without Markdown bold marks."""
    return strip(F.regexp_replace(c(x), r"\*\*(.*?)\*\*", "$1"))


#: T-15, fixed values: phrases that mark a heading line as no title, and section names.
NO_TITLE = (
    "Permission to make digital or hard copies", "For personal or classroom use", "Permission to copy without fee", "Republication or systematic reproduction", "Permission to republish", "© 1991 ACM",
    "Permission to make digital", "To copy otherwise, to republish, to post on servers", "Permission of the", "This material is published", "Copyright ©", "© Copyright", "Authorized licensed use",
    "For permission to copy", "Permission is granted", "This work is licensed under", "Licensed under a Creative Commons", "Published in", "arXiv:", "doi.org", "DOI:", "FERMILAB", "preprint", "Draft",
    "Technical Report", "Chem Soc Rev", "Chem. Soc. Rev.", "Nature", "Science", "Cell", "PNAS", "JACS", "Angew", "Adv. Mater.", "Adv. Sci.", "Phys. Rev.", "IEEE", "TUTORIAL REVIEW", "REVIEW", "ARTICLE",
    "LETTER", "PERSPECTIVE", "view article online", "view journal", "download pdf", "full text", "View Article Online", "View Journal",
)
SECTION_NAMES = ("Abstract", "Introduction", "Methods", "Results", "Conclusion", "References", "Key learning points")


def _holds_any(x: Column, phrases: tuple[str, ...]) -> Column:
    low = F.lower(x)
    out = F.lit(False)
    for p in dict.fromkeys(s.lower() for s in phrases):
        out = out | low.contains(p)
    return out


def stem(key: Column | str) -> Column:
    """The file name of a key without its suffix."""
    return F.regexp_replace(F.regexp_replace(c(key), r"^.*/", ""), r"\.[^.]*$", "")


#: T-15, fixed values: notes within a title line that are taken out, in this order.
TITLE_NOTES = (r"(?iU)\bCite\s*this[:\s](?:DOI[:\s]*[0-9./]+)?", r"(?iU)\bDOI[:\s]*10\.\d{4,}/\S+")


def without_note(x: Column, pattern: str) -> Column:
    """A title line without the first note of a form: what stands on both sides of it, or the side that is long enough alone."""

    def rest(sides: Column) -> Column:
        before, after = F.get(sides, F.lit(0)), F.get(sides, F.lit(1))
        n, m = F.length(before), F.length(after)
        return F.when(F.size(sides) < 2, x).when((n > 10) & (m > 3), F.concat(before, F.lit(" "), after)).when(n > 15, before).when(m > 15, after).otherwise(x)

    return F.get(F.transform(F.array(F.transform(F.split(x, pattern, 2), strip)), rest), F.lit(0))


def title(x: Column | str, stem: Column | str) -> Column:
    """T-15: the title: the first acceptable ``# `` line without notes, else the first acceptable ``## `` line, else the file stem."""
    lines = F.split(c(x), "\n")
    bare = lambda line, n: unbold(F.regexp_replace(F.substring(line, F.lit(n), F.length(line)), "`(.*?)`", "$1"))
    h1 = F.filter(F.transform(F.filter(lines, lambda s: s.startswith("# ") & ~s.startswith("# #")), lambda s: bare(s, 3)), lambda t: (F.length(t) >= 15) & ~_holds_any(t, NO_TITLE))
    # one element and not a value that is named again and again: each step is made once
    first = F.slice(h1, 1, 1)
    note, tail = (lambda p: lambda t: without_note(t, p)), (lambda p: lambda t: F.regexp_replace(t, p, ""))
    for step in (*map(note, TITLE_NOTES), *map(tail, (r"(?U)\s+[\*†§#‡]+\s*$", r"(?U)\s+[0-9]+-[0-9]+\s*$", r"(?U)\s*\([12][0-9]{3}\)\s*$"))):
        first = F.transform(first, step)
    first = F.filter(F.transform(first, squeeze), lambda t: F.length(t) >= 10)
    h2 = F.filter(F.transform(F.filter(lines, lambda s: s.startswith("## ") & ~s.startswith("## #")), lambda s: squeeze(bare(s, 4))), lambda t: (F.length(t) >= 15) & ~_holds_any(t, SECTION_NAMES + NO_TITLE))
    return F.coalesce(F.get(first, F.lit(0)), F.get(h2, F.lit(0)), F.translate(c(stem), "_-", "  "))


def doi_candidate(x: Column | str) -> Column:
    """T-16: the first DOI after ``doi.org/``, else the first bare one within 3,000 characters."""
    x = c(x)
    linked = F.rtrim(F.regexp_extract(x, r"(?i)doi\.org/(10\.\d{4,}/\S+)", 1), F.lit("."))
    bare = F.rtrim(F.regexp_extract(F.substring(x, 1, 3000), r"(10\.\d{4,}/[^\s\"']+)", 1), F.lit(".,;:)]}"))
    return F.coalesce(F.nullif(linked, F.lit("")), F.nullif(bare, F.lit("")))


def year_candidate(x: Column | str) -> Column:
    """T-17: the year of a publication line, else of a history line, both in 1990..2030, else of a copyright sign."""
    head = F.substring(c(x), 1, 5000)
    lead = r"(?im)(?d)^\s*(?:[#*_`-]+\s*)?(?:"
    dated = [F.regexp_extract(head, lead + words + r")\b[^\n]*?(\d{4})", 1).try_cast("int") for words in (r"Date|Published|Publication\s*date|Submitted|Posted", "Received|Accepted|Revised")]
    return F.coalesce(*[F.when(y.between(1990, 2030), y) for y in dated], F.regexp_extract(head, r"©\s*(\d{4})", 1).try_cast("int"))


def abstract_candidate(x: Column | str) -> Column:
    """T-18: the abstract's section, else a loose inline one over 100 characters, else the first long line."""
    x = c(x)
    empty = lambda s: F.nullif(s, F.lit(""))
    loose = strip(F.regexp_extract(x, r"(?is)((?:\A|\n)\*?\*?_?\*?\*?\s*(?:Abstract|摘要)[:.\s]?[\s—–\-]*.*?)(?:\n\s*\n|\n##|\n# )", 1))
    lines = F.filter(F.transform(F.split(x, "\n"), strip), lambda s: (F.length(s) > 200) & ~s.startswith("#") & (F.regexp_count(s, F.lit(r"\[\d+(?:,\d+)*\]")) < 3) & ~s.contains("✉"))
    return F.coalesce(empty(section(x, "Abstract")), empty(section(x, "摘要")), F.when(F.length(loose) > 100, loose), F.get(lines, F.lit(0)))


#: T-19, fixed values: headings of introductions.
INTRODUCTIONS = ("Introduction", "I. Introduction", "I Introduction", "1. Introduction", "1 Introduction", "1\tIntroduction", "I.\tINTRODUCTION", "1.\tINTRODUCTION", "INTRODUCTION.", "1.0 Introduction")


def introduction_candidate(x: Column | str) -> Column:
    """T-19: the body under the first heading of an introduction."""
    x = c(x)
    loose = r"(?is)\A#{1,2}\s+\*?\*?\s*[IVX0-9.]*(?:Introduction|引言|Background\s*(?:&|and)\s*Summary|Background)[:.]?\*?\*?\s*\n(.*?)(?:\n##|\z)"
    return F.coalesce(*[F.nullif(section(x, h), F.lit("")) for h in INTRODUCTIONS], F.when(x.rlike(loose), strip(F.regexp_extract(x, loose, 1))))


def keywords_of(x: Column | str) -> Column:
    """T-20: the keywords of the section of that name."""
    return F.filter(F.transform(F.split(unbold(section(x, "Keywords")), "[;,]"), strip), lambda k: k != "")


def normal_doi(x: Column | str) -> Column:
    """T-21: a DOI without address or prefix; null unless it starts with ``10.``."""
    d = F.regexp_replace(strip(x), r"(?i)^(?:https?://(?:dx\.)?doi\.org/|doi:\s*)", "")
    d = F.rtrim(d, F.lit(".,;)"))
    return F.when(d.startswith("10."), d)


def normal_term(x: Column | str) -> Column:
    """T-22: a term in lower case without what stands in parentheses."""
    return strip(F.regexp_replace(F.lower(strip(x)), r"\s*\([^)]*\)", ""))


def alias_keys(*aliases: Column | str) -> Column:
    """T-23: the keys of a concept: its names and the acronyms in their parentheses, normalised, each once in order."""
    per = []
    for a in aliases:
        a = strip(F.coalesce(c(a), F.lit("")))
        inner = F.filter(F.transform(F.regexp_extract_all(a, F.lit(r"\(([^()]+)\)"), F.lit(1)), strip), lambda s: s.rlike(r"^[A-Za-z][A-Za-z0-9+_.-]{1,15}$"))
        per.append(F.transform(F.concat(F.array(a), inner), normal_term))
    return F.array_distinct(F.filter(F.concat(*per), lambda k: k != ""))


def prompt_content(x: Column | str) -> Column:
    """T-24: a text for the test whether a prompt already holds it."""
    return F.lower(squeeze(F.regexp_replace(c(x), r"[*_`#]", "")))


def confidence(x: Column | str) -> Column:
    """P-10: a confidence in 0..1 from its JSON text: absent 1.0, no number or null 0.0."""
    x = c(x)
    low = F.lower(x)
    v = F.when(low == "true", 1.0).when(low == "false", 0.0).otherwise(x.try_cast("double"))
    return F.when(x.isNull(), 1.0).when(v.isNull(), 0.0).when(F.isnan(v), 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), v)))
