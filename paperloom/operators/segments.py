"""Papers to pages, blocks and sentences (T-8 to T-11, P-11, P-12, W-9, W-10)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.functions import text as X


def pages(docs: DataFrame, key: str = "source_key", text: str = "text") -> DataFrame:
    """(key, pidx, page, raw): a row a page."""
    return docs.select(key, F.explode(X.pages(text)).alias("p")).select(key, "p.pidx", "p.page", "p.raw")


def blocks(docs: DataFrame, key: str = "source_key", text: str = "text") -> DataFrame:
    """(key, pidx, page, bidx, raw, norm, is_table): a row a block."""
    b = pages(docs, key, text).select(key, "pidx", "page", F.posexplode(X.blocks("raw")).alias("bidx", "b"))
    return b.select(key, "pidx", "page", "bidx", "b.raw", "b.norm", X.is_table(F.col("b.raw")).alias("is_table"))


def sentences(docs: DataFrame, key: str = "source_key", text: str = "text") -> DataFrame:
    """(key, sidx, pidx, bidx, raw): a row a sentence outside tables, numbered through the paper."""
    return structure(docs, key, text).select(key, F.posexplode("items").alias("sidx", "s")).select(key, "sidx", "s.pidx", "s.bidx", "s.raw")


def structure(docs: DataFrame, key: str = "source_key", text: str = "text") -> DataFrame:
    """(key, pages, items, lines): a row a paper, its pages with their blocks and its sentences nested; nothing is shuffled. ``lines`` has for
    each page the bare forms of its sentences, and whether a link goes beyond one of them, so that they tell nothing."""
    page = lambda p: F.struct(
        p["pidx"].alias("pidx"), p["page"].alias("page"), p["raw"].alias("raw"),
        F.transform(X.blocks(p["raw"]), lambda b: F.struct(b["raw"].alias("raw"), b["norm"].alias("norm"), X.is_table(b["raw"]).alias("is_table"))).alias("blocks"),
    )
    s = docs.select(key, F.transform(X.pages(text), page).alias("pages"))
    item = lambda p: F.flatten(
        F.transform(
            p["blocks"],
            lambda b, i: F.when(b["is_table"], F.array().cast("array<struct<pidx:int,bidx:int,raw:string>>")).otherwise(F.transform(X.sentences(b["raw"]), lambda t: F.struct(p["pidx"].alias("pidx"), i.alias("bidx"), t.alias("raw")))),
        )
    )
    linked = lambda r: r.contains("](")
    plain = lambda raws: F.when(F.exists(raws, linked), F.transform(raws, lambda r: F.when(linked(r), X.normalise_match(r)).otherwise(r))).otherwise(raws)
    line = lambda xs: F.struct(F.when(F.size(xs) > 0, F.split(X.bare(F.array_join(xs, "\n")), "\n")).otherwise(F.array().cast("array<string>")).alias("bare"), F.exists(xs, linked).alias("loose"))
    s = s.select(key, "pages", F.transform("pages", item).alias("__items"))
    return s.select(key, "pages", F.flatten("__items").alias("items"), F.transform("__items", lambda xs: X.let(F.transform(xs, lambda x: x["raw"]), plain, line)).alias("lines"))
