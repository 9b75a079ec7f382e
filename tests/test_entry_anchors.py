"""The evidence queries over the anchors of entries, in a folder of small tables."""

import pytest

from paperloom.plans import registry

TEXT = "<!-- PAGE 1 -->\n\nWe use a CNN. It works well.\n\nTable 1 Scores\n\n| model | score |\n|---|---|\n| CNN | 91 |\n\n<!-- PAGE 2 -->\n\nThe last page says so."
ENTRIES = [("e1", "d1", "method", "use a CNN"), ("e2", "d1", "result", "| CNN | 91 |"), ("e3", "d1", "claim", "last page"), ("e3", "d1", "claim", "last page"), ("e4", "d1", "claim", "is nowhere"), ("e5", "d_without_paper", "claim", "use a CNN"), ("e6", "d1", "claim", None)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("tables"))
    for name, rows, schema in (
        ("documents", [(1, "p.pdf", TEXT)], "doc_id long, source_key string, text string"),
        ("metadata", [("d1", "p.pdf", None)], "doc_id string, source_file string, abstract string"),
        ("entry", [(i, p, t, (a,)) for i, p, t, a in ENTRIES], "entry_id string, doc_id string, type string, evidence struct<anchor_text:string>"),
    ):
        spark.createDataFrame(rows, schema).write.parquet(f"{d}/{name}.parquet")
    return d


def test_every_anchor_is_expanded(spark, folder):
    got = {r.entry_id: (r.match_method, r.page, r.source_kind) for r in registry.QUERIES["e05_expand"](spark, folder).collect()}
    assert got == {"e1": ("exact", 1, "text"), "e2": ("exact", 1, "table"), "e3": ("exact", 2, "text"), "e4": ("unmatched", None, "unmatched"), "e5": ("unmatched", None, "unmatched")}


def test_every_anchor_is_located_and_audited(spark, folder):
    assert {(r.entry_id, r.page) for r in registry.QUERIES["e02_unique_fragment"](spark, folder).collect()} == {("e1", 1), ("e2", 1), ("e3", 2), ("e4", None), ("e5", None)}
    assert {(r.doc_id, r.anchor_text, r.page) for r in registry.QUERIES["e01_locate_entries"](spark, folder).collect()} == {("d1", "use a CNN", 1), ("d1", "| CNN | 91 |", 1), ("d1", "last page", 2), ("d1", "is nowhere", None), ("d_without_paper", "use a CNN", None)}
    assert {(r.entry_id, r.type, r.matched) for r in registry.QUERIES["e06_audit"](spark, folder).collect()} == {("e1", "method", True), ("e2", "result", True), ("e3", "claim", True), ("e4", "claim", False), ("e5", "claim", False)}
    a = registry.QUERIES["a08_anchor_audit"](spark, folder).first()
    assert (a.total, a.matched, a.by_source_kind) == (5, 3, "table=1,text=2,unmatched=2")
