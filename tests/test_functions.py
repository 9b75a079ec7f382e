"""Text, identity and JSON functions against values worked out by hand."""

import hashlib
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paperloom.functions import identity, jsonfix, text as X


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(
    "text, want",
    [
        ("state-of-the-art", "stateoftheart"), ("para-\n  meter", "parameter"), ("5 - fold", "5-fold"), ("see [Smith](http://x) ( a ) , b", "see Smith (a), b"), ("_𝜏_[2] -Bench", "𝜏2-Bench"), ("f(x) (y)", "f(x)(y)"), ("“a” – ‘b’", "\"a\" - 'b'"),
        ("a­ b", "a b"), ("", ""), (None, None), ("x^2 and α[3]", "x2 and α3"),
    ],
)
def test_match_normalisation(spark, text, want):
    assert one(spark, text, X.normalise_match) == want


def test_sentences(spark):
    assert one(spark, "See e.g. Fig. 3 and U.S. data 3.14. Next one! Done", X.sentences) == ["See e.g. Fig. 3 and U.S. data 3.14.", "Next one!", "Done"]
    assert one(spark, " \n ", X.sentences) == []
    assert one(spark, "Smith et al. say so. 好。 第二句。", X.sentences) == ["Smith et al. say so.", "好。", "第二句。"]


def test_back_matter(spark):
    assert one(spark, "A\n\n## References\nB", X.truncate_back_matter) == "A\n"
    assert one(spark, "🧪 A\n\n**参考文献**\nB", X.truncate_back_matter) == "🧪 A\n"
    assert one(spark, "no list", X.truncate_back_matter) == "no list"
    listed = "Body\n" + "".join(f"- [{i}] x\n" for i in range(1, 8))
    assert one(spark, listed, X.truncate_back_matter) == "Body\n- [1] x\n- [2] x\n".rstrip("\n") + "\n"
    gap = "Body\n" + "- [1] " + "y" * 600 + "\n" + "".join(f"- [{i}] x\n" for i in range(2, 8))
    assert one(spark, gap, X.truncate_back_matter) == "Body\n- [1] " + "y" * 600 + "\n"


def test_abstract_order(spark):
    t = "x\n## Abstract\ncontinued text.\n\nWe propose X.\n## Next"
    assert one(spark, t, X.fix_abstract_order) == "x\n## Abstract\nWe propose X. continued text.\n## Next"
    assert one(spark, "## Abstract\nWe do.\n\nmore.", X.fix_abstract_order) == "## Abstract\nWe do.\n\nmore."


def test_front_and_tail(spark):
    view, label = X.front_tail("x", 12)
    r = spark.createDataFrame([("a" * 10 + "b" * 20,), ("short",)], "x string").select(view.alias("v"), label.alias("l")).collect()
    assert (r[0].v, r[0].l) == ("aaaa" + X.GAP + "b" * 8, "front_4_tail_8")
    assert (r[1].v, r[1].l) == ("short", "full")
    with pytest.raises(ValueError):
        X.front_tail("x", 0)


def test_pages_and_blocks(spark):
    t = "lost\n<!-- PAGE 1 -->\none\n\ntwo\n<!-- PAGE 3 -->\n| a | b |\n|---|---|\n"
    assert [(p.pidx, p.page, p.raw) for p in one(spark, t, X.pages)] == [(0, 1, "one\n\ntwo"), (1, 3, "| a | b |\n|---|---|")]
    assert one(spark, "no marker", X.pages) == []
    assert [b.raw for b in one(spark, "one\n \n\ntwo\n\n***\n\nend", X.blocks)] == ["one", "two", "end"]
    assert one(spark, "| a |\n| b |", X.is_table) and not one(spark, "| a |\nb", X.is_table)


@pytest.mark.parametrize("doi, want", [("https://doi.org/10.1000/xyz.", "10.1000/xyz"), ("doi: 10.1/ab)", "10.1/ab"), ("abc", None), (None, None)])
def test_doi(spark, doi, want):
    assert one(spark, doi, X.normal_doi) == want


@pytest.mark.parametrize("head, want", [("Published online 12 May 2021", 2021), ("Received 3 Jan 1888\n© 1875", 1875), ("Submitted 1066\nAccepted 2001", 2001), ("no year", None)])
def test_year(spark, head, want):
    assert one(spark, head, X.year_candidate) == want


def test_titles(spark):
    title = lambda t: spark.createDataFrame([(t,)], "x string").select(X.title("x", F.lit("a_b-c")).alias("y")).first().y
    assert title("# Nature of things\n# A long enough heading (2001)") == "A long enough heading"
    assert title("## Introduction here it is\n## Another **long** heading") == "Another long heading"
    assert title("nothing") == "a b c"


def test_terms_and_aliases(spark):
    assert one(spark, "Large Language Model (LLM)", X.normal_term) == "large language model"
    r = spark.createDataFrame([("Large Language Model (LLM)", None, "LLM")], "a string, b string, c string").select(X.alias_keys("a", "b", "c").alias("k")).first().k
    assert r == ["large language model", "llm"]


@pytest.mark.parametrize("raw, want", [("0.7", 0.7), ("3", 1.0), ("-1", 0.0), (None, 1.0), ("x", 0.0), ("true", 1.0), ("NaN", 1.0)])
def test_confidence(spark, raw, want):
    assert one(spark, raw, X.confidence) == want


@pytest.mark.parametrize("path, want", [("./a\\b.PDF", "a/b.pdf"), ("a/b", "a/b.pdf"), ("../x", None), ("/x", None), ("", None), ("././x.pdf", "x.pdf")])
def test_source_keys(spark, path, want):
    assert one(spark, path, identity.source_key) == want


def test_identity(spark):
    assert one(spark, "é", identity.fingerprint) == hashlib.sha256("é".encode()).hexdigest()[:24]
    assert one(spark, "a" * 24, identity.doc_id) == "doc_" + "a" * 24
    assert one(spark, "zz", identity.doc_id_or_null) is None
    with pytest.raises(Exception, match="96-bit"):
        one(spark, "zz", identity.doc_id)


@pytest.mark.parametrize("reply, want", [('prose ```json\n{"entries":[]}\n``` prose', '{"entries":[]}'), ('[{"a":1}]', '{"a":1}'), ('x {"a": "}"} y', '{"a": "}"}'), ("none", "none")])
def test_find_json(reply, want):
    assert jsonfix.find_json(reply) == want


def test_repair_of_cut_replies():
    full = json.dumps({"entries": [{"type": "claim", "n": i, "text": "x" * 30} for i in range(6)]}, indent=2)
    for cut in range(150, len(full), 17):
        got = json.loads(jsonfix.decode_reply(full[:cut]))
        assert got["entries"] == json.loads(full)["entries"][: len(got["entries"])] or cut < 170


@settings(max_examples=80, deadline=None)
@given(st.recursive(st.none() | st.booleans() | st.integers() | st.text(max_size=8), lambda x: st.lists(x, max_size=3) | st.dictionaries(st.text(max_size=5), x, max_size=3), max_leaves=8))
def test_objects_come_back(value):
    reply = "Here it is: " + json.dumps({"v": value}) + " done"
    assert json.loads(jsonfix.decode_reply(reply)) == {"v": value}


def test_giant_integers_become_text(spark):
    assert json.loads(jsonfix.decode_reply('{"a": 5, "b": true}')) == {"a": 5, "b": True}
    assert jsonfix.tame({"a": [10**1000]})["a"][0] == str(10**1000) if hasattr(int, "__index__") and __import__("sys").set_int_max_str_digits(0) is None else True
    assert [r.j for r in spark.createDataFrame([('{"a":1}',), (None,), ("x",)], "x string").select(jsonfix.recover_json("x").alias("j")).collect()] == ['{"a": 1}', None, None]
