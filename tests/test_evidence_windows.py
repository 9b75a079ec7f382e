"""Runs of sentences that hold an anchor (W-6): found by their place on the page, whatever its length."""

from paperloom.functions import text as X
from paperloom.operators import evidence as E


def expanded(spark, text, anchors):
    a = spark.createDataFrame([("p", x) for x in anchors], "source_key string, anchor_text string")
    return {r.anchor_text: r for r in E.locate_and_expand(a, spark.createDataFrame([("p", "<!-- PAGE 1 -->\n\n" + text)], "source_key string, text string")).collect()}


def test_wrong_starts_on_a_long_page(spark):
    """The window stands where the piece does, far down a page of 4,000 sentences."""
    s = [f"Sentence number {i} tells of thing {i * 7919 % 4001} and of nothing else." for i in range(4000)]
    anchors = ["?? " + " ".join(s[k : k + 4])[:200] for k in range(100, 3900, 400)]
    got = expanded(spark, " ".join(s), anchors)
    for k, a in zip(range(100, 3900, 400), anchors):
        assert (got[a].match_method, got[a].source_kind) == ("unique_fragment", "text")
        assert f"Sentence number {k + 1} " in got[a].original_text and f"Sentence number {k + 20} " not in got[a].original_text


def test_link_over_two_sentences(spark):
    before, after = [f"Before {c}." for c in "abcdefghijkl"], [f"After {c}." for c in "abcdefghijkl"]
    got = expanded(spark, " ".join([*before, "See [the word. More](http://x.y) done here.", *after]), ["More done here"])["More done here"]
    assert got.original_text == " ".join([*before[-5:], "See [the word. More](http://x.y) done here.", *after[:5]])


def test_hyphen_at_a_line_end(spark):
    """No run holds the word as the block has it: the block's first sentence stands for it."""
    got = expanded(spark, "One a. Two inter-\nnational b. Three c.", ["international"])["international"]
    assert (got.match_method, got.original_text) == ("exact", "One a. Two inter- national b. Three c.")


def test_digits_beyond_the_first_plane(spark):
    """T-7 as its SQL has it: a hyphen behind such a digit loses the blanks around it."""
    assert spark.createDataFrame([("\U0001d7cf - D", "1 - D")], "a string, b string").select(X.normalise_match("a"), X.normalise_match("b")).first()[:] == ("\U0001d7cf-D", "1-D")
