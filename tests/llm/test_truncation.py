import random

from paperloom.llm import truncation


def test_copies_equal_brute_force(spark):
    """Strict prefixes of any length, those on the rungs and beyond the last one too, against all pairs."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("ab") for _ in range(rng.randint(1, 4)))
    sents = {}
    for _ in range(120):
        s = " ".join(word() for _ in range(rng.randint(1, 60))) + "."
        sents[s] = rng.randint(1, 3)
    some = list(sents)
    needles = {s[: rng.choice((1, 2, 7, 15, 16, 17, 31, 32, 33, 63, 64, 65, 127, 128))] for s in some for _ in range(3)} | set(some[:20]) | {"zz", "a" * 40, some[0] + "x"}
    want = {}
    for t in needles:
        longer = [s for s in some if s.startswith(t) and len(s) > len(t)]
        if longer:
            want[t] = sum(sents[s] for s in longer)
    a = spark.createDataFrame(list(sents.items()), "key string, n long")
    b = spark.createDataFrame([(t,) for t in needles], "text string")
    assert {r.text: r.copies for r in truncation._copies(a, b).collect()} == want
    assert truncation._copies(a.limit(0), b).count() == 0 and truncation._copies(a, b.limit(0)).count() == 0


def _cut(spark, texts):
    df = spark.createDataFrame([(k, "introduction", t, "x") for k, t in texts.items()], "record_id string, field_name string, text string, copies string")
    return sorted(r.record_id for r in truncation.find_cut(df).collect())


LONG = "The effect of the treatment remained stable in all groups that we could follow over the whole period of the study, and it did not depend on the age of the persons."


def test_whole_tail_is_compared(spark):
    """A tail is a strict prefix of a longer copy in every length; one that only begins alike is none."""
    base = {f"b{i}": LONG + " It rained." for i in range(3)}
    cut = {f"c{n}": "It rained. " + LONG[:n] for n in (1, 3, 15, 16, 17, 40, 100, len(LONG) - 1)}
    whole = {"w1": "It rained. The effects are listed below", "w2": "It rained. " + LONG, "w3": "It rained.\nTable 2. Means"}
    assert _cut(spark, base | cut | whole) == sorted(cut)


def test_line_at_many_ends_is_no_cut(spark):
    """What stands at more ends than sentences begin with it is a line of its own, however many copies there are."""
    base = {f"b{i}": "It rained. Keywords: data and methods were listed by the authors." for i in range(3)}
    ends = {f"e{i}": f"It rained {i} days.\n\nKeywords: data" for i in range(9)}
    assert _cut(spark, base | ends) == []


def test_doubtful_points(spark):
    base = {f"b{i}": "The error fell by 3.5 percent. The groups were equal (p = 0.18). The size was kept at 0.4. Runs differ, i.e. by seed." for i in range(3)}
    cut = {"c1": "It rained. The error fell by 3.", "c2": "It rained. A new sentence of its own (p = 0.", "c3": "It rained. Runs differ, i.e.", "c4": "It rained. Other sites, e.g.", "c5": "It rained. The same:", "c6": "It rained. Th�"}
    whole = {"w1": "It rained. The size was kept at 0.4.", "w2": "It rained. The size was kept at 0.", "w3": "It rained (see Table 3)", "w4": "[14]", "w5": ""}
    got = _cut(spark, base | cut | whole)
    assert [k for k in got if k[0] == "c"] == sorted(cut)
    assert [k for k in got if k[0] == "w"] == ["w2"]  # "0." is a strict prefix of "0.4." in a copy


def test_slot_without_a_copy(spark):
    """A sentence that differs in a place has its first half shared."""
    base = {f"b{i}": f"The effect of the long treatment remained stable after {w} had been controlled for." for i, w in enumerate(("age", "income", "weight"))}
    assert _cut(spark, base | {"c": "It rained. The effect of the long treatment remained stable after shoe size had b"}) == ["c"]


def test_fields_and_residue(spark):
    df = spark.createDataFrame([("d", "char_count", "Page not found\nReload (", "x"), ("n", "char_count", None, "x"), ("m", None, LONG + " It (", "x")], "record_id string, field_name string, text string, n string")
    assert [(r.record_id, r.field_name) for r in truncation.find_cut(df).collect()] == [("m", None)]
