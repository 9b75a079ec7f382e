import random

import pytest
from pyspark.sql import functions as F

from paperloom.llm import canonical, langid, markup, residue, scan_noise, subjects, truncation

EN = "We repeated the measurement {} times with the new method. The effect of the treatment remained stable in all groups. Results are given as means over {} runs."
DE = "Die Ergebnisse zeigen, dass beide Faktoren eng zusammenhängen. Zwischen den Gruppen bestand kein deutlicher Unterschied."
ZH = "本文研究两种方法之间的关系，并提出一种稳健的模型。结果表明，两组之间没有显著差异。"


# --- problem 1
def _detect(spark, rows):
    df = spark.createDataFrame([(str(i), "abstract", None, p, "extra") for i, p in enumerate(rows)], "record_id string, field_name string, version string, parts array<string>, segs string")
    return [[(s.lang) for s in r.segs] for r in langid.detect(df, langid.train([])).orderBy(F.col("record_id").cast("int")).collect()]


def test_languages_and_segments(spark):
    got = _detect(spark, [[EN], [DE], [ZH], [EN + "\n" + ZH + " " + DE], [None], [], None, ["12 34 (5)"], ["the effects of the methods", None, "知识图谱", "图像分割"], [EN * 200]])
    assert got == [["en"], ["de"], ["zh"], ["en", "zh", "de"], [], [], [], [], ["en", "zh"], ["en"]]


def test_seeds_are_told_apart():
    model = langid.Profiles(langid.train([]))
    for lang, text in langid.SEEDS.items():
        pieces = [p for p in langid._UNIT.split(text) if p]
        assert [s[0] for s in langid.segments(model.costs(pieces), pieces)] == [lang]


def test_foreign_term_starts_no_segment(spark):
    assert _detect(spark, [["为了比较两种方法，我们采用LSTM与GIS两类工具。结果表明，模型在Random Forest之后依然稳健。"], [DE + " (Figure 2b)"], [EN + " `n <- 11` [14]"]]) == [["zh"], ["de"], ["en"]]


def test_distance_is_the_brute_force_one():
    ranks = langid.train([])
    model = langid.Profiles(ranks)
    text = "dass die Ergebnisse"
    d, letters = model.distances([text])
    s = " " + text.lower() + " "
    grams = [s[i : i + n] for n in (1, 2, 3) for i in range(len(s) - n + 1)]
    grams = [g for g in grams if g != " " and not (len(g) == 3 and g[1] == " ")]
    grams += [("script", c) for c in s if c != " "]
    code = lambda g: 3 << 60 | langid._letters()[1][ord(g[1])] if g[0] == "script" else [ord(g[0]), 1 << 60 | ord(g[0]) << 16 | ord(g[-1]), 0][len(g) - 1] if len(g) < 3 else 2 << 60 | ord(g[0]) << 32 | ord(g[1]) << 16 | ord(g[2])
    count = {}
    for g in grams:
        count[code(g)] = count.get(code(g), 0) + 1
    known = {g: n for g, n in count.items() if g in ranks}
    for k in range(len(langid.LANGUAGES)):
        want = sum(n * min(langid.SIZE, abs(ranks[g][k] - sum(m > n for m in known.values()))) if g in known else n * langid.SIZE for g, n in count.items()) / (langid.SIZE * len(grams))
        assert d[0][k] == pytest.approx(want, abs=1e-4)


def test_labels(spark):
    given = [("en-US", "en"), ("中文", "zh"), ("ger", "de"), ("Portuguese", "pt"), ("n/a", None), ("und", None), ("", None), (None, None), ("zh-CN", "zh"), ("日本語", "ja"), (" FR ", "fr"), ("xx", None), ("русский", "ru"), ("enx", None)]
    df = spark.createDataFrame(given, "g string, want string")
    assert [(r.got, r.want) for r in df.select(langid.normal_label(F.col("g")).alias("got"), "want").collect() if r.got != r.want] == []


def test_current_label_is_the_latest(spark):
    df = spark.createDataFrame([("a", "f", "en", "2024-01-02"), ("a", "f", "de", "2024-01-01"), ("a", "f", "en", "2024-01-02"), ("b", "f", "de", None), ("b", "f", None, "2024-01-01")], "record_id string, field_name string, lang_given string, t string").withColumn("labelled_at", F.to_timestamp("t"))
    assert {r.record_id: r.label for r in langid.current_labels(df).collect()} == {"a": "en", "b": None}


# --- problem 2
REFS = [("L1", "level2", "数据库系统", "Database systems"), ("L2", "level2", "声学", "Acoustics"), ("S1", "std_label", "SEM", "scanning electron microscopy"), ("S2", "std_label", "COD", "chemical oxygen demand"), ("M1", "method_type", "interview", "访谈"), ("M2", "method_type", "model", "模型"), ("M3", "method_type", "textual_analysis", None)]


def _map(spark, values, heads=("method_type",)):
    refs = spark.createDataFrame([(*r, None, "x") for r in REFS], "ref_id string, field_name string, canon string, canon_alt string, parent_id string, value string")
    df = spark.createDataFrame([(f, v, "clash") for f, v in values], "field_name string, value string, ref_id string")
    return {(r.field_name, r.value): r.ref_id for r in canonical.map_values(df, refs, heads).collect()}


def test_values_map_to_their_entries(spark):
    want = {
        ("level2", "Databse Systems"): "L1", ("level2", "《数据库系统》"): "L1", ("level2", "數據庫系統"): "L1", ("level2", "systems, Database"): "L1", ("level2", "数据 库系统"): "L1", ("level2", "530-48:声学"): "L2", ("level2", "the field of acoustics (main)"): "L2",
        ("level2", "Cookery"): "NONE", ("level2", "光学"): "NONE", ("level2", " "): "NONE", ("std_label", "S E M"): "S1", ("std_label", "TEM"): "NONE", ("std_label", "biochemical oxygen demand"): "NONE", ("std_label", "chemical oxyegn demand"): "S2", ("std_label", "CODs"): "S2",
        ("method_type", "expert interviews"): "M1", ("method_type", "modle"): "M2", ("method_type", "text analysis"): "M3", ("method_type", "metaphor"): "NONE", ("method_type", "x" * 5000): "NONE", ("level2", "Database systems / 数据库系统"): "L1",
    }
    got = _map(spark, [*want, ("level2", "Cookery"), ("level2", None), ("level2", "")])
    assert {k: (got.get(k), v) for k, v in want.items() if got.get(k) != v} == {}
    assert set(got) == set(want)


def test_no_values_no_rows(spark):
    assert _map(spark, [("level2", None)]) == {}


def test_pigeonhole_loses_nothing(spark):
    """Against all pairs: every value within the edits allowed finds an entry."""
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdef") for _ in range(rng.randint(8, 14))) for _ in range(25)]
    refs = spark.createDataFrame([(f"R{i:02}", "f", w, None) for i, w in enumerate(words)], "ref_id string, field_name string, canon string, canon_alt string")
    values = []
    for w in words * 4:
        v = list(w)
        for _ in range(rng.randint(1, 3)):
            k = rng.randrange(len(v))
            rng.choice((lambda: v.__setitem__(k, rng.choice("abcdef")), lambda: v.pop(k), lambda: v.insert(k, rng.choice("abcdef"))))()
        values.append("".join(v))

    def lev(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, old = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
        return row[-1]

    got = {r.value: r for r in canonical.map_values(spark.createDataFrame([("f", v) for v in values], "field_name string, value string"), refs).collect()}
    for v in set(values):
        best = min((lev(v, w), f"R{i:02}") for i, w in enumerate(words))
        if best[0] <= 2 and len(v) >= 3:
            assert got[v].edits == best[0] or v in words or v.endswith("s")


# --- problem 3
@pytest.mark.parametrize(
    "text, langs",
    [
        ("We <i>argue</i> that R&D costs stay between $5 and $10 for x < 3 and y > 2.", ["html"]), ("The parameter max_step_size was kept at {a, b, c} as in [12] and C++.", []), ("We **argue** that [this](https://a.b/c) holds.", ["markdown"]),
        ("== Results ==\nThe [[Abc|word]] is here.", ["wiki"]), (r"The value $\alpha = \frac{a}{b}$ and \emph{more} text~\cite{x2001}.", ["latex"]), ("Text &nbsp;with an entity.", ["html"]), ("Text <!-- hidden --> here.", ["html"]), ("<!-- PAGE 3 -->\nPlain text.", []),
        ("```\nx <- \\alpha_b * **c**\n```\nPlain.", ["markdown"]), ("", []), ("mean = 0.5 * (a + b)", []), ("plain " * 20000, []),
    ],
)
def test_markup_languages(text, langs):
    m = markup._Wide(markup.model())
    nodes = markup.analyse(text, m)
    assert sorted({markup.language(n, nodes) for n in nodes if n.on}) == langs


def test_markup_on_held_out_texts():
    m, rng = markup._Wide(markup.model()), random.Random(77)
    hit = wrong = missed = 0
    for _ in range(400):
        text, spans = markup._inject(rng)
        nodes = markup.analyse(text, m)
        got, want = {markup.language(n, nodes) for n in nodes if n.on}, {s[2] for s in spans}
        hit, wrong, missed = hit + len(got & want), wrong + len(got - want), missed + len(want - got)
    assert hit / (hit + wrong) > 0.95 and hit / (hit + missed) > 0.95


def test_no_markup_inside_what_stays_code():
    m = markup._Wide(markup.model())
    nodes = markup.analyse("Text.\n```\nfit = run(**kw)  # [[x]] $a_b$\n```\n", m)
    assert {n.kind for n in nodes if n.on} == {"fence"}


def test_conversion_keeps_structure(spark):
    rows = [("1", "f", "<h2>Head</h2><ul><li>one</li><li>two</li></ul><pre><code>a\nb</code></pre>", "c"), ("2", "f", None, "c"), ("3", "f", "", "c"), ("4", "f", r"Let $x^2$ be \textbf{big}.", "c")]
    df = spark.createDataFrame(rows, "record_id string, field_name string, text string, clean string")
    got = {r.record_id: r.clean for r in markup.clean(df).collect()}
    assert "## Head" in got["1"] and "- one" in got["1"] and "```\na\nb\n```" in got["1"] and "<" not in got["1"]
    assert got["2"] is None and got["3"] == "" and got["4"] == "Let $x^2$ be big."
    assert markup.clean(df.limit(0)).count() == 0


# --- problem 4
def _noise(spark, texts):
    base = [("b%d" % i, "abstract", "The measurement of modern methods is common. The measurement of well-defined methods was common.", "x") for i in range(40)]
    rows = base + [(k, "abstract", t, "x") for k, t in texts.items()]
    df = spark.createDataFrame(rows, "record_id string, field_name string, text string, noise string")
    out = {}
    for r in scan_noise.find_noise(df).collect():
        out.setdefault(r.record_id, set()).add(r.noise)
    return out


def test_noise_kinds(spark):
    got = _noise(
        spark,
        {
            "hyph": "The measure-\nment of modern\nmethods is common.", "compound": "The measurement of well-\ndefined methods was\ncommon.", "misread": "The rneasurement of modem methods. The measurcment is cornmon.", "page": "The measurement of\n- 12 -\nmodern methods is common.\nThe end.",
            "head": "The measurement of\nSmith et al. – On modern methods\nmodern methods is common.", "both": "The measurement of\n\n12    Smith    Journal of Methods\n\nmodern methods is common.", "plain": "The measurement of\nmodern methods is\ncommon.", "none": None, "empty": "",
            "table": "The measurement of\n12.4   36.0   84.2\nmodern methods is common.",
        },
    )
    assert got == {"hyph": {"hyphenation"}, "misread": {"misread"}, "page": {"page_number"}, "head": {"header"}, "both": {"header", "page_number"}}


def test_noise_of_nothing(spark):
    assert scan_noise.find_noise(spark.createDataFrame([], "record_id string, field_name string, text string")).count() == 0


def test_weighted_distance():
    assert scan_noise.distance("rneasurcment", "measurement") == pytest.approx(0.7)
    assert scan_noise.distance("measure", "measurement") > 5
    assert scan_noise.distance("same", "same") == 0


def test_candidates_meet_in_the_index():
    """Any number of confusions, in words of any length, groups next to each other too."""
    rng = random.Random(1)
    for good in ("measurement", "distributed", "reinforcement", "household", "illumination", "Beweisverwertungsverbote", "modern", "finding" * 9):
        for _ in range(60):
            bad = "".join(rng.choice([x for g, x in scan_noise.SINGLE if g == c] or [c]) if rng.random() < 0.4 else c for c in good)
            for g, x in rng.sample(scan_noise.GROUPS, 2):
                bad = bad.replace(g, x, 1)
            assert scan_noise.skeleton(bad) == scan_noise.skeleton(good)


def test_index_in_the_jvm(spark):
    words = ["measurement", "rnodem", "ﬁnding", "ILO10l", "wild", "vvi1cl", "обо", "6o0", "Zürich", "", "uuu"]
    got = spark.createDataFrame([(w,) for w in words], "w string").select("w", scan_noise.skeleton_of("w").alias("s")).collect()
    assert {r.w: r.s for r in got} == {w: scan_noise.skeleton(w) for w in words}
    filter_ = scan_noise.bits(spark.createDataFrame([(w,) for w in words], "w string"), "w")
    assert all(scan_noise.holds(filter_, w) for w in words) and sum(scan_noise.holds(filter_, f"x{i}") for i in range(1000)) < 5


def test_misread_signs_late_in_long_words(spark):
    got = _noise(spark, {f"b{i}": "Das Beweisverwertungsverbote gilt. Die Nachtragsverteilungsverfahrensordnungsentwurfsfassung gilt." for i in range(20)} | {"late": "Das Beweisverwertungsverbotc gilt.", "many": "Das Bcwcisverwertungsverbotc gilt.", "long": "Die Nachtragsverteilungsverfahrcnsordnungsentwurfsfassung gilt."})
    assert got == {k: {"misread"} for k in ("late", "many", "long")}


# --- problem 5
TERMS = [("gene editing", "bio", 1.0), ("stem cells", "bio", 1.0), ("tort liability", "law", 1.0), ("liability", "econ", 5.0), ("量子点", "phys", 1.0)]


def _measured(spark, texts, terms=TERMS):
    df = spark.createDataFrame([(*t, "clash") for t in texts], "doc_id string, text string, area string")
    return subjects.measure(df, spark.createDataFrame(terms, "term string, area string, weight double"))


def test_subject_areas(spark):
    texts = [
        ("1", "Gene editing works. We study stem cells. Gene editing again."), ("2", "Gene editing works. We study stem cells. A remark on tort liability."), ("3", "Gene editing and stem cells. Tort liability differs. Stem cells too. Tort liability is old."), ("4", None), ("5", ""), ("6", "Nothing here."),
        ("7", "本文研究量子点。"), ("8", "Generic gene editings."), ("1", "Gene editing works. We study stem cells. Gene editing again."), ("9", "Tort liability. " + "It rained on that day. " * 500),
    ]
    least = {"": (0.15, 0.1)}
    got = sorted((r.doc_id, r.area) for r in subjects.assign(_measured(spark, texts), least).collect())
    assert got == [("1", "bio"), ("1", "bio"), ("2", "bio"), ("3", "bio"), ("3", "law"), ("7", "phys")]
    assert _measured(spark, texts, TERMS[:0]).count() == 0 and subjects.assign(_measured(spark, [("1", None)]), least).count() == 0


def test_terms_of_several_passes(spark, monkeypatch):
    texts = [("1", "Gene editing and tort liability. Stem cells."), ("2", "Liability of stem cells. 量子点"), ("2", "Liability of stem cells. 量子点"), ("3", "None.")]
    one = sorted(map(tuple, _measured(spark, texts).collect()))
    monkeypatch.setattr(subjects, "MAX_TERMS", 2)
    assert sorted(map(tuple, _measured(spark, texts).collect())) == one and len(one) == 2 + 2 * 3


def test_thresholds_are_calibrated(spark):
    rows = [(f"a{i}", "bio", 0.4 + i / 1000, 0.2, 2, 2) for i in range(100)] + [(f"b{i}", "law", 0.8, 0.5, 3, 1) for i in range(5)] + [("r", "bio", 0.01, 0.01, 1, 2)]
    measured = spark.createDataFrame(rows, subjects._SCHEMA)
    stated = spark.createDataFrame([(r[0], [r[1]]) for r in rows], "doc_id string, areas array<string>")
    least = subjects.thresholds(measured, stated)
    assert set(least) == {"bio", ""} and least["bio"] == (pytest.approx(0.2, abs=0.01), pytest.approx(0.1))
    assert subjects.thresholds(measured.limit(0), stated) == {"": (0.0, 0.0)}


def test_thresholds_come_from_all_papers(spark):
    rand = random.Random(5)
    rows = [(f"a{i}", "bio", rand.random(), rand.randint(1, 9) / 9, 2, 2) for i in range(3000)]
    rows += [(f"b{i}", "law", 0.5 + i / 1e7, 0.25, 2, 2) for i in range(1000)]  # all within one step
    rows += [(f"c{i}", "econ", 0.1 if i < 10 else 0.9, 0.1 if i < 11 else 0.7, 2, 2) for i in range(500)]  # a place between two steps
    measured = spark.createDataFrame(rows, subjects._SCHEMA)
    stated = spark.createDataFrame([(r[0], [r[1]]) for r in rows], "doc_id string, areas array<string>")
    low = [(F.percentile(c, F.lit(0.02)) / 2).alias(c) for c in ("share", "rate")]
    exact = {r.area: (r.share, r.rate) for r in measured.groupBy("area").agg(*low).collect() + measured.agg(F.lit("").alias("area"), *low).collect()}
    assert subjects.thresholds(measured, stated) == exact and exact["econ"][0] == pytest.approx(0.442)


def test_terms_are_mined_by_share(spark):
    refs = spark.createDataFrame([("1", "level1", "法学", "Law", None), ("2", "level2", "知识产权法", "Intellectual property law", "1"), ("3", "level3", "专利侵权", "Patent infringement", "2")], "ref_id string, field_name string, canon string, canon_alt string, parent_id string")
    papers = spark.createDataFrame([(str(i), ["The Tort liability", "data"], ["法学"]) for i in range(5)] + [(f"x{i}", ["data", None], ["数学"]) for i in range(5)] + [("n", None, [])], "doc_id string, keywords array<string>, areas array<string>")
    got = {(r.term, r.area) for r in subjects.weighted_terms(papers, refs).collect()}
    assert got == {("tort liability", "法学"), ("知识产权法", "法学"), ("intellectual property law", "法学"), ("专利侵权", "法学"), ("patent infringement", "法学")}


# --- problem 6
def test_cut_texts(spark):
    full = "The effect of the treatment remained stable in all groups. Results are given as means over 12 runs, i.e. one per seed. The error fell by 3.5 percent."
    rows = [("f%d" % i, "introduction", full, "x") for i in range(4)]
    cut = {"a": full + " The effect of the tre", "b": full + " Results are given as", "c": full + " The e…", "d": full + " The error fell by 3", "e": full + " The same (", "g": full + " 本�"}
    whole = {"h": full + " [14]", "i": full + "\nTable 4. Mean values by group", "j": full + "\nmean = 0.5 * (a + b)", "k": full, "l": None, "m": "", "n": "  \n"}
    df = spark.createDataFrame(rows + [(k, "introduction", t, "x") for k, t in (cut | whole).items()] + [("a", "introduction", cut["a"], "y")], "record_id string, field_name string, text string, kind string")
    assert sorted(r.record_id for r in truncation.find_cut(df).collect()) == sorted(cut)
    assert truncation.find_cut(df.limit(0)).count() == 0


# --- problem 9
def test_residue_documents(spark):
    paper = "# A title\n\n## Abstract\n\n" + EN.format(3, 4) + "\n\n## Results\n\nAs a control, readers saw lorem ipsum blocks. The form letters contain slots such as {{name}}, which were filled in."
    docs = {i: paper for i in range(20)} | {
        100: "Please enable JavaScript to continue.", 101: "# A title\n\nPage not found\nReload", 102: "By {{author}} and {{title}}\n# {{body}}\n\n© The publisher.", 103: "asdf " * 50, 104: "Solmet prandi silpe dumet edisca lundar. Vulpo calit dumet mollar tuscia.",
        200: "The effect of the treatment remained stable in all groups.", 201: None, 202: "", 203: " \n", 204: "<!-- PAGE 1 -->\n# Only a title", 205: paper[:120],
    }
    df = spark.createDataFrame([(k, v, "x") for k, v in docs.items()] + [(100, docs[100], "x")], "doc_id long, text string, residue string")
    got = residue.classify(df).collect()
    assert sorted(r.doc_id for r in got if r.residue) == [100, 101, 102, 103, 104]
    assert len(got) == len({r.doc_id for r in got})
    assert residue.classify(df.limit(0)).count() == 0


def test_repair(spark):
    base = [("b%d" % i, "abstract", "The measurement of modern methods is common. The measurement of well-defined methods was common.") for i in range(40)]
    texts = [
        ("a", "abstract", "The measure-\nment of modcrn\n- 12 -\nmethods is cornmon. The\n\nSmith et al. – On modern methods\n\nrneasurement of well-\ndefined methods was common."), ("n", "abstract", None), ("e", "abstract", ""),
        ("p", "abstract", "The measurement\nof modern methods is common.\n\nThe measurement of methods was common."),
    ]
    df = spark.createDataFrame(base + texts, "record_id string, field_name string, text string")
    got = {r.record_id: r.repaired for r in scan_noise.repair(df).collect()}
    assert got["a"] == "The measurement of modern methods is common. The measurement of well-defined methods was common."
    assert got["n"] is None and got["e"] == "" and got["b0"] == base[0][2]
    assert got["p"] == "The measurement of modern methods is common.\n\nThe measurement of methods was common."


def test_slots_and_headings_of_any_length(spark):
    """A slot far inside a long sentence marks its template; a heading is none of the text however long it is."""
    far = "The values that we " + "list and compare " * 40 + "were taken from {{table}} of the report."
    assert residue.tree_path(far)[0].startswith("§") and not residue.tree_path(far.replace("{{table}}", "a table"))[0].startswith("§")
    assert residue.units("# " + "A long title " * 40 + "\nA sentence.") == ["A sentence."]
    paper = "# A title\n\n## Abstract\n\n" + EN.format(3, 4)
    docs = [(i, paper) for i in range(20)] + [(100, paper + " " + far)]
    got = {r.doc_id: (r.residue, r.open_slots) for r in residue.classify(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got[100][0] is False and got[0] == (False, False)
