"""From converted papers over metadata and entries to a retry of failed groups, through the command line."""

import zipfile

from paperloom import cli
from paperloom.operators.prompts import Reply
from paperloom.sources import snapshots

META = '{"title": "A CNN", "year": "2020", "doi": "https://doi.org/10.1/x.", "keywords": ["cnn"], "primary_discipline": {"level1": "数学", "level2": " "}, "secondary_disciplines": {"level1": "力学"}}'
CONCEPT = '{"entries": [{"type": "concept", "payload": {"term": "CNN"}, "evidence": {"anchor_text": "use a CNN"}}]}'
CLAIM = '{"entries": [{"type": "claim", "payload": {"claim": "It works", "statement": "It works", "text": "It works", "content": "It works"}, "evidence": {"anchor_text": "works well"}}]}'


def client(claim):
    def ask(prompt):
        if "one JSON object" in prompt:
            return Reply(META.replace("数学", "Cookery") if "BAD" in prompt else META, 7, 3)
        return Reply(CONCEPT if "Types: concept" in prompt else claim, 5, 2)

    return ask


def test_preprocess_extract_and_retry(spark, tmp_path):
    root = str(tmp_path)
    (tmp_path / "archives").mkdir()
    with zipfile.ZipFile(tmp_path / "archives/one.zip", "w") as z:
        z.writestr("a.pdf", "# Title\n\nWe use a CNN. It works well. " + "More. " * 30)
        z.writestr("b.pdf", "# BAD\n\nWe use a CNN. " + "More. " * 30)
    state = lambda: {r.source_key[-5:]: r for r in snapshots.read_or_none(spark, root + "/state").collect()}
    assert cli.main(["prepare", "--root", root], spark) == 0
    assert cli.main(["convert", "--root", root, "--min-chars", "50"], spark) == 0
    assert cli.main(["extract", "--root", root], spark) == 2  # no client
    assert cli.main(["extract", "--root", root], spark, client(CLAIM)) == 0  # nothing is eligible before preprocess
    assert {r.extract_status for r in state().values()} == {"pending"}

    assert cli.main(["preprocess", "--root", root], spark, client(CLAIM)) == 1
    s = state()
    assert (s["a.pdf"].preprocess_status, s["a.pdf"].preprocess_prompt_tokens, s["a.pdf"].claimed_at) == ("done", 7, None)
    assert (s["b.pdf"].preprocess_status, s["b.pdf"].error_msg) == ("failed", "a discipline is not in the list")
    m = snapshots.read_or_none(spark, root + "/metadata").collect()
    assert [(r.title, r.year, r.doi, r.keywords, r.primary_discipline.level1, r.primary_discipline.level2, r.secondary_disciplines[0].level1) for r in m] == [("A CNN", 2020, "10.1/x", ["cnn"], "数学", None, "力学")]

    assert cli.main(["extract", "--root", root], spark, client('{"entries": []}')) == 1
    assert (state()["a.pdf"].extract_status, state()["a.pdf"].extract_failed_groups, state()["b.pdf"].extract_status) == ("partial", "GB_results_claims", "pending")
    kinds = lambda: sorted(r.type for r in snapshots.read_or_none(spark, root + "/entries").collect())
    assert kinds() == ["concept"]
    assert cli.main(["extract", "--root", root], spark, client(CLAIM)) == 0
    assert (state()["a.pdf"].extract_status, state()["a.pdf"].extract_failed_groups, state()["a.pdf"].extract_prompt_tokens) == ("done", None, 5)  # one group asked
    assert kinds() == ["claim", "concept"]
    info = snapshots.read_or_none(spark, root + "/metadata").first().extraction_info
    assert (info.extraction_method, info.retry_groups, info.failed_groups) == ("anchor_grouped", ["GB_results_claims"], None)
    assert cli.main(["inspect", "--root", root], spark) == 0


def test_all_stages_in_a_range(spark, tmp_path, capsys):
    """L-8, P-7, S-14, A-13, S-17, J-8: a range of stages, a limit, the recorded replies and audit, and a forced run's manifest."""
    root = str(tmp_path)
    (tmp_path / "archives").mkdir()
    with zipfile.ZipFile(tmp_path / "archives/one.zip", "w") as z:
        for n in "abc":
            z.writestr(f"{n}.pdf", f"# Title {n}\n\nWe use a CNN. It works well. " + "More. " * 30)
    args = ["--root", root, "--min-chars", "50"]
    assert cli.main(["all", *args, "--from-stage", "extract", "--to-stage", "convert"], spark, client(CLAIM)) == 2
    assert cli.main(["all", *args, "--to-stage", "convert", "--limit", "2"], spark, client(CLAIM)) == 0
    state = lambda: {r.source_key: r for r in snapshots.read_or_none(spark, root + "/state").collect()}
    assert [k for k, r in sorted(state().items()) if r.convert_status == "done"] == ["one/a.pdf", "one/b.pdf"]
    assert cli.main(["all", *args, "--from-stage", "preprocess", "--limit", "1"], spark, client(CLAIM)) == 0
    assert {k: r.extract_status for k, r in state().items()} == {"one/a.pdf": "done", "one/b.pdf": "pending"}
    assert sorted((r.source_key, r.grp) for r in spark.read.parquet(root + "/llm_raw").collect()) == [("one/a.pdf", "GA_study_design"), ("one/a.pdf", "GB_results_claims")]
    audit = spark.read.parquet(root + "/evidence_audit").collect()
    assert sorted(r.entry_id for r in audit) == sorted(r.public_id for r in snapshots.read_or_none(spark, root + "/entries").collect())
    capsys.readouterr()
    assert cli.main(["inspect", "--root", root, "--paper", "one/a.pdf"], spark) == 0
    assert "raw_replies" in capsys.readouterr().out
    assert cli.main(["extract", "--root", root, "--force"], spark, client(CLAIM)) == 0
    runs = [p for p in (tmp_path / "runs").iterdir()]
    manifest = {r.name: (r.rows, r.stages) for r in spark.read.json(str(runs[0] / "manifest")).collect()}
    assert manifest == {"state": (2, "extract"), "metadata": (1, "extract"), "entries": (2, "extract")}


def test_snapshots_survive(spark, tmp_path):
    """A pointer is there at any time; none beside snapshots is an error; a second writer is told."""
    import pytest

    path = str(tmp_path / "t")
    assert snapshots.read_or_none(spark, path) is None
    first = snapshots.replace(spark.range(3), path)
    snapshots.replace(spark.range(4), path, expected=first)
    with pytest.raises(RuntimeError):
        snapshots.replace(spark.range(5), path, expected=first)
    assert snapshots.read_or_none(spark, path).count() == 4
    (tmp_path / "t" / "CURRENT").unlink()
    with pytest.raises(RuntimeError):
        snapshots.read_or_none(spark, path)


def test_paths_of_a_scope():
    from paperloom.sources.documents import Settings, scope_paths

    s = Settings()
    assert scope_paths("/b", s) == ("/b/papers", "/b/markdown", "/b/papers")
    assert scope_paths("/b", s, "papers/x/y") == ("/b/papers/x/y", "/b/markdown/x/y", "/b/papers")
    assert scope_paths("/b", s, "/b/papers") == ("/b/papers", "/b/markdown", "/b/papers")
    assert scope_paths("/b", s, "/other/z") == ("/other/z", "/b/markdown/z", "/other/z")


def test_known_texts_are_used_again(spark):
    from paperloom.sources import documents as D

    pdfs = spark.createDataFrame([("a.pdf", b"new"), ("b.pdf", b"new")], "source_key string, content binary")
    known = spark.createDataFrame([("a.pdf", "old"), ("c.pdf", "none"), ("b.pdf", None)], "source_key string, text string")
    assert {r.source_key: (r.text[-3:], r.char_count > 3) for r in D.convert(pdfs, known=known).collect()} == {"a.pdf": ("old", False), "b.pdf": ("new", True)}


def test_hot_papers(spark, monkeypatch):
    """Numbers of entries and the choice of concepts do not depend on how a paper is cut up."""
    from pyspark.sql import functions as F

    from paperloom.operators import entries as N

    e = spark.range(600).select(F.when(F.col("id") < 500, "hot").otherwise(F.col("id").cast("string")).alias("doc_id"), F.lit("claim").alias("type"), "id")
    got = N.public_ids(e, order="id").where("doc_id = 'hot'").orderBy("id").collect()
    assert [r.public_id for r in got] == [f"hot_claim_{i + 1:04d}" for i in range(500)]
    words = [[f"t{(i * 7) % 13}", f"u{(i * 5) % 11}", None] for i in range(40)] + [["", "()", None]] * 2
    c = spark.createDataFrame([("d", i, dict(zip(("term", "normalized", "std_label"), w))) for i, w in enumerate(words)], "doc_id string, pos int, payload map<string,string>")
    held, want = set(), []
    for i, w in enumerate(words):
        keys = {x for x in w if x and x != "()"}
        if not keys & held:
            held |= keys
            want.append(i)
    assert sorted(r.pos for r in N.greedy_concepts(c).collect()) == want
    monkeypatch.setattr(N, "FOLD", 4)
    assert sorted(r.pos for r in N.greedy_concepts(c).collect()) == want
