"""State transitions, evidence, entries, sources, pipeline and command line on small inputs."""

import io
import json
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from paperloom import cli
from paperloom.operators import entries as N
from paperloom.operators import evidence as E
from paperloom.operators import metadata as M
from paperloom.operators import prompts as P
from paperloom.operators import segments as G
from paperloom.operators import state as S
from paperloom.plans import pipeline
from paperloom.sources import archives, documents, snapshots
from paperloom.streaming import arrivals

NOW = "01/01/2026/00:00:00"


def states(spark, rows):
    return S.migrate(spark.createDataFrame([{"source_key": k, **v} for k, v in rows.items()], "source_key string, convert_status string, preprocess_status string, extract_status string, skip_code string, claimed_at double, retry_count int, source_pdf_sha256_96 string, updated_at string, extract_failed_groups string").fillna("pending", [f"{s}_status" for s in S.STAGES]))


def rows(df, *cols):
    return {r.source_key: tuple(r[c] for c in cols) for r in df.collect()}


def test_claims_and_leases(spark):
    df = states(spark, {"a": {}, "b": {"skip_code": "x"}, "c": {"convert_status": "running", "claimed_at": 100.0}, "d": {"convert_status": "running", "claimed_at": 900.0}, "e": {"convert_status": "failed"}})
    got = rows(S.claim(df, "convert", 1000.0, NOW), "convert_status", "claimed_at")
    assert got == {"a": ("running", 1000.0), "b": ("pending", None), "c": ("running", 1000.0), "d": ("running", 900.0), "e": ("failed", None)}
    assert rows(S.claim(df, "convert", 1000.0, NOW, 1), "convert_status")["c"] == ("pending",)
    assert S.claim(df.limit(0), "extract", 0.0, NOW).count() == 0
    with pytest.raises(ValueError):
        S.claim(df, "nothing", 0.0, NOW)


def test_marks_and_resets(spark):
    df = states(spark, {"a": {"convert_status": "done", "preprocess_status": "done", "extract_status": "partial", "retry_count": 1}, "b": {"convert_status": "failed", "retry_count": 0}})
    failed = S.mark_failed(df, F.col("source_key") == "a", "extract", F.lit("m" * 900), NOW)
    assert rows(failed, "extract_status", "retry_count")["a"] == ("failed", 2) and len(rows(failed, "error_msg")["a"][0]) == 500
    skipped = S.skip(df, F.col("source_key") == "b", "duplicate_pdf", F.lit("same"), NOW, F.lit("a"), unconverted=True)
    assert rows(skipped, "convert_status", "preprocess_status", "extract_status", "skip_reason", "duplicate_of")["b"] == ("skipped", "skipped", "skipped", "duplicate_pdf: same", "a")
    assert rows(S.reset_skipped(skipped, NOW), "convert_status", "skip_code", "duplicate_of")["b"] == ("pending", None, None)
    assert rows(S.reset_stage(df, "preprocess", F.lit(True), NOW), "convert_status", "preprocess_status", "extract_status")["a"] == ("done", "pending", "pending")
    assert rows(S.reset_failed(df, "convert", NOW), "convert_status") == {"a": ("done",), "b": ("pending",)}
    assert rows(S.mark_done(skipped, F.lit(True), "convert", NOW), "skip_code", "convert_at")["b"] == (None, NOW)


def test_latest_state_wins(spark):
    df = S.migrate(spark.createDataFrame([("a", "done", "02/01/2024/00:00:00"), ("a", "pending", "12/31/2023/00:00:00"), ("a", "done", "02/01/2024/00:00:00"), ("b", "failed", None)], "source_key string, convert_status string, updated_at string"))
    assert rows(S.current(df), "convert_status") == {"a": ("done",), "b": ("failed",)}


def test_keep_first(spark):
    df = spark.createDataFrame([("c", "1"), ("a", "1"), ("b", "1"), ("d", "2"), ("e", None), ("f", None)], "source_key string, fp string")
    got = rows(S.keep_first(df, "fp", [F.col("source_key")]), "is_kept", "duplicate_of")
    assert got == {"a": (True, None), "b": (False, "a"), "c": (False, "a"), "d": (True, None), "e": (True, None), "f": (True, None)}
    df = df.withColumn("skip_code", F.when(F.col("source_key") == "a", "x"))
    assert rows(S.linked_first(df, "fp"), "prior") == {"a": ("b",), "b": ("c",), "c": ("b",), "d": (None,), "e": (None,), "f": (None,)}


def test_an_older_table_is_migrated(spark):
    df = S.migrate(spark.createDataFrame([("x", "y.pdf")], "stem string, duplicate_of string"))
    assert df.columns == list(S.COLUMNS) and rows(df, "duplicate_of", "convert_status") == {"x.pdf": ("y.pdf", "pending")}


# --- evidence
DOC = "<!-- PAGE 1 -->\n\nfirst half of\n\nthe needle text here\n\n<!-- PAGE 2 -->\n\nxx first half of the needle text here yy\n\nFigure 3 shows it.\n\n| h | k |\n|---|---|\n| a | 1 |\n| b | 2 |\n\nAfter the table.\n"


def locate(spark, anchor, doc=DOC):
    a = spark.createDataFrame([("p", anchor)], "source_key string, anchor_text string")
    return E.locate_and_expand(a, spark.createDataFrame([("p", doc)], "source_key string, text string")).first()


def test_page_comes_before_the_kind_of_match(spark):
    r = locate(spark, "half of the needle")
    assert (r.page, r.bidx, r.match_method) == (1, 0, "exact")
    r = locate(spark, "nowhere to be found")
    assert (r.page, r.match_method, r.original_text, r.source_kind) == (None, "unmatched", "nowhere to be found", "unmatched")
    assert locate(spark, None).match_method == "unmatched" and locate(spark, "text", "no pages, text").match_method == "unmatched"


def test_tables(spark):
    r = locate(spark, "| a | 1 |")
    assert r.source_kind == "table" and r.original_text == "Figure 3 shows it.\n\n| h | k |\n|---|---|\n| a | 1 |\n\nAfter the table."
    r = locate(spark, "Figure 3 shows")
    assert r.source_kind == "table_caption" and r.original_text.startswith("Figure 3 shows it.\n\n| h | k |")


def test_sentence_frame(spark):
    words = [f"w{i}." for i in range(20)]
    r = locate(spark, "w10.", "<!-- PAGE 1 -->\n\n" + " ".join(words))
    assert r.original_text.split() == words[5:16]


def test_fragments(spark):
    rng = random.Random(2)
    long = " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(16))
    one = f"<!-- PAGE 1 -->\n\n{long}\n\nother block here"
    assert locate(spark, "zzz " + long, one).match_method == "unique_fragment"
    assert locate(spark, "zzz " + long, one + f"\n\n{long}").match_method == "unmatched"
    assert locate(spark, "zzz " + long, f"<!-- PAGE 1 -->\n\n{long} {long}").match_method == "unique_fragment"


def test_location_against_plain_python(spark):
    """Random papers: the first page with the needle in a run of 1 to 4 blocks, the shortest and earliest run on it."""
    rng = random.Random(9)
    docs, anchors, want = [], [], {}
    for k in range(40):
        pages = [["".join(rng.choice("ab ") for _ in range(8)).strip() or "a" for _ in range(rng.randint(1, 5))] for _ in range(rng.randint(1, 3))]
        norm = [[" ".join(b.split()) for b in p] for p in pages]
        docs.append((str(k), "\n\n".join(f"<!-- PAGE {i + 1} -->\n\n" + "\n\n".join(p) for i, p in enumerate(pages))))
        needle = "".join(rng.choice("ab ") for _ in range(rng.randint(1, 6))).strip() or "b"
        needle = " ".join(needle.split())
        anchors.append((str(k), needle))
        hits = [(i, s, b) for i, p in enumerate(norm) for s in range(1, 5) for b in range(len(p) - s + 1) if needle in " ".join(p[b : b + s])]
        want[str(k)] = (min(hits)[0] + 1, min(hits)[2]) if hits else (None, None)
    a = spark.createDataFrame(anchors, "source_key string, anchor_text string")
    got = rows(E.locate(a, G.structure(spark.createDataFrame(docs, "source_key string, text string"))), "page", "bidx")
    assert {k: v for k, v in got.items() if v != want[k] and want[k] != (None, None)} == {}


# --- entries
def test_items_to_entries(spark):
    reply = {"entries": [{"type": "relation", "payload": {"head": "CNN", "tail": "Big Net (BN)"}, "evidence": {"anchor_text": "It uses"}}, {"type": "concept", "term": "CNN", "confidence": "0.7"}, {"type": "concept", "payload": {"term": "Big Net (BN)", "std_label": "BN"}}, {"type": "concept", "payload": {"term": "bn"}}, {"type": "concept", "payload": {"term": 5}}, {"type": "what"}, {"type": "quantitative_result", "payload": {"value": 5}}]}
    items = N.unify_reply(spark.createDataFrame([("d", "p", json.dumps(reply))], "doc_id string, source_key string, reply string"))
    out = N.assemble(items, spark.createDataFrame([("p", "<!-- PAGE 4 -->\n\nIt uses much.")], "source_key string, text string"))
    got = {r.public_id: r for r in out["entries"].collect()}
    assert set(got) == {"d_concept_0001", "d_concept_0002", "d_relation_0001", "d_quantitative_result_0001"}
    r = got["d_relation_0001"]
    assert (r.head_entry_id, r.tail_entry_id, r.evidence.page, r.evidence.match_method) == ("d_concept_0001", "d_concept_0002", 4, "exact")
    assert got["d_concept_0001"].confidence == 0.7 and got["d_quantitative_result_0001"].payload["value"] == "5"


def test_plural_lists_are_typed(spark):
    items = N.unify_reply(spark.createDataFrame([("d", '{"claims": [{"anchor_text": "x"}], "entries": [], "odd": [{"a": 1}]}')], "doc_id string, reply string"))
    assert sorted(r.type for r in items.collect()) == ["claim", "odd"]


def test_greedy_concepts(spark):
    sets = ["a|b", "b|c", "c", "a", "e"]
    df = spark.createDataFrame([("d", i, dict(zip(("term", "normalized"), (s.split("|") * 2)[:2]))) for i, s in enumerate(sets)], "doc_id string, pos long, payload map<string,string>")
    assert sorted(r.pos for r in N.greedy_concepts(df).collect()) == [0, 2, 4]


def test_enumerated_datasets_collapse(spark):
    def frame(n):
        return spark.createDataFrame([("d", i, "dataset", {"name": f"n{i}"}, (3, "same")) for i in range(n)], "doc_id string, pos long, type string, payload map<string,string>, evidence struct<page:int,original_text:string>")

    kept, report = N.collapse_datasets(frame(6))
    assert [r.pos for r in kept.collect()] == [0] and report.first().removed_names == [f"n{i}" for i in range(1, 6)] and report.first().kept_name == "n0"
    kept, report = N.collapse_datasets(frame(5))
    assert kept.count() == 5 and report.count() == 0


def test_disciplines(spark):
    schema = "doc_id string, primary_discipline struct<level1:string,level2:string,level3:string>, secondary_disciplines array<struct<level1:string,level2:string,level3:string>>"
    df = spark.createDataFrame([("a", (" 数学 ", " ", None), [("数学", None, None), ("化学", "x", None), ("化学", "x ", "")]), ("b", ("Math", None, None), None), ("c", None, [])], schema)
    got = {r.doc_id: r for r in M.validate_disciplines(df).collect()}
    assert tuple(got["a"].primary_valid) == ("数学", None, None) and [tuple(s) for s in got["a"].secondary_valid] == [("化学", "x", None)] and got["a"].disciplines_ok
    assert got["b"].primary_valid is None and not got["b"].disciplines_ok and not got["c"].disciplines_ok
    assert len(M.LEVEL1) == len(set(M.LEVEL1)) == 50


# --- prompts and the model port
def test_groups(spark):
    assert P.parse_spec("concept| dataset + method") == [["concept"], ["dataset", "method"]]
    with pytest.raises(ValueError):
        P.parse_spec("nothing", strict=True)
    with pytest.raises(ValueError):
        P.group_table(spark, ("nothing",), strict=True)
    assert P.parse_spec("nothing|claim+none") == [["claim"]] and P.group_table(spark, ("nothing",)).count() == 0
    assert [r.grp for r in P.group_table(spark, ("relation", "nothing", "concept_relation", "concept")).collect()] == ["GC_concept", "GR_relation", "G1_concept_relation"]
    assert [(r.grp, r.types) for r in P.group_table(spark, spec="claim|concept").collect()] == [("GX_custom_1", ["concept"]), ("GX_custom_0", ["claim"])]
    assert len(P.GROUPS) == 19


def test_calls_are_repeated():
    log, waits = [], []

    def client(prompt):
        log.append(prompt)
        if len(log) == 1:
            raise P.Busy("later")
        return P.Reply("no json" if len(log) == 2 else '{"entries": []}')

    assert P.ask(client, "x", 3, waits.append)[0] == '{"entries": []}' and waits == [1.0]
    assert P.ask(lambda p: (_ for _ in ()).throw(OSError("down")), "x", 2, waits.append) == (None, None, "OSError: down")


# --- sources, pipeline, command line
def make_zip(path, members):
    path.parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(path, "w") as z:
        for n, b in members.items():
            z.writestr(n, b)


@pytest.mark.parametrize("name, want", [("a.pdf", "take"), ("a.txt", "skip"), ("__MACOSX/a.pdf", "skip"), ("/a.pdf", "unsafe path: /a.pdf"), ("x/../a.pdf", "unsafe path: x/../a.pdf")])
def test_members(name, want):
    assert archives.safe_member(name, False) == want


def test_from_archives_to_inspection(spark, tmp_path):
    root, long = tmp_path / "corpus", "A sentence of the paper. " * 20
    make_zip(root / "archives/sub/One.ZIP", {"a.pdf": "# Title\f" + long, "b.pdf": "# Title\f" + long, "c.pdf": "short", "note.txt": "x"})
    make_zip(root / "archives/two.zip", {"d.pdf": "# Title\f" + long + "x"})
    make_zip(root / "archives/bad.zip", {"../evil.pdf": "x"})
    (root / "archives/broken.zip").write_bytes(b"no zip")
    assert cli.main(["prepare", "--root", str(root)], spark) == 1
    assert {r.batch for r in spark.read.parquet(str(root / "members")).select("batch").collect()} == {"sub/One", "two"}
    again = {r.status: r.n for r in archives.prepare(spark, str(root / "archives"), str(root), NOW).collect()}
    assert again == {"skipped": 2, "failed": 2}
    assert cli.main(["convert", "--root", str(root), "--min-chars", "100"], spark) == 0
    state = snapshots.read_or_none(spark, str(root / "state"))
    got = rows(state, "convert_status", "skip_code", "duplicate_of")
    assert got == {"sub/One/a.pdf": ("done", None, None), "sub/One/b.pdf": ("skipped", "duplicate_pdf", "sub/One/a.pdf"), "sub/One/c.pdf": ("done", "insufficient_text", None), "two/d.pdf": ("done", None, None)}
    for command in ("status", "inspect"):
        assert cli.main([command, "--root", str(root)], spark) == 0
    assert cli.main(["reset", "--root", str(root), "--stage", "convert", "--paper", "two/d.pdf"], spark) == 0
    assert rows(snapshots.read_or_none(spark, str(root / "state")), "convert_status")["two/d.pdf"] == ("pending",)
    with pytest.raises(SystemExit) as e:
        cli.main(["nothing"])
    assert e.value.code == 2


def test_extraction_with_replayed_replies(spark):
    papers = spark.createDataFrame([("p.pdf", "<!-- PAGE 1 -->\n\nWe use a CNN. It works well.")], "source_key string, text string")
    ids = spark.createDataFrame([("p.pdf", "doc_x")], "source_key string, doc_id string")
    client = P.replay({"Types: concept": 'Sure ```json\n{"entries": [{"type": "concept", "payload": {"term": "CNN"}, "evidence": {"anchor_text": "use a CNN"}}]}\n```'})
    out = pipeline.extract_stage(papers, ids, client)
    assert [(r.public_id, r.evidence.page) for r in out["entries"].collect()] == [("doc_x_concept_0001", 1)]
    assert out["failed"].first().extract_failed_groups == "GB_results_claims"  # empty twice
    assert out["usage"].first().extract_prompt_tokens > 0


def test_conversion_isolates_failures(spark):
    def converter(content):
        if content == b"bad":
            raise RuntimeError("no pages")
        return [content.decode()]

    df = spark.createDataFrame([("a.pdf", bytearray(b"text")), ("b.pdf", bytearray(b"bad"))], "source_key string, content binary")
    got = rows(documents.convert(df, converter), "text", "error")
    assert got == {"a.pdf": ("<!-- PAGE 1 -->\n\ntext", None), "b.pdf": (None, "RuntimeError: no pages")}


def test_settings():
    s = documents.Settings.load({"MAX_INPUT_CHARS": "5", "LLM_TEMPERATURE": "0.5"})
    assert (s.max_input_chars, s.llm_temperature, s.min_md_chars) == (5, 0.5, 10_000)


def test_markdown_and_json_files(spark, tmp_path):
    (tmp_path / "md/x").mkdir(parents=True)
    (tmp_path / "md/x/a.md").write_text("# T\n\ntext")
    assert rows(documents.read_markdown(spark, str(tmp_path / "md")), "text") == {"x/a.pdf": ("# T\n\ntext",)}
    documents.write_json(spark.createDataFrame([("b/é.pdf", None)], "source_key string, year int"), str(tmp_path / "out"))
    assert '"year":null' in next((tmp_path / "out").rglob("*.txt")).read_text()


def test_streams(spark, tmp_path):
    src = str(tmp_path / "src")
    spark.createDataFrame([("a", "t", 1), ("b", "t", 2), ("c", "u", 3)], "source_key string, text string, s long").select("source_key", "text", F.timestamp_seconds("s").alias("arrived"), F.lit("x").alias("source")).write.parquet(src)
    schema = spark.read.parquet(src).schema
    q = arrivals.fresh_texts(spark.readStream.schema(schema).parquet(src)).writeStream.format("memory").queryName("fresh").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("fresh").count() == 2
    state = str(tmp_path / "state")

    def transition(old, batch):
        return S.register(S.migrate(spark.createDataFrame([], S.schema())) if old is None else old, batch, NOW)

    for _ in range(2):
        arrivals.apply_batches(spark.readStream.schema(schema).parquet(src), state, transition, str(tmp_path / "chk")).awaitTermination()
    assert snapshots.read_or_none(spark, state).count() == 3
    assert arrivals.arrivals(spark.read.parquet(src)).first().n == 3
