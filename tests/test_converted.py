"""Conversion of all texts, back matter, abstracts and pages included, against Python on the same texts."""

import hashlib
import os
import re

import pytest

from paperloom.plans import registry

HEADINGS = (
    r"\n#{1,2}\s+\*?\*?\s*(?:References?|Bibliography|参考文献|引用文献)\s*\*?\*?\s*\n",
    r"\n\*?\*?\s*(?:References?|Bibliography|参考文献)\s*\*?\*?\s*\n",
    r"\n#{1,2}\s+\*?\*?\s*(?:Acknowledg(?:e?)ments?|Author\s+Contributions?|Supplementary|Appendices|Data\s+Availability)\s*\*?\*?\s*\n",
)


def converted(text):
    """T-1 to T-3 over the pages of a text."""
    t = "\n\n".join(f"<!-- PAGE {i} -->\n\n{p}" for i, p in enumerate(text.split("\f"), 1))
    t = re.sub(r"\*\*==> picture \[.*?\] intentionally omitted <==\*\*\n?", "", t)
    hits = (re.search(p, t, re.IGNORECASE) for p in HEADINGS)
    cut = next((m.start() for m in hits if m), None)
    lines = list(re.finditer(r"^\s*[-–••*\[]\s*\[?\d{1,4}\]?\s", t, re.MULTILINE))
    if cut is None and len(lines) >= 5:
        wide = [b.start() for a, b in zip(lines, lines[1:]) if b.start() - a.end() > 500]
        cut = wide[-1] if wide else lines[-5].start()
    t = t[:cut]
    m = re.search(r"(##\s+\*?\*?Abstract\*?\*?\s*\n)(.*?)(?=\n##|\Z)", t, re.DOTALL | re.IGNORECASE)
    parts = [p.strip() for p in m.group(2).strip().split("\n\n") if p.strip()] if m else []
    if len(parts) < 2 or not parts[0][0].islower():
        return t
    out = [parts[1]]
    for p in parts[2:] + parts[:1]:
        out[-1:] = [out[-1] + " " + p] if p[0].islower() else [out[-1], p]
    return t[: m.start()] + m.group(1) + "\n\n".join(out) + t[m.end() :]


def wanted(text):
    t = converted(text)
    return len(t), hashlib.sha256(t.encode()).hexdigest()[:24]


def test_texts_that_change(spark, tmp_path):
    texts = [
        "Body.\n\n## References\n[1] x", "Body.\n\n**参考文献**\n[1] x", "Body.\n\n# Acknowledgements\nThanks.", "Body\n" + "- [1] x\n" * 7, "Body\n- [1] x\n" * 3 + "y" * 600 + "\n" + "- [2] z\n" * 4, "One.\fTwo.\f\fFour.",
        "# T\n\n## Abstract\nand ends so.\n\nWe propose X\n\nwhich works.\n\n## Next\nz", "## **Abstract**\nand ends.\n\nWe do.", "a **==> picture [3 x 4] intentionally omitted <==**\nb", "Plain.", "", "Body.\n\n##　References \n[1] x", "Body\n" + "　- [1]　x\n" * 6,
        "a\n\n## Author Contributions\nx", "## Abstract\n　and ends.\n\n　We do.　\n\n## Next",
        "- [1] x\n" * 5 + "a" * 499 + "\n- [2] y\n", "- [1] x\n" * 5 + "a" * 500 + "\n- [2] y\n", "# 1\n\n🧪\n\n## References\nx", "b\r\n## References\r\nx", "- [1] x\n\n\n" * 6,
    ]
    rows = [(i, str(i), t) for i, t in enumerate([*texts, None])]
    spark.createDataFrame(rows, "doc_id long, source_key string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {int(r.source_key): (r.char_count, r.converted_text_sha256_96) for r in registry.QUERIES["s10_converted"](spark, str(tmp_path)).collect()}
    assert sorted(got) == list(range(len(texts)))
    assert {i: (texts[i], got[i], wanted(t)) for i, t in enumerate(texts) if got[i] != wanted(t)} == {}


DATA = os.environ.get("CONVERTED_DATA", "/root/testdata/sf0.001")


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")
def test_all_texts_of_the_tables(spark):
    texts = {r.source_key: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").where("text IS NOT NULL").collect()}
    got = {r.source_key: (r.char_count, r.converted_text_sha256_96) for r in registry.QUERIES["s10_converted"](spark, DATA).collect()}
    assert set(got) == set(texts)
    assert [k for k, t in texts.items() if got[k] != wanted(t)] == []
