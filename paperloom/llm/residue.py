"""Problem 9: template residue, filler, error pages and script notices in place of a text.

Method. Message templates are mined with a prefix tree of fixed depth: a unit (a sentence or line) goes down by its
first tokens, digits and slots masked, and the node at the last level is its template. Each template is classified
once from where it occurs: sentences of papers occur in documents with section headings, residue practically never
does. A template that too few documents share is judged by its node one level up, then by its own wording, and at last by its first
token. The
verdicts are propagated to the documents: one is residue when it holds residue and not one ordinary sentence.
Unresolved slots inside ordinary documents are reported separately.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.tables import materialise

#: Documents that must share a node before its statistics decide, and the share of them with sections below which it is residue.
MIN_SUPPORT = 3
MAX_SECTIONED = 0.2

#: Syntaxes of unfilled slots.
SLOT = re.compile(
    r"\{\{[^{}\n]{1,60}\}\}|[$#]\{[^{}\n]{1,60}\}|\{%=?[^%\n]{1,60}%\}|<%=?[^%\n]{1,60}%>|%[A-Za-z][A-Za-z _]{1,40}%|@@\w{2,40}@@|__[A-Za-z][A-Za-z_ ]{1,40}__"
    r"|«[A-Za-z_ ]{2,40}»|<<[A-Za-z_ ]{2,40}>>|<[A-Za-z_]{2,40}>|\[[A-Za-z][A-Za-z_ ]{2,40}\]|\{[A-Za-z][A-Za-z_ ]{2,40}\}|【[^】\n]{1,30}】|\?\?\?|\bXX\b"
)
#: Wording of notices, errors and filler, used only for templates that too few documents share.
CUES = re.compile(
    r"javascript|cookies?\b|\bscripts?\b|\b(?:40\d|50\d)\b|not found|denied|forbidden|expired|permission|log ?in|sign in|try again|unavailable|not available|rate limit|captcha|security check|checking your browser"
    r"|went wrong|help desk|could not be|\berror\b|\bfatal\b|\bpanic\b|exception|traceback|exit status|request id|\bTODO\b|\bTBD\b|lorem|ipsum|placeholder|goes here|insert |click to|type your|start typing|fill(?:er)? |asdf|qwerty"
    r"|introuvable|réessayer|activer|veuillez|résumé à|compléter|nicht gefunden|verweigert|abgelaufen|einfügen|erlaubt|caducad|vuelva a|volver|habilite|permiso|escriba|não encontrad|ative |permissão|tente novamente"
    r"|включите|недоступ|не найден|истекл|доступ|повторите|错误|不存在|访问|失败|登录|权限|脚本|启用|请求|稍后|重新|此处填写|待补充|测试|占位|エラー|有効|見つかりません|ログイン|再度|アクセス|ここに",
    re.I,
)
#: Common function words; running text of a paper has some.
COMMON = frozenset(
    "the of and in to a is for that with on was were by as an are be this we at from der die das und in zu den von mit für auf eine ein wird sich ist le la les des et du une que dans pour sur est a de el los las y en un una con por para se o os as do da em um uma não com и в на не что с по из для к был было".split()
)
_SLOT_SIGN = re.compile(r"[{$#<%@_«\[【]|\?\?\?|XX")
_CJK = re.compile(r"[぀-ヿ㐀-鿿]")
_UNIT = re.compile(r"(?<=[.!?])\s+|(?<=[。！？])")
_FURNITURE = re.compile(r"<!-- PAGE \d+ -->|©.*")
_HEADING = re.compile(r"^##+ (.*)$", re.M)
_DIGITS = re.compile(r"\b(?=[a-f]*\d)[0-9a-f]{6,}\b|\d+")
_ENDS = (".", "!", "?", "。", "！", "？")


def units(text: str) -> list[str]:
    """The sentences and lines of a text, without page markers, titles and copyright lines."""
    out = []
    for line in text.split("\n"):
        line = line.strip()
        if line[:1] == "#":
            if not has_slot(line):
                continue
            line = line.lstrip("# ")
        if not line or _FURNITURE.fullmatch(line):
            continue
        out += [u for u in _UNIT.split(line) if u]
    return out


def has_slot(text: str) -> bool:
    """Whether a text holds a slot; most hold none of the signs that begin one."""
    return _SLOT_SIGN.search(text) is not None and SLOT.search(text) is not None


def tree_path(unit: str) -> tuple[str, str, str]:
    """The unit's nodes at the three levels of the prefix tree; a slot anywhere in it makes them nodes of a template with slots."""
    head = ""
    if has_slot(unit):
        unit, head = SLOT.sub("§", unit), "§ "
    if _CJK.search(unit[:6]):
        unit = _DIGITS.sub("0", unit.lower())
        a, b, c = unit[:2], unit[:4], unit[:6]
    else:
        tokens = [_DIGITS.sub("0", t) for t in unit.lower().split(None, 3)[:3]]
        a, b, c = tokens[0] if tokens else "", " ".join(tokens[:2]), " ".join(tokens)
    return head + a + "|1", head + b + "|2", head + c + "|3"


def wording(unit: str) -> bool:
    """Whether a unit reads as residue by its own words: a cue, a slot, or no common word at all."""
    if has_slot(unit) or CUES.search(unit):
        return True
    if _CJK.search(unit):
        return False
    words = re.findall(r"[^\W\d_]+", unit.lower())
    return len(words) >= 4 and not any(w in COMMON for w in words) or (not words and len(unit) > 20)


def is_sentence(unit: str) -> bool:
    return unit.endswith(_ENDS) or len(unit) >= 60


def sectioned(text: str) -> bool:
    """Whether a text has a section heading that is no slot."""
    return any(not has_slot(h) for h in _HEADING.findall(text))


def occurrences(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row for each document and template: its nodes, as 64-bit hashes, and what the document says about them."""
    schema = f"{id_col} {df.select(id_col).schema[0].dataType.simpleString()}, k1 long, k2 long, k3 long, sectioned boolean, sentence boolean, worded boolean, slots boolean"

    def run(batches):
        import pyarrow as pa
        from xxhash import xxh3_64_intdigest

        def node(k: str) -> int:
            h = nodes.get(k)
            if h is None:
                if len(nodes) > 500_000:
                    nodes.clear()
                h = nodes[k] = xxh3_64_intdigest(k.encode("utf-8", "surrogatepass")) - (1 << 63)
            return h

        nodes: dict[str, int] = {}
        names = [id_col, "k1", "k2", "k3", "sectioned", "sentence", "worded", "slots"]
        for b in batches:
            ids, cols = [], [[] for _ in range(7)]
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if not text:
                    continue
                sec = sectioned(text)
                seen: dict[str, list] = {}
                for u in units(text):
                    a, m, z = tree_path(u)
                    old = seen.get(z)
                    if old is None:
                        seen[z] = [a, m, is_sentence(u), not sec and wording(u), z[0] == "§"]
                    else:
                        old[2] = old[2] or is_sentence(u)
                        old[3] = old[3] and wording(u)
                for z, (a, m, sent, word, slot) in seen.items():
                    ids.append(i)
                    for c, v in zip(cols, (node(a), node(m), node(z), sec, sent, word, slot)):
                        c.append(v)
            kinds = [pa.int64()] * 3 + [pa.bool_()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(ids, b.schema.field(0).type), *(pa.array(c, k) for c, k in zip(cols, kinds))], names)

    return df.select(F.col(id_col), F.col(text_col).alias("__text")).mapInArrow(run, schema)


def classify(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, residue, open_slots): a verdict for each document that holds any unit.

    Defined cases: null, empty and blank texts have no unit and no row; rows with the same id are judged together; a
    document of titles, page markers and copyright lines only has no row; other columns are ignored; an empty table gives
    an empty result. ``open_slots`` is true where an ordinary document holds a slot syntax in a template that is no
    paper's template.
    """
    occ = materialise(occurrences(df, id_col, text_col), "units")
    # the leaves are counted once; the nodes above them add their counts up
    leaves = materialise(occ.groupBy("k3", "k2", "k1").agg(F.count("*").alias("n"), F.sum(F.col("sectioned").cast("long")).alias("s"), F.max("sectioned").alias("known")), "leaves")
    for k in ("k1", "k2", "k3"):
        stats = leaves.groupBy(k).agg(F.sum("n").alias("n"), F.sum("s").alias("s")).where(F.col("n") >= MIN_SUPPORT).select(k, (F.col("s") / F.col("n") < MAX_SECTIONED).alias(f"bad_{k}"))
        leaves = leaves.join(stats, k, "left")
    # a template seen in papers is theirs however few they are
    verdict = leaves.select("k3", F.coalesce("bad_k3", F.when(F.col("known"), F.lit(False)), "bad_k2").alias("bad"), "bad_k1")
    judged = occ.join(verdict, "k3").withColumn("bad", F.coalesce("bad", F.when(F.col("worded"), F.lit(True)), "bad_k1", "worded"))
    return judged.groupBy(id_col).agg(
        (F.max(F.col("bad").cast("int")) == 1).alias("__some"),
        (F.max((~F.col("bad") & F.col("sentence")).cast("int")) == 1).alias("__ordinary"),
        (F.max((F.col("bad") & F.col("slots")).cast("int")) == 1).alias("__slots"),
    ).select(id_col, (F.col("__some") & ~F.col("__ordinary")).alias("residue"), (F.col("__slots") & F.col("__ordinary")).alias("open_slots"))


def looks_residue(text: str) -> bool:
    """A verdict from one text alone, for callers that hold a few candidates: every sentence or line reads as residue."""
    own = units(text)
    return bool(own) and any(map(wording, own)) and not any(is_sentence(u) and not wording(u) for u in own)
