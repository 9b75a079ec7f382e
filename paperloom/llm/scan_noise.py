"""Problem 4: noise in texts from scanned pages: divided words, misread letters, running headers, page numbers.

Method. A frequency lexicon of the whole corpus is counted first. Candidates for a misread word come from a symmetric-delete
index: from the word and from the lexicon's words every sign that can take part in a confusion is deleted, only the class of signs that it
may be misread for stays in its place, and what is left meets in an equality join. So two words meet however many of their signs were
misread, whatever their length, and a word has one row in the index. A candidate is verified by a weighted edit distance that knows the
confusion pairs (every other edit is too dear), must be far more frequent than the word, and where several are left the
bigram with the word before picks one. For Chinese and Japanese the same is done for single signs in the context of their neighbours.
A word divided at a line end is a hyphenation unless the lexicon has the hyphenated compound more often than the joined
word. Running headers are lines of a header's form, or lines that stand in the middle of sentences in several texts.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.tables import materialise

#: Fixed values: (true, misread) pairs of single letters and of groups.
SINGLE = (("e", "c"), ("s", "5"), ("i", "l"), ("t", "f"), ("o", "0"), ("l", "1"), ("i", "1"), ("g", "q"), ("h", "b"), ("S", "5"), ("O", "0"), ("I", "l"), ("I", "1"), ("B", "8"), ("Z", "2"), ("l", "I"), ("g", "9"), ("b", "6"), ("а", "a"), ("е", "e"), ("о", "o"), ("о", "0"), ("з", "3"), ("б", "6"))
GROUPS = (("m", "rn"), ("d", "cl"), ("u", "ii"), ("w", "vv"), ("fi", "ﬁ"), ("fl", "ﬂ"), ("ff", "ﬀ"))
#: Signs of Chinese and Japanese that are misread for each other, in sets.
ALIKE = ("日曰目", "人入八", "已己巳", "未末", "本木", "用甩", "我找", "比此", "土士", "大太犬", "天夫无", "千干", "王玉", "田由甲申", "刀力", "贝见", "午牛", "问间", "白自", "处外", "今令", "折析拆", "侧测", "候侯", "治冶", "ロ口", "カ力", "エ工", "ニ二", "ト卜", "タ夕", "へヘ", "ー一", "ソン", "シツ", "微徽", "着看", "即既", "于干", "型形", "料科", "的旳", "术木", "历厉", "住佳", "住往", "待侍", "性姓", "果杲", "因困", "同冋", "量童", "情清", "究穷", "末來")

#: A lexicon word is believed against a rarer one from this count and ratio on.
MIN_COUNT = 5
RATIO = 8
#: Bits of the filters with which workers pass over words that no join can find; a full filter costs rows and no result.
BITS = 1 << 24

_PAIRS = {(b, a) for a, b in SINGLE}
_WORD = re.compile(r"[^\W_]{3,}")
_COMPOUND = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)+")
_CJK = re.compile(r"[぀-ヿ㐀-鿿]")
_WIDE = re.compile(r"[\u3000-\u30ff\u3400-\u9fff\uff00-\uffef]")
_SIGNS = {}
for _group in ALIKE:
    for _c in _group:
        _SIGNS[_c] = "".join(dict.fromkeys(_SIGNS.get(_c, "") + _group.replace(_c, "")))
_ODD = re.compile("(?<=([぀-ヿ㐀-鿿]))[" + "".join(_SIGNS) + "](?=([぀-ヿ㐀-鿿]))|(?:^|(?<=[。，、！？；：\\s]))[" + "".join(_SIGNS) + "](?=([぀-ヿ㐀-鿿]))")
_HYPHEN = re.compile(r"([^\W\d_]+(?:-[^\W\d_]+)*)[-‐‑¬­]$")
_HEAD_WORD = re.compile(r"^[^\W\d_]+")
_END = re.compile(r"[.!?。！？:：][\"”»’)）\]]*$")
_NUMBER = re.compile(r"[-–—~·\[(（]*\s*\d{1,4}\s*[-–—~·\])）]*|(?:p|pp|pg|page|pag|pág|página|seite|s|с|стр|стр\.|page no)\.?\s*\d{1,4}|第\s*\d{1,4}\s*[页頁ページ]+(?:\s*[,，/]?\s*共\s*\d{1,4}\s*[页頁])?|(?=[ivxlc])(?:c{0,3})(?:xc|xl|l?x{0,3})(?:ix|iv|v?i{0,3})|\d{1,4}\s*(?:页|頁|ページ)|(?:(?:p|page|pag|pág|página|seite|s|с|стр)\.?\s+)?\d{1,4}\s*(?:/|of|von|de|sur|из)\s*\d{1,4}", re.I)
_FIELDS = re.compile(r"\S\s{2,}\S|\S\s+[·•]\s+\S")
_ET_AL = re.compile(r"^(?:\d{1,4}\s+)?\S.{0,60}?\b(?:et al\.|et col\.|и др\.|ら|等)\s*[–—-]\s*\S")
_LATERAL = re.compile(r"^(?P<front>\d{1,4})(?:\s{2,}|\s*[|·]\s*)(?=\D)|(?:\s{2,}|\s*[|·]\s*)(?P<back>\d{1,4})$")
_CODE = re.compile(r"[=<>{}\\|`]|\(\)|^\s*[-+*#>:]")


def _classes() -> dict[str, str]:
    """What stays of each sign that can be misread: the least sign of its class; a sign that is misread as a group leaves the group's."""
    of: dict[str, set[str]] = {}
    for a, b in SINGLE:
        both = of.get(a, {a}) | of.get(b, {b})
        for c in both:
            of[c] = both
    one = {c: min(both) for c, both in of.items()}
    more: dict[str, str] = {}
    for good, bad in GROUPS:
        letter, group = (good, bad) if len(good) == 1 else (bad, good)
        more[letter] = "".join(one.get(c, c) for c in group)
    return one | more


_CLASS = _classes()
_TABLE = str.maketrans(_CLASS)


def skeleton(word: str) -> str:
    """The word without its signs that can be misread, their classes in their place."""
    return word.translate(_TABLE)


def skeleton_of(word):
    """Column of :func:`skeleton`. Groups are put in first: none of them holds a sign that stands for a class of one sign only."""
    out = F.col(word) if isinstance(word, str) else word
    single = {c: k for c, k in _CLASS.items() if len(k) == 1}
    many = {c: k for c, k in _CLASS.items() if len(k) > 1}
    out = F.translate(out, "".join(single), "".join(single.values()))
    for c, k in many.items():
        out = F.replace(out, F.lit(c), F.lit(k))
    return out


def bits(keys: DataFrame, key: str) -> bytes:
    """A filter of :data:`BITS` bits in which the bit of each key is set; at most ``BITS / 64`` rows reach the driver."""
    import array

    at = F.pmod(F.crc32(F.col(key).cast("binary")), F.lit(BITS))
    rows = keys.select(at.alias("at")).distinct().groupBy(F.floor(F.col("at") / 64).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(at % 64 AS INT))")).alias("b"))
    words = array.array("q", bytes(BITS // 8))
    for r in rows.collect():
        words[r["w"]] = r["b"]
    return words.tobytes()


def holds(filter_: bytes, key: str) -> bool:
    import zlib

    at = zlib.crc32(key.encode("utf-8", "surrogatepass")) & (BITS - 1)
    return filter_[at >> 3] >> (at & 7) & 1 == 1


def distance(bad: str, good: str, dear: float = 9.0) -> float:
    """The weighted edit distance: confusion pairs cost 0.3 (single) or 0.4 (group), equal letters nothing, all else is dear."""
    rows = [[dear] * (len(good) + 1) for _ in range(len(bad) + 1)]
    rows[0][0] = 0.0
    for i in range(len(bad) + 1):
        for j in range(len(good) + 1):
            best = rows[i][j]
            if i and j:
                a, b = bad[i - 1], good[j - 1]
                step = 0.0 if a == b else 0.3 if (a, b) in _PAIRS else dear
                best = min(best, rows[i - 1][j - 1] + step)
            for g, x in GROUPS:
                if i >= len(x) and j >= len(g) and bad[i - len(x) : i] == x and good[j - len(g) : j] == g:
                    best = min(best, rows[i - len(x)][j - len(g)] + 0.4)
                if i >= len(g) and j >= len(x) and len(x) == 2 and bad[i - len(g) : i] == g and good[j - len(x) : j] == x:
                    best = min(best, rows[i - len(g)][j - len(x)] + 0.6)
            rows[i][j] = best
    return rows[-1][-1]


def signs_in_context(text: str):
    """(context, sign, offset) of the confusable signs: the sign with its neighbours, the one before maybe absent."""
    for m in _ODD.finditer(text):
        yield (m.group(1) or "^") + m.group(0) + (m.group(2) or m.group(3)), m.group(0), m.start()


def layout(text: str) -> list[tuple[str, str, bool]]:
    """(line, kind, standing) of the lines of a text with at least three; kind: '' for text, 'blank', 'page_number', 'header', 'both'
    (a header with a page number) or 'line?' (it may be a header; ``standing``: alone between blank lines within a sentence)."""
    raw = text.split("\n")
    lines = [x.strip() for x in raw]
    full = [x for x in lines if x]
    if len(full) < 3:
        return [(x, "" if x else "blank", False) for x in lines]
    width = sorted(map(len, full))[len(full) * 2 // 3]
    code = "```" in text or "<pre" in text or "\\begin{verbatim}" in text
    out: list[tuple[str, str, bool]] = []
    last, fresh = "", True  # the last line of running text; whether a blank line lies before
    for k, line in enumerate(lines):
        if not line:
            out.append((line, "blank", False))
            fresh = True
            continue
        kind, standing = "", False
        if _NUMBER.fullmatch(line) and not code:
            kind = "page_number"
        elif len(line) <= 110 and not code and not _CODE.search(line):
            letters = sum(c.isalpha() for c in line)
            side = _LATERAL.search(line)
            if letters >= 2 and (_ET_AL.match(line) or _FIELDS.search(line)) and not _END.search(re.sub(r"\bet al\.", "", line)):
                kind = "both" if side or re.search(r"^\d{1,4}\s|\s\d{1,4}$", line) and _ET_AL.match(line) else "header"
                if _FIELDS.search(line) and not _ET_AL.match(line) and letters < len(line) // 3:
                    kind = ""
            elif letters >= 2 and not _END.search(line) and 0 < k < len(lines) - 1 and last:
                open_ = not _END.search(last)
                alone = fresh and k + 1 < len(lines) and not lines[k + 1]
                nxt = next((x for x in lines[k + 1 :] if x), "")
                goes_on = bool(nxt) and (nxt[0].islower() or _CJK.match(nxt) is not None)
                standing = alone and open_
                # a break where the next word, or sign, would have fitted is no line end of the running text
                room = width - len(line) - (2 if _CJK.search(line) else len(nxt.split(" ", 1)[0]) + 2)
                if open_ and nxt and room > 0 and not standing and len(line) < 0.9 * width and (line[0].isupper() or _CJK.match(line)) and (goes_on or not nxt[0].isalpha()):
                    kind = "header"
                elif standing or (alone and nxt) or (len(line) < 0.8 * width and (line[0].isupper() or not line[0].isascii()) and nxt and (goes_on or not open_)):
                    kind = "line?"
        out.append((line, kind, standing))
        if kind == "":
            last = line
        fresh = False
    return out


def line_key(line: str) -> str:
    return re.sub(r"\d+", "", line).strip(" -–—|·[]()").casefold()


def running_text(lines: list[tuple[str, str, bool]], headers: set[str] = frozenset()) -> list[str]:
    """The lines that are text, without headers, page numbers and the blank lines around them."""
    out: list[str] = []
    for line, kind, _ in lines:
        if kind in ("page_number", "header", "both") or (kind == "line?" and line_key(line) in headers):
            while out and not out[-1]:
                out.pop()
            out.append("\0")
        elif kind == "blank":
            if out and out[-1] not in ("", "\0"):
                out.append("")
        else:
            if out and out[-1] == "\0":
                out.pop()
            out.append(line)
    return [x for x in out if x != "\0"]


def divided(lines: list[str]):
    """(index, left, right) of the words that a line end divides."""
    for k in range(len(lines) - 1):
        m = _HYPHEN.search(lines[k])
        if m:
            h = _HEAD_WORD.match(lines[k + 1])
            if h and h.group(0)[0].islower():
                yield k, m.group(1), h.group(0)


def _noise_frames(texts: DataFrame, bigrams: bool = False):
    """The counted lexicon, the misreadings and the findings of every text, with ``bigrams`` also the words before each rival; see
    :func:`find_noise`."""
    spark = texts.sparkSession
    texts = texts.select(F.col("record_id").cast("string"), F.col("field_name").cast("string"), "text").where(F.length("text") > 0)

    def count(batches):
        import pyarrow as pa

        for b in batches:
            words, pairs, signs, heads = Counter(), Counter(), Counter(), Counter()
            for t in b.column(2).to_pylist():
                words.update(_WORD.findall(t))
                if "-" in t:
                    pairs.update(_COMPOUND.findall(t))
                if not t.isascii():
                    signs.update(c for c, _, _ in signs_in_context(t.replace("\n", "")))
                if t.count("\n") >= 2:
                    for line, kind, standing in layout(t):
                        if standing:
                            heads[line_key(line)] += 1
            kinds, keys, n = [], [], []
            for kind, c in (("w", words), ("c", pairs), ("x", signs), ("h", heads)):
                kinds += [kind] * len(c)
                keys += c.keys()
                n += c.values()
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(keys, pa.string()), pa.array(n, pa.int64())], ["kind", "key", "n"])

    lexicon = materialise(texts.mapInArrow(count, "kind string, key string, n long").groupBy("kind", "key").agg(F.sum("n").alias("n")).where("n > 1 OR kind <> 'c'"), "lexicon")

    words = lexicon.where("kind = 'w'").select("key", "n")
    low = words.where(~F.col("key").rlike("^\\d+$") & ~F.col("key").rlike("[぀-ヿ㐀-鿿]")).withColumn("d", skeleton_of("key"))
    good = low.where((F.col("n") >= MIN_COUNT) & ~F.col("key").rlike("\\d"))
    met = low.alias("b").join(good.alias("g"), (F.col("b.d") == F.col("g.d")) & (F.col("b.key") != F.col("g.key")) & (F.col("g.n") >= RATIO * F.col("b.n"))).select(F.col("b.key").alias("bad"), F.col("g.key").alias("good"), F.col("g.n").alias("n"))

    def verify(batches):
        import pyarrow as pa

        for b in batches:
            rows = [(x, y, n, distance(x, y)) for x, y, n in zip(*(b.column(i).to_pylist() for i in range(3)))]
            rows = [r for r in rows if 0 < r[3] <= 0.3 * max(1, len(r[0]) // 3)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.float64())], ["bad", "good", "n", "cost"])

    # single signs of Chinese and Japanese in context
    signs = lexicon.where("kind = 'x'").select("key", "n")
    alike = F.create_map(*[F.lit(x) for c, o in _SIGNS.items() for x in (c, o)])
    other = signs.select(F.col("key").alias("bad"), F.col("n").alias("bn"), F.explode(F.split(alike[F.substring("key", 2, 1)], "")).alias("o")).where(F.col("o") != "").withColumn("good", F.concat(F.substring("bad", 1, 1), "o", F.substring("bad", 3, 1)))
    odd = other.join(signs.select(F.col("key").alias("good"), "n"), "good").where((F.col("n") >= MIN_COUNT) & (F.col("n") >= RATIO * F.col("bn"))).select("bad", "good", "n", F.lit(0.3).alias("cost"))
    misread = materialise(met.mapInArrow(verify, "bad string, good string, n long, cost double").unionByName(odd), "misread")

    # what workers pass over: words whose bit no misreading has set (all others are joined)
    bad_bits = spark.sparkContext.broadcast(bits(misread, "bad"))
    rival_bits = None
    if bigrams:
        rivals = misread.groupBy("bad").agg(F.collect_set("good").alias("g")).where(F.size("g") > 1).select(F.explode("g").alias("key"))
        rival_bits = spark.sparkContext.broadcast(bits(rivals, "key"))

    def find(batches):
        import pyarrow as pa

        bad, rival = bad_bits.value, rival_bits.value if rival_bits else None
        known: dict[str, tuple[bool, bool]] = {}
        for b in batches:
            rows = []
            context: Counter = Counter()
            if len(known) > 500_000:
                known.clear()
            for rid, field, t in zip(*(b.column(i).to_pylist() for i in range(3))):
                got = _WORD.findall(t)
                for k, w in enumerate(got):
                    f = known.get(w)
                    if f is None:
                        f = known[w] = holds(bad, w), rival is not None and holds(rival, w)
                    if f[0]:
                        rows.append((rid, field, "word", w, got[k - 1] if k else ""))
                    if f[1] and k:
                        context[got[k - 1], w] += 1
                if not t.isascii():
                    for w in got:
                        if any(lig in w for lig in "ﬁﬂﬀ"):
                            rows.append((rid, field, "misread", w, None))
                    for c, _, _ in signs_in_context(t.replace("\n", "")):
                        if holds(bad, c):
                            rows.append((rid, field, "word", c, ""))
                if "\n" in t:
                    lines = layout(t)
                    for line, kind, standing in lines:
                        if kind in ("page_number", "both"):
                            rows.append((rid, field, "page_number", line, None))
                        if kind in ("header", "both"):
                            rows.append((rid, field, "header", line, None))
                        elif kind == "line?":
                            rows.append((rid, field, "line", line_key(line), None))
                            if _LATERAL.search(line):
                                rows.append((rid, field, "line_number", line_key(line), None))
                    # a line that may be a header may also lie within a divided word
                    for _, left, right in divided(running_text(lines)):
                        rows.append((rid, field, "divided", left + right, left + "-" + right))
                    if any(k == "line?" for _, k, _ in lines):
                        maybe = {line_key(x) for x, k, _ in lines if k == "line?"}
                        for _, left, right in divided(running_text(lines, maybe)):
                            rows.append((rid, field, "divided", left + right, left + "-" + right))
            rows += [(None, None, "bigram", w, p) for (p, w) in context]
            n = [1] * (len(rows) - len(context)) + list(context.values())
            yield pa.RecordBatch.from_arrays([*(pa.array([r[i] for r in rows], pa.string()) for i in range(5)), pa.array(n, pa.int64())], ["record_id", "field_name", "what", "key", "key2", "n"])

    found = materialise(texts.mapInArrow(find, "record_id string, field_name string, what string, key string, key2 string, n long"), "noise")
    return lexicon, misread, found


def find_noise(texts: DataFrame) -> DataFrame:
    """(record_id, field_name, noise): the kinds of noise of each text. ``texts``: record_id, field_name, text.

    Defined cases: null and empty texts have none; mere line breaks are none; a record in several rows gives each kind once; without
    any repeated word there is no lexicon and nothing is a misreading; texts of any length are read whole; other columns are
    ignored; an empty table gives an empty result.
    """
    lexicon, misread, found = _noise_frames(texts)
    ids = ["record_id", "field_name"]
    plain = found.where("what IN ('page_number', 'header', 'misread')").select(*ids, F.col("what").alias("noise"))
    wrong = found.where("what = 'word'").join(misread.select(F.col("bad").alias("key")).distinct(), "key", "left_semi").select(*ids, F.lit("misread").alias("noise"))
    heads = lexicon.where("kind = 'h' AND n >= 3").select("key")
    lines = found.where("what IN ('line', 'line_number')").join(heads, "key", "left_semi").select(*ids, F.when(F.col("what") == "line", "header").otherwise("page_number").alias("noise"))
    joined = lexicon.where("kind = 'w'").select("key", F.col("n").alias("jn"))
    compound = lexicon.where("kind = 'c'").select(F.col("key").alias("key2"), F.col("n").alias("cn"))
    split = found.where("what = 'divided'").join(joined, "key", "left").join(compound, "key2", "left").where(F.coalesce("jn", F.lit(0)) >= F.coalesce("cn", F.lit(0))).select(*ids, F.lit("hyphenation").alias("noise"))
    return plain.unionByName(wrong).unionByName(lines).unionByName(split).distinct()


def mend(text: str, words: dict[str, str], headers: set[str], compounds: set[str]) -> str:
    """A text repaired with the findings for it: headers and page numbers gone, divided words joined, misreadings replaced, lines joined
    to paragraphs."""
    if "\n" in text and "```" not in text:
        lines = running_text(layout(text), headers)
        out: list[str] = []
        cut = {k: (left, right) for k, left, right in divided(lines)}
        glue = ""
        for k, line in enumerate(lines):
            if not line:
                glue = "\n\n" if out and _END.search(out[-1]) else glue or " "
                continue
            if out:
                if glue == "" and _WIDE.search(out[-1][-1:]) and _WIDE.search(line[:1]):
                    out.append(line)
                elif glue == "\0":
                    out.append(line)
                else:
                    out.append((glue or " ") + line)
            else:
                out.append(line)
            glue = ""
            if k in cut:
                left, right = cut[k]
                keep = left + "-" + right in compounds
                out[-1] = out[-1] if keep else out[-1][:-1]
                glue = "\0"
        text = "".join(out)
    if words:
        text = _WORD.sub(lambda m: words.get(m.group(0), m.group(0)), text)
        if any(_CJK.search(w) for w in words):
            signs = list(text)
            for context, _, at in signs_in_context(text):
                if context in words:
                    signs[at] = words[context][1]
            text = "".join(signs)
    for good, bad in GROUPS[4:]:
        text = text.replace(bad, good)
    return text


def repair(texts: DataFrame) -> DataFrame:
    """(record_id, field_name, repaired): every text as continuous paragraphs. ``texts``: record_id, field_name, text.

    Of several candidates for a misread word the one of least weighted distance is taken, then the one seen most often after the same
    word, then the most frequent. Defined cases: a null or empty text comes out as it is; a text without noise keeps its words, its lines are
    joined; text with code fences keeps its lines; repeated rows give repeated rows; an empty table gives an empty result.
    """
    lexicon, misread, found = _noise_frames(texts, bigrams=True)
    ids = ["record_id", "field_name"]
    pairs = found.where("what = 'bigram'").groupBy(F.col("key").alias("good"), F.col("key2").alias("prev")).agg(F.sum("n").alias("seen"))
    hits = found.where("what = 'word'").select(*ids, F.col("key").alias("bad"), F.col("key2").alias("prev")).join(misread, "bad")
    best = hits.join(pairs, ["good", "prev"], "left").groupBy(*ids, "bad").agg(F.max_by("good", F.struct(-F.col("cost"), F.coalesce("seen", F.lit(0)), "n", "good")).alias("good"))
    words = best.groupBy(*ids).agg(F.map_from_entries(F.array_distinct(F.collect_list(F.struct("bad", "good")))).alias("words"))
    heads = found.where("what = 'line'").join(lexicon.where("kind = 'h' AND n >= 3").select("key"), "key", "left_semi").groupBy(*ids).agg(F.collect_set("key").alias("headers"))
    joined = lexicon.where("kind = 'w'").select("key", F.col("n").alias("jn"))
    compound = lexicon.where("kind = 'c'").select(F.col("key").alias("key2"), F.col("n").alias("cn"))
    keep = found.where("what = 'divided'").join(joined, "key", "left").join(compound, "key2").where(F.col("cn") > F.coalesce("jn", F.lit(0))).groupBy(*ids).agg(F.collect_set("key2").alias("compounds"))
    plain = texts.select(F.col("record_id").cast("string"), F.col("field_name").cast("string"), "text")
    j = plain.join(words, ids, "left").join(heads, ids, "left").join(keep, ids, "left")

    def run(batches):
        import pyarrow as pa

        for b in batches:
            out = [mend(t, dict(w or ()), set(h or ()), set(c or ())) if t else t for t, w, h, c in zip(*(b.column(i).to_pylist() for i in range(2, 6)))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.string())], ["record_id", "field_name", "repaired"])

    return j.select(*ids, "text", "words", "headers", "compounds").mapInArrow(run, "record_id string, field_name string, repaired string")
