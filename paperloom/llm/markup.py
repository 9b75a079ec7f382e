"""Problem 3: markup residue (HTML, Markdown, wiki, LaTeX) in texts.

Method. A text is read into a tree of DOM nodes: every piece that has the form of markup, with what it encloses. Gradient-boosted
trees over features of a node (form, name, attribute tokens, depth, siblings, density of its subtree, surroundings) give the
log odds that the piece is markup and no plain sign ("x < 3", "$5 and $10", "max_step_size"). Decoding is hierarchical: inside code,
formulas and comments that are kept as nodes nothing else can be markup, and the assignment with the greatest sum of log odds
under that rule is taken, from the leaves up.

The trees are fitted here, on a bounded set of texts of our own into which markup and plain signs are put (:data:`TRAINING`).
"""

from __future__ import annotations

import random
import re
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.gbt import Boosted
from paperloom.llm.langid import SEEDS

#: Texts of the generated training set.
TRAINING = 2000

LANGS = ("html", "markdown", "wiki", "latex")

#: The forms of nodes: name, language, pattern, whether the content is opaque (code, formula, comment). No form has a greatest length: what
#: it encloses ends at its closing sign, at a sign that opens it anew or at the line's or paragraph's end, so every text is read in
#: bounded time.
FORMS = (
    ("comment", "html", r"<!--(?!\s*PAGE \d+\s*-->)(?:(?!<!--).)*?-->", True),
    ("pre", "html", r"<(?P<pretag>pre|code|script|style|math)\b[^<>]*>(?:(?!<(?P=pretag)\b).)*?</(?P=pretag)>", True),
    ("tag", "html", r"</?[A-Za-z][A-Za-z0-9:-]*(?:\s+[^<>\n]*)?/?>", False),
    ("escaped_tag", "html", r"&lt;/?[A-Za-z][A-Za-z0-9]*(?:\s[^&\n]*)?/?&gt;", False),
    ("entity", "html", r"&(?:[A-Za-z]{2,31}\d{0,2}|#\d{2,7}|#[xX][0-9A-Fa-f]{2,6});", False),
    ("fence", "markdown", r"(?m:^[ \t]*)```.*?(?:```|\Z)", True),
    ("l_verbatim", "latex", r"\\begin\{(?P<env>verbatim|equation|align|lstlisting|math|displaymath|eqnarray|gather)(?P<star>\*?)\}.*?(?:\\end\{(?P=env)(?P=star)\}|\Z)", True),
    ("l_table", "latex", r"\\begin\{(?P<tab>tabularx?|longtable|array)(?P<tabstar>\*?)\}.*?(?:\\end\{(?P=tab)(?P=tabstar)\}|\Z)", False),
    ("l_display", "latex", r"\\\[(?:(?!\\\[|\n\s*\n).)+?\\\]|\\\((?:(?!\\\(|\n\s*\n).)+?\\\)|\$\$[^$]+\$\$", True),
    ("l_math", "latex", r"\$[^$\n]+\$", True),
    ("l_env", "latex", r"\\(?:begin|end)\{[a-zA-Z]+\*?\}(?:\[[^\]\n]*\])?", False),
    ("l_cite", "latex", r"~?\\(?:cite|ref|label|eqref|citep|citet|autoref|pageref)\w*(?:\[[^\]\n]*\])?\{[^{}\n]*\}", False),
    ("l_cmd", "latex", r"\\[a-zA-Z]{2,}\*?(?:\[[^\]\n]*\])?(?:\{[^{}\n]*\})?", False),
    ("l_group", "latex", r"\{\\[a-z]{2,}\s[^{}\n]*\}", False),
    ("l_quote", "latex", r"``[^`'\n]+''", False),
    ("l_break", "latex", r"\\\\(?=\s|$)", False),
    ("l_escape", "latex", r"\\[%&$#_]", False),
    ("w_table", "wiki", r"\{\|.*?(?:\|\}|\Z)", False),
    ("w_template", "wiki", r"\{\{[^{}]+\}\}", False),
    ("w_link", "wiki", r"\[\[[^\[\]\n]+\]\]", False),
    ("w_extlink", "wiki", r"\[https?://[^\s\]]+(?:\s[^\]\n]*)?\]", False),
    ("w_head", "wiki", r"(?m:^)[ \t]*(?P<eq>={2,6})[ \t]*[^=\n]+?[ \t]*(?P=eq)[ \t]*(?m:$)", False),
    ("w_quote", "wiki", r"'{2,5}[^'\n]+'{2,5}", False),
    ("w_switch", "wiki", r"__(?:NOTOC|TOC|NOEDITSECTION|FORCETOC|NOGALLERY|NOINDEX)__", False),
    ("w_indent", "wiki", r"(?m:^):+(?=[^\s:])", False),
    ("m_image", "markdown", r"!\[[^\[\]\n]*\]\([^()\s]+\)", False),
    ("m_link", "markdown", r"\[[^\[\]\n]+\]\([^()\s]+\)", False),
    ("m_footnote", "markdown", r"\[\^[\w-]+\]:?", False),
    ("m_head", "markdown", r"(?m:^)[ \t]*#{1,6}[ \t]+[^\n]+", False),
    ("m_table", "markdown", r"(?m:^)[ \t]*\|[^\n]*\|[ \t]*\n[ \t]*\|[ :|-]*-[ :|-]*\|[ \t]*(?:\n[ \t]*\|[^\n]*\|[ \t]*)*", False),
    ("m_code", "markdown", r"`[^`\n]+`", True),
    ("m_strike", "markdown", r"~~[^~\n]+~~", False),
    ("m_strong", "markdown", r"\*{2,3}[^*\n]+\*{2,3}", False),
    ("m_under", "markdown", r"__[^_\n]+__", False),
    ("m_em", "markdown", r"(?<![\w*])\*(?=[^\s*])[^*\n]+(?<=[^\s*])\*(?![\w*])|(?<![\w_])_(?=[^\s_])[^_\n]+(?<=[^\s_])_(?![\w_])", False),
    ("star_item", "markdown", r"(?m:^)[ \t]*\*[ \t]+(?=\S)", False),
    ("m_item", "markdown", r"(?m:^)[ \t]*[-+][ \t]+(?=\S)(?!\d+ ?[-—–])", False),
    ("m_number", "markdown", r"(?m:^)[ \t]*\d{1,2}\.[ \t]+(?=\S)", False),
    ("m_rule", "markdown", r"(?m:^)[ \t]*(?:-{3,}|={3,}|\*{3,}|_{3,})[ \t]*(?m:$)", False),
    ("m_cite", "markdown", r"(?m:^)>[ \t]+\S+", False),
)
_KIND = {name: i for i, (name, *_) in enumerate(FORMS)}
_LANG = {name: lang for name, lang, *_ in FORMS}
_OPAQUE = {name for name, _, _, o in FORMS if o}
_MASTER = re.compile("|".join(f"(?P<{name}>{pattern})" for name, _, pattern, _ in FORMS), re.S)
#: Where a piece may begin; each branch starts with one sign, so that a search skips plain text quickly.
_SIGN = re.compile(
    r"<(?=[A-Za-z/!])|&(?=#?\w{2,33};|[a-z]{2};)|\\(?=[A-Za-z\[(\\%&$#_])|`|~(?=[~\\])|\*(?=[^\s])|_(?=\w)|!(?=\[)|\[(?=[\[^h]|[^\[\]\n]+\]\()|\{(?=[\\{|])|\$(?=\$|[^$\n]+\$)|'(?=')|\n(?=[ \t]*(?:[#>:+*=|-]|\d{1,2}\.\s|```))"
)
_LINE = re.compile(r"[ \t]*(?:[#>:+*=|-]|\d{1,2}\.\s|```)")

#: Names that HTML and LaTeX define.
HTML_NAMES = frozenset("a abbr article b blockquote body br caption center cite code col dd div dl dt em fig figure font footer h1 h2 h3 h4 h5 h6 head header hr html i img ins kbd label li link mark math meta nav ol p pre q s script section small span strike strong style sub sup table tbody td tfoot th thead title tr tt u ul var".split())
LATEX_NAMES = frozenset("emph textbf textit texttt textsc underline section subsection subsubsection paragraph footnote cite ref label item begin end includegraphics caption url href frac sqrt sum alpha beta gamma lambda mathbf mathrm it bf em tt large small".split())

_NAME = re.compile(r"[A-Za-z]+\d?")
_MATH = re.compile(r"[\\^=+{}]|_\w")


class Node:
    __slots__ = ("kind", "start", "end", "text", "parent", "kids", "depth", "logit", "on")

    def __init__(self, kind: str, start: int, end: int, text: str):
        self.kind, self.start, self.end, self.text = kind, start, end, text
        self.parent: Node | None = None
        self.kids: list[Node] = []
        self.depth = 0
        self.logit = 0.0
        self.on = False


def _scan(text: str, base: int, out: list[Node], inner: list[tuple[str, int]]) -> None:
    """Add the nodes of a stretch of text that starts at ``base``, and to ``inner`` the stretches that they enclose."""
    at, n = 0, len(text)
    first = _LINE.match(text) is not None
    while at < n:
        if first:
            pos, first = 0, False
        else:
            sign = _SIGN.search(text, at)
            if sign is None:
                return
            pos = sign.end() if text[sign.start()] == "\n" else sign.start()
        m = _MASTER.match(text, pos)
        if m is None or m.end() == pos:
            at = pos if pos > at else at + 1
            if text[pos : pos + 1] and at == pos and text[pos] != "\n" and pos != 0 and text[pos - 1] != "\n":
                at = pos + 1
            continue
        kind = m.lastgroup if m.lastgroup in _KIND else next(k for k in _KIND if m.group(k) is not None)
        s, e = m.span()
        at = e
        piece = m.group()
        out.append(Node(kind, base + s, base + e, piece))
        # what a piece encloses is read too, also inside opaque ones: decoding decides
        if e - s > 4 and kind not in ("tag", "entity", "escaped_tag", "comment"):
            lead = 1
            while lead < len(piece) and piece[lead] == piece[0]:
                lead += 1
            if lead < len(piece) - 1:
                inner.append((piece[lead:], base + s + lead))


def parse(text: str) -> list[Node]:
    """The nodes of a text in order, linked to a tree by enclosure; paired HTML tags enclose what lies between them."""
    nodes: list[Node] = []
    inner = [(text, 0)]
    while inner:
        _scan(*inner.pop(), nodes, inner)
    if not nodes:
        return nodes
    spans: list[tuple[int, int, Node]] = []
    stack: list[tuple[str, Node]] = []
    for n in sorted(nodes, key=lambda n: (n.start, -n.end)):
        reach = n.end
        if n.kind == "tag":
            name = (_NAME.search(n.text) or _NAME.search("x")).group().lower()
            if n.text[1] == "/":
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == name:
                        opened = stack[k][1]
                        spans = [(a, n.end if o is opened else b, o) for a, b, o in spans]
                        del stack[k:]
                        break
            elif not n.text.endswith("/>"):
                stack.append((name, n))
        spans.append((n.start, reach, n))
    open_: list[tuple[int, Node]] = []
    out = []
    for a, b, n in spans:
        while open_ and open_[-1][0] <= a:
            open_.pop()
        if open_:
            n.parent = open_[-1][1]
            n.parent.kids.append(n)
            n.depth = n.parent.depth + 1
        open_.append((b, n))
        out.append(n)
    return out


def _density(n: Node) -> int:
    """Characters of the nodes below, capped at the length of the node by callers."""
    return sum(k.end - k.start for k in n.kids)


def features(nodes: list[Node], text: str) -> list[tuple]:
    """One row a node; quantities are coarse, so that rows repeat and their scores can be kept."""
    per: dict[str, int] = {}
    kinds: dict[str, int] = {}
    for n in nodes:
        per[_LANG[n.kind]] = per.get(_LANG[n.kind], 0) + 1
        kinds[n.kind] = kinds.get(n.kind, 0) + 1
    rows = []
    for n in nodes:
        t, lang = n.text, _LANG[n.kind]
        inner = t.strip("*_`~$'[]{}<>|=# \n")
        name = _NAME.search(t)
        known = 0
        if n.kind in ("tag", "escaped_tag", "pre"):
            known = 1 if name and name.group().lower() in HTML_NAMES else 0
        elif lang == "latex" and name:
            known = 1 if name.group() in LATEX_NAMES else 0
        before = text[n.start - 1] if n.start else "\n"
        after = text[n.end] if n.end < len(text) else "\n"
        siblings = n.parent.kids if n.parent else ()
        digits = sum(c.isdigit() for c in inner[:40])
        rows.append(
            (
                _KIND[n.kind], known, min(len(t), 60) // 4, min(inner.count(" "), 12), 3 * digits // max(1, min(len(inner), 40)) if inner else 3,
                1 if _MATH.search(inner) else 0, 1 if inner[:1].isspace() or t[1:2].isspace() else 0, 1 if t[-2:-1].isspace() else 0,
                1 if before.isalnum() else 0, 1 if after.isalnum() else 0, 1 if before == "\n" else 0,
                min(kinds[n.kind], 4), min(per[lang], 5), min(len(nodes) - per[lang], 5), min(per.get("wiki", 0), 3), min(n.depth, 3), min(len(siblings), 4),
                4 * min(_density(n), len(t)) // max(1, len(t)), min(t.count("="), 3), min(len(n.kids), 3), 1 if inner[:1].isdigit() else 0, 1 if n.parent is not None and n.parent.kind in _OPAQUE else 0,
            )
        )
    return rows


def decode(nodes: list[Node]) -> None:
    """Set ``on`` of each node: the assignment of greatest total log odds in which no opaque node that is markup has markup below."""

    def free(n: Node) -> float:
        """The best total of the subtree; keeps the choice in ``on`` of the node itself."""
        below = sum(free(k) for k in n.kids)
        if n.kind in _OPAQUE:
            n.on = n.logit > max(0.0, below) if below else n.logit > 0
            return n.logit if n.on else below
        n.on = n.logit > 0
        return max(0.0, n.logit) + below

    def silence(n: Node, off: bool) -> None:
        if off:
            n.on = False
        for k in n.kids:
            silence(k, off or (n.on and n.kind in _OPAQUE))

    for n in nodes:
        if n.parent is None:
            free(n)
            silence(n, False)


def analyse(text: str, model: Boosted) -> list[Node]:
    nodes = parse(text)
    if nodes:
        for n, row in zip(nodes, features(nodes, text)):
            n.logit = model.logit(row)
        decode(nodes)
    return nodes


def language(n: Node, nodes: list[Node]) -> str:
    """The language of a node; a list star and a leading number sign belong to the language of the text's other markup."""
    if n.kind == "star_item":
        wiki = sum(1 for m in nodes if m.on and _LANG[m.kind] == "wiki")
        md = sum(1 for m in nodes if m.on and _LANG[m.kind] == "markdown" and m.kind != "star_item")
        return "wiki" if wiki and not md else "markdown"
    return _LANG[n.kind]


# ---------------------------------------------------------------------------------------------------------------------
# training


def _inject(rng: random.Random) -> tuple[str, list[tuple[int, int, str]]]:
    """A text with (start, end, language) of its markup."""
    seed = rng.choice(list(SEEDS.values()))
    cjk = seed[0] > "⺀"
    words = list(seed[rng.randrange(0, 30) :]) if cjk else seed.split()
    lo = rng.randrange(0, max(1, len(words) - 45))
    short = rng.random() < 0.3  # like a title
    words = words[lo : lo + (rng.randrange(4, 12) if short else rng.randrange(20, 45))]
    glue = "" if cjk else " "
    langs = rng.sample(LANGS, rng.choice((0, 0, 1, 1, 1, 2)))
    parts: list[tuple[str, str | None]] = []
    i = 0
    tok = lambda: "".join(rng.choice("bcdfghkmnprstvwz") for _ in range(6))
    num = lambda: str(rng.randrange(2, 99))
    url = lambda: "/".join(tok() for _ in range(rng.choice((1, 1, 2, 30, 60))))
    short_math = lambda: rng.choice((r"x_i = \sqrt{n}", r"\alpha = e^{-kt}", r"a = \frac{a}{b}", r"y = \mathbf{W}x", r"\beta_k = \sum_{i=1}^{n} w_i", "E=mc^2", "n+1", r"\lambda", "x^2", "k"))
    math = lambda: " + ".join(short_math() for _ in range(rng.choice((1, 1, 1, 1, 2, 3, 6, 14))))
    span = lambda: glue.join(rng.choice(words) for _ in range(rng.choice((20, 40, 70)))) if rng.random() < 0.08 else w
    code = lambda: rng.choice((f"n <- {num()}\nm <- n * 2", f"load rows\nsort by key\ntake {num()}", "fit = run(x, k=30)\nprint(fit.loss)", "for i in range(3):\n    print(i)", "a_b = x[0] * y[1]", "#include <x>\nint a = b & c;"))
    while i < len(words):
        k = rng.randrange(1, 4)
        w = glue.join(words[i : i + k])
        i += k
        r = rng.random()
        if langs and r < (0.5 if short else 0.3) or langs and short and i == k:
            lang = rng.choice(langs)
            if rng.random() < 0.08:
                w = num()
            if lang == "html":
                tag = rng.choice(("i", "b", "em", "strong", "sub", "sup", "span", "a", "p", "FONT", "u", "div", "jats:p", "h3", "td", "li", "small", "tt"))
                attr = rng.choice(("", "", "", f' class="{tok()}"', f' href="https://{url()}.org/x"', " size=2", f' id="{tok()}" style="x:y"'))
                parts.append(
                    (
                        rng.choice(
                            (
                                f"<{tag}{attr}>{w}</{tag}>", f"<{tag}{attr}>{w}</{tag}>", f"{w}<br/>", f"<{tag}>{w}", f"{w}</{tag}>", f"&lt;{tag[:3]}&gt;{w}&lt;/{tag[:3]}&gt;", f"&nbsp;{w}", f"{w}&amp;", f"&#8211; {w}", f"&ldquo;{w}&rdquo;",
                                f"&#x201C;{w}", f"<!-- {tok()} --> {w}", f"\n<pre><code>{code()}</code></pre>\n", f"<ul><li>{w}</li><li>{w}</li></ul>", f"<table><tr><td>{num()}</td><td>{num()}</td></tr></table> {w}", f"<h3>{w}</h3><p>{w}</p>", f"<code>{w}</code>",
                            )
                        ),
                        lang,
                    )
                )
            elif lang == "markdown":
                parts.append(
                    (
                        rng.choice(
                            (
                                f"**{span()}**", f"*{span()}*", f"***{w}***", f"__{span()}__", f"_{w}_", f"`{w}`", f"~~{w}~~", f"[{w}](https://{url()}.org/{num()})", f"![{w}](img_{num()}.png)", f"{w}[^{num()[0]}]", f"\n## {w}\n\n", f"\n### **{w}**\n", f"\n```python\n{code()}\n```\n",
                                f"\n| k | v |\n|---|---|\n| a | {num()} |\n", f"\n- {w}\n- {w}\n", f"\n+ {w}\n+ {w}\n", f"\n* {w}\n* {w}\n", f"\n1. {w}\n2. {w}\n", f"\n> {w}\n", f"\n# {w}\n", f"\n{w}\n-----\n", f"\n{w}\n=====\n",
                            )
                        ),
                        lang,
                    )
                )
            elif lang == "wiki":
                parts.append(
                    (
                        rng.choice(
                            (
                                f"[[{w}]]", f"[[{tok().title()}|{w}]]", f"''{span()}''", f"'''{span()}'''", f"\n== {w} ==\n", f"\n=== {w} ===\n* {w}\n* {w}\n", "{{" + f"cite|{tok()}|2001" + "}} " + w, "\n{{box|" + w + "}}\n", f"[https://{tok()}.org {w}]", f"\n[[File:{tok()}.png|thumb|{w}]]\n",
                                '\n{| class="wikitable"\n! k !! v\n|-\n| a || ' + num() + "\n|}\n", f"\n__NOTOC__\n:{w}\n", "'''''" + w + "'''''",
                            )
                        ),
                        lang,
                    )
                )
            else:
                cmd = rng.choice(("emph", "textbf", "textit", "footnote", "texttt", "underline", "textsc"))
                parts.append(
                    (
                        rng.choice(
                            (
                                f"\\{cmd}{{{span()}}}", f"{w}~\\cite{{{tok()}2001}}", f"(Fig.~\\ref{{fig:{tok()}}}) {w}", f"${math()}$ {w}", f" ${math()}${w}", f"\\({math()}\\) {w}", f"\\[ {math()} \\] {w}", f"$${math()}$$ {w}", f"\n\\begin{{equation}}\n{math()}\n\\end{{equation}}\n",
                                f"\n\\begin{{itemize}}\n\\item {w}\n\\item {w}\n\\end{{itemize}}\n", f"\n\\begin{{tabular}}{{ll}}\n{w} & {num()} \\\\\n{w} & {num()} \\\\\n\\end{{tabular}}\n", f"\n\\begin{{verbatim}}\n{code()}\n\\end{{verbatim}}\n", f"{{\\it {w}}}", f"``{w}''", f"{w}.\\\\ ", f"{w} \\%", f"\\section{{{w}}}\n", f"\n\\subsection*{{{w}}}\n", f"{{\\bf {w}}}", f"\\cite{{{tok()}}}", f"{w}\\footnote{{{w}}}",
                            )
                        ),
                        lang,
                    )
                )
        elif r < 0.5:
            parts.append(
                (
                    rng.choice(
                        (
                            f"x < {num()} and y > {num()}", f"(p < 0.0{num()})", f"R&D {w}", f"between ${num()} and ${num()} per unit", f"from ${num()},000 to ${num()} in total", "max_step_size", "the set {a, b, c}", "[12] and [3, 4]", f"[{num()}]", "2 * 2 designs", "C# and C++", "mean = 0.5 * (a + b)", f"(part_{num()})",
                            f"\n[{num()}]\n", f"\n- {num()} -\n", f"\n— {num()} —\n", "~ 5", "x^2", "a <b> c"[:1], "AT&T", "i <- j", f"#{num()}", "f(x) = 3 * x * y", "snake_case_name and other_long_name", "'tis the ''", "5' 7''", "it's the authors' data", f"p* = 0.{num()}**", "5*", "a | b", f"\n> {num()} in all sites", "1 == 2", "see p_1_2 and q_3_4",
                            f"\n{num()}. 5 percent", "<3", "a<b and c>d", "$x", f"US${num()}", "{n}", "\\", "--", "rock & roll", "Q&A; then", "N = 312 records, two raters",
                        )
                    ),
                    None,
                )
            )
        else:
            parts.append((w, None))
    out, spans = "", []
    for s, lang in parts:
        if out and not out.endswith("\n") and not s.startswith("\n"):
            out += glue
        if lang:
            spans.append((len(out), len(out) + len(s), lang))
        out += s
    return out, spans


@lru_cache(maxsize=1)
def model() -> Boosted:
    """The fitted trees; deterministic."""
    rng = random.Random(20)
    xs, ys = [], []
    for _ in range(TRAINING):
        text, spans = _inject(rng)
        nodes = parse(text)
        for n, row in zip(nodes, features(nodes, text)):
            inside = [s for s in spans if s[0] <= n.start and n.end <= s[1] + 1]
            good = bool(inside) and (inside[0][2] == _LANG[n.kind] or n.kind == "star_item" and inside[0][2] == "wiki")
            if good and n.parent is not None and n.parent.kind in _OPAQUE and n.parent.start >= inside[0][0]:
                good = False  # signs inside code and formulas
            xs.append(row)
            ys.append(1.0 if good else 0.0)
    return Boosted.fit(_onehot(xs), ys)


def _onehot(rows: list[tuple]) -> list[tuple]:
    return [expand(r) for r in rows]


def expand(row: tuple) -> tuple:
    """A row with the form spread over one column each."""
    return tuple(1 if k == row[0] else 0 for k in range(len(FORMS))) + row[1:]


class _Wide:
    """Scores rows of :func:`features` with trees over their spread form, each distinct row once."""

    def __init__(self, trees: Boosted):
        self.trees, self.memo = trees, {}

    def logit(self, row: tuple) -> float:
        out = self.memo.get(row)
        if out is None:
            if len(self.memo) > 200_000:
                self.memo.clear()
            out = self.memo[row] = self.trees.logit(expand(row))
        return out


_own: dict[int, _Wide] = {}


def _worker_model(trees: list[tuple], bias: float) -> _Wide:
    key = hash((bias, len(trees), str(trees[0])[:80]))
    if key not in _own:
        _own.clear()
        _own[key] = _Wide(Boosted(trees, bias))
    return _own[key]


# ---------------------------------------------------------------------------------------------------------------------
# conversion

_ENTITY = re.compile(r"&(?:[A-Za-z]{2,8}\d{0,2}|#\d{2,6}|#[xX][0-9A-Fa-f]{2,6});")


def _plain(n: Node, inner) -> str:
    """The text that takes the place of a node that is markup."""
    import html

    t, k = n.text, n.kind
    if k in ("comment", "w_switch", "escaped_tag"):
        return ""
    if k == "l_cite":
        keys = t[t.rindex("{") + 1 : -1].strip()
        return "" if "\\label" in t or not keys else (" [" if t[0] == "~" else "[") + keys + "]"
    if k == "m_footnote":
        return "[" + t.strip("[^]:") + "]" + (":" if t.endswith(":") else "")
    if k == "l_table":
        body = re.sub(r"^\\begin\{[^}]*\}(?:\[[^\]]*\])?(?:\{[^{}]*\}){0,2}|\\end\{[^}]*\}$|\\(?:hline|toprule|midrule|bottomrule|cline\{[^}]*\})", "", t)
        rows = [" | ".join(inner(c.strip()) for c in re.split(r"(?<!\\)&", r)) for r in body.split("\\\\") if r.strip()]
        return "\n" + "\n".join(rows) + "\n"
    if k == "entity":
        return html.unescape(t)
    if k == "pre":
        body = html.unescape(re.sub(r"<[^<>]*>", "", t)).strip("\n")
        return f"\n```\n{body}\n```\n" if "\n" in body or t[1:4].lower() == "pre" else body
    if k == "tag":
        name = (_NAME.search(t) or _NAME.search("x")).group().lower()
        closing = t[1] == "/"
        if re.fullmatch(r"h[1-6]", name):
            return "\n" if closing else "\n" + "#" * int(name[1]) + " "
        if name == "li":
            return "" if closing else "\n- "
        if name in ("p", "div", "ul", "ol", "table", "tr", "br", "section", "blockquote", "hr"):
            return "\n"
        return " | " if name in ("td", "th") and not closing else ""
    if k == "fence":
        return "\n" + t.strip() + "\n"
    if k == "l_verbatim":
        body = re.sub(r"^\\begin\{[^}]*\}|\\end\{[^}]*\}$", "", t).strip("\n")
        return f"\n```\n{body}\n```\n" if re.match(r"\\begin\{(?:verbatim|lstlisting)", t) else f"\n$${body}$$\n"
    if k == "l_display":
        body = t[2:-2].strip()
        return f"${body}$" if t.startswith("\\(") else f"\n$${body}$$\n"
    if k == "l_math":
        return t
    if k == "l_env":
        return "\n"
    if k == "l_cmd":
        m = re.match(r"\\([a-zA-Z]+)\*?(?:\[[^\]\n]*\])?(?:\{(.*)\})?$", t, re.S)
        if not m:
            return t
        if m[1] == "item":
            return "\n- " + (m[2] or "")
        if m[1] in ("section", "subsection", "subsubsection", "paragraph"):
            return "\n" + "#" * (1 + ("section", "subsection", "subsubsection", "paragraph").index(m[1])) + " " + (m[2] or "") + "\n"
        if m[1] == "footnote" and m[2]:
            return " (" + inner(m[2]) + ")"
        return inner(m[2]) if m[2] else ""
    if k == "l_group":
        return inner(re.sub(r"^\{\\[a-z]+\s|\}$", "", t))
    if k == "l_quote":
        return '"' + inner(t[2:-2]) + '"'
    if k == "l_break":
        return "\n"
    if k == "l_escape":
        return t[1:]
    if k == "w_table":
        rows = [re.findall(r"(?:^|[|!])[|!]?\s*([^|!\n]+)", r) for r in re.split(r"\n\|-[^\n]*", t[2:].rstrip("|}"))]
        return "\n" + "\n".join(" | ".join(c.strip() for c in r) for r in rows if r) + "\n"
    if k == "w_template":
        parts = t[2:-2].split("|")
        return "" if parts[0].strip().lower() in ("cite", "ref", "citation", "sfn") else "\n# " + inner(parts[-1]) + "\n" if len(parts) == 2 else ""
    if k == "w_link":
        return inner(t[2:-2].split("|")[-1])
    if k == "w_extlink":
        return inner(t[1:-1].split(" ", 1)[1]) if " " in t else ""
    if k == "w_head":
        level = len(t.strip()) - len(t.strip().lstrip("="))
        return "\n" + "#" * level + " " + inner(t.strip().strip("=").strip()) + "\n"
    if k == "w_quote":
        return inner(t.strip("'"))
    if k == "w_indent":
        return ""
    if k in ("m_image", "m_link"):
        return inner(t[t.index("[") + 1 : t.rindex("](")])
    if k == "m_head":
        m = re.match(r"\s*(#+)\s*(.*)", t, re.S)
        return m[1] + " " + inner(m[2].strip("# "))
    if k == "m_code":
        return t.strip("`")
    if k in ("m_strike", "m_strong", "m_under", "m_em"):
        return inner(t.strip(t[0]))
    if k in ("star_item", "m_item"):
        return "- "
    if k == "m_rule":
        return ""
    if k == "m_cite":
        return t.lstrip("> ")
    return t  # m_table, m_number: their plain form is their reading form


def convert(text: str, nodes: list[Node]) -> str:
    """Clean text: headings as ``# ``, list items as ``- ``, code between fences, formulas between dollar signs."""
    if not any(n.on for n in nodes):
        return text

    def inside(lo: int, hi: int) -> str:
        out, at = [], lo
        for n in nodes:
            if n.on and at <= n.start and n.end <= hi:
                out.append(text[at : n.start])
                # nodes within the piece are converted by its own text
                out.append(_plain(n, lambda s, n=n: _nested(s, n)))
                at = n.end
        out.append(text[at:hi])
        return "".join(out)

    def _nested(s: str, n: Node) -> str:
        for k in nodes:
            if k.on and k is not n and n.start <= k.start and k.end <= n.end and k.text in s:
                s = s.replace(k.text, _plain(k, lambda x: x), 1)
        return s

    out = re.sub(r"[ \t]+\n", "\n", inside(0, len(text)))
    return re.sub(r"\n{3,}", "\n\n", out).strip("\n")


def clean(texts: DataFrame, with_text: bool = True) -> DataFrame:
    """(record_id, field_name, markup, clean): the languages of the markup of each text (sorted, maybe none) and its clean text.

    ``texts``: record_id, field_name, text. Defined cases: a null or empty text has no languages and comes out as it is; page markers are
    no markup; texts of any length are read whole; repeated rows give repeated rows; other columns are ignored; an empty table
    gives an empty result. With ``with_text`` false the texts are left out and ``clean`` is null.
    """
    fitted = model()
    trees, bias = fitted.trees, fitted.bias
    schema = "record_id string, field_name string, markup array<string>, clean string"

    def run(batches):
        import pyarrow as pa

        m = _worker_model(trees, bias)
        for b in batches:
            marks, out = [], []
            for t in b.column(2).to_pylist():
                nodes = analyse(t, m) if t else []
                marks.append(sorted({language(n, nodes) for n in nodes if n.on}))
                out.append(convert(t, nodes) if with_text and t else t if with_text else None)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(marks, pa.list_(pa.string())), pa.array(out, pa.string())], ["record_id", "field_name", "markup", "clean"])

    return texts.select(F.col("record_id").cast("string"), F.col("field_name").cast("string"), "text").mapInArrow(run, schema)
