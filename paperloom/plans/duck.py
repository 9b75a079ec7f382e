"""Building blocks of the DuckDB counterparts. RE2 has no look-around: patterns take and put back what they must not change."""

from __future__ import annotations

from paperloom.functions.text import ABBREVIATIONS

WS = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\p{Z}]"
PAGE = r"(?m)^<!--\s*PAGE\s+(\d+)\s*-->\s*$"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def rx(x: str, pattern: str, to: str, flags: str = "g") -> str:
    return f"regexp_replace({x}, {q(pattern)}, {q(to)}, '{flags}')"


def strip(x: str) -> str:
    return rx(x, rf"^{WS}+|{WS}+$", "")


def squeeze(x: str) -> str:
    return strip(rx(x, rf"{WS}+", " "))


def norm(x: str) -> str:
    """T-7."""
    sym = r"A-Za-z\x{370}-\x{3ff}\x{1d400}-\x{1d7ff}"
    x = f"translate(replace(replace({x}, chr(173), ''), chr(160), ' '), '’‘“”‐‑–', '''''\"\"---')"
    x = rx(x, r"\[([^\]]+)\]\([^)]+\)", r"\1")
    x = rx(x, r"\[([(){}\x{370}-\x{3ff}\x{1d400}-\x{1d7ff}]+)\]", r"\1")
    x = rx(x, r"[*_`]", "")
    x = rx(x, rf"([{sym}])\[(\d+)\]", r"\1\2")
    x = rx(x, rf"([{sym}])\^(\d+)", r"\1\2")
    x = rx(x, rf"(\pN){WS}*-{WS}*([A-Za-z])", r"\1-\2")
    for _ in range(2):
        x = rx(x, rf"([\pL\pN_])-{WS}*\n{WS}*([\pL\pN_])", r"\1\2")
    for _ in range(2):
        x = rx(x, r"([A-Za-z])-([A-Za-z])", r"\1\2")
    x = squeeze(x)
    x = rx(x, r"([\(\[\{])\s+", r"\1")
    x = rx(x, r"\s+([,.;:!?%)\]}，。；：！？])", r"\1")
    return rx(x, r"\)\s+\(", ")(")


#: The latest state of each paper.
STATE = "(SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY source_key ORDER BY try_strptime(updated_at, '%m/%d/%Y/%H:%M:%S') DESC NULLS LAST) AS rn FROM papers) WHERE rn = 1)"

#: (source_key, pidx, page, raw) of every page.
PAGES = (
    f"(SELECT source_key, i - 1 AS pidx, CAST(nums[i] AS INTEGER) AS page, {strip('bodies[i + 1]')} AS raw FROM (SELECT source_key, regexp_extract_all(text, {q(PAGE)}, 1) AS nums, string_split_regex(text, {q(PAGE)}) AS bodies FROM documents) d, unnest(range(1, len(nums) + 1)) AS u(i))"
)

#: (source_key, pidx, page, bidx, raw, norm) of every block.
BLOCKS = (
    f"(SELECT source_key, pidx, page, row_number() OVER (PARTITION BY source_key, pidx ORDER BY i) - 1 AS bidx, raw, norm FROM (SELECT *, {norm('raw')} AS norm FROM (SELECT source_key, pidx, page, i, {strip('parts[i]')} AS raw FROM (SELECT *, string_split_regex(raw, {q(f'{chr(92)}n{WS}*{chr(92)}n+')}) AS parts FROM {PAGES}) p, unnest(range(1, len(parts) + 1)) AS u(i))) WHERE norm <> '')"
)


def sentences(x: str) -> str:
    """T-10 as a list."""
    dot = "chr(57344)"
    x = squeeze(x)
    out = x
    for a in ABBREVIATIONS:
        words = a.replace(" ", r"\s+").split(".")
        pattern = r"(?i)\b(" + r")\.(".join(words) + r")\."
        to = " || ".join(f"'\\{i + 1}' || {dot}" for i in range(len(words)))
        out = f"regexp_replace({out}, {q(pattern)}, {to}, 'g')"
    for _ in range(2):
        out = f"regexp_replace({out}, {q(r'([0-9])[.]([0-9])')}, '\\1' || {dot} || '\\2', 'g')"
    for _ in range(2):
        out = f"regexp_replace({out}, {q(chr(92) + 'b([A-Za-z])[.]([A-Za-z])[.]')}, '\\1' || {dot} || '\\2' || {dot}, 'g')"
    out = f"regexp_replace({out}, {q(r'([.!?。！？])' + chr(92) + 's+')}, '\\1' || chr(57345), 'g')"
    return f"list_filter(list_transform(string_split({out}, chr(57345)), lambda s: {strip(f'replace(s, {dot}, chr(46))')}), lambda s: s <> '')"


def section(x: str, heading: str) -> str:
    import re

    p = q(rf"(?is)##\s+\*?\*?{re.escape(heading)}\*?\*?\s*\n(.*?)(?:\n##|\z)")
    return f"CASE WHEN regexp_matches({x}, {p}) THEN {strip(f'regexp_extract({x}, {p}, 1)')} END"


def term(x: str) -> str:
    """T-22."""
    return strip(rx(f"lower({strip(x)})", r"\s*\([^)]*\)", ""))


def keys(payload: str) -> str:
    """T-23 as a list."""
    per = []
    for f in ("term", "normalized", "std_label"):
        a = strip(f"coalesce({payload}['{f}'], '')")
        inner = f"list_filter(list_transform(regexp_extract_all({a}, '\\(([^()]+)\\)', 1), lambda s: {strip('s')}), lambda s: regexp_full_match(s, '[A-Za-z][A-Za-z0-9+_.-]{{1,15}}'))"
        per.append(f"list_transform(list_concat([{a}], {inner}), lambda s: {term('s')})")
    joined = f"list_filter(list_concat(list_concat({per[0]}, {per[1]}), {per[2]}), lambda k: k <> '')"
    return f"list_filter({joined}, lambda k, i: list_position({joined}, k) = i)"
