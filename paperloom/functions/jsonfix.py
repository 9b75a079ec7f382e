"""Recovery of JSON from model replies (N-1 to N-4). Sequential automata, so Arrow-batched Python."""

from __future__ import annotations

import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

LIMIT = 10**1000


def find_json(reply: str) -> str:
    """N-1: the content of the first fence (a ``json`` one first), else the first balanced object, else array, else the reply."""
    for opening in ("```json", "```"):
        at = reply.find(opening)
        if at >= 0:
            close = reply.find("```", at + len(opening))
            if close > at + len(opening):
                return reply[at + len(opening) : close].strip()
    for opening, closing in ("{}", "[]"):
        span = _balanced(reply, opening, closing)
        if span:
            return span
    return reply


def _balanced(s: str, opening: str, closing: str) -> str | None:
    at = s.find(opening)
    depth, quoted, k = 0, False, at
    while 0 <= k < len(s):
        ch = s[k]
        if ch == "\\":
            k += 1  # what follows is escaped
        elif ch == '"':
            quoted = not quoted
        elif not quoted and ch in (opening, closing):
            depth += 1 if ch == opening else -1
            if depth == 0:
                return s[at : k + 1]
        k += 1
    return None


def _has_entries(s: str) -> bool:
    try:
        v = json.loads(s)
    except (ValueError, RecursionError):
        return False
    return isinstance(v, dict) and "entries" in v


def repair_json(reply: str) -> str:
    """N-2: a reply that was cut closed after its last complete entry; unchanged where that gives no object with entries."""
    s = reply.strip()
    for fence in ("```json", "```"):
        s = s.removesuffix(fence).strip().removeprefix(fence).strip()
    for start in ("\n    {", "\n  {", '\n    "', '\n  "'):
        at = s.rfind(start)
        if at >= 100:
            head = s[:at].rstrip().removesuffix(",").rstrip()
            if head.endswith("}") and _has_entries(head + "\n    ]\n  }"):
                return head + "\n    ]\n  }"
    for end in range(len(s), max(len(s) - 500, 50), -1):
        head = s[:end].rstrip().removesuffix(",").rstrip()
        for tail in ("\n    ]\n  }", "\n  ]\n}", "]}", "] }"):
            if _has_entries(head + tail):
                return head + tail
    return s


def tame(value):
    """N-4: integers beyond any engine's reach as strings, at every depth."""
    if isinstance(value, dict):
        return {k: tame(v) for k, v in value.items()}
    if isinstance(value, list):
        return [tame(v) for v in value]
    if isinstance(value, int) and not isinstance(value, bool) and not -LIMIT < value < LIMIT:
        return str(value)
    return value


def decode_reply(reply: str | None) -> str | None:
    """N-1, N-3, N-2, N-4: the first JSON value of a reply as canonical text; null where none can be had."""
    if reply is None:
        return None
    for attempt in (find_json, lambda r: repair_json(find_json(r)), repair_json):
        s = attempt(reply)
        at = min((k for k in (s.find("{"), s.find("[")) if k >= 0), default=-1)
        if at < 0:
            continue
        try:
            value, _ = json.JSONDecoder().raw_decode(s[at:])
            return json.dumps(tame(value), ensure_ascii=False)
        except (ValueError, RecursionError):
            continue
    return None


@F.pandas_udf(T.StringType())
def recover_json(replies):
    """Column function of :func:`decode_reply`."""
    import pandas as pd

    return pd.Series([decode_reply(r if isinstance(r, str) else None) for r in replies], dtype=object)
