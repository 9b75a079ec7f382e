"""Byte-pair encoding by longest matches and backtracking, with the ids of a public rank file.

The ranks are read from a tokenizer file whose path is a parameter; nothing is trained and nothing is copied.

Method. Bytes are mapped one to one to Latin-1 characters, so that an Aho-Corasick automaton (pyahocorasick) over
the vocabulary can scan a piece of text. The automaton gives every vocabulary entry that starts at every position.
The encoder takes the longest one, checks that it may stand beside the token before it, and otherwise falls back to
the next shorter entry or takes the last token back. A position that failed once is never tried again, which bounds
the work by the number of matches: linear in the length of the piece. Whether two tokens may be adjacent (the merges
would not have joined or cut them otherwise) is decided by undoing their merges at the seam and memoised.
The result is the one of the exact merges.
"""

from __future__ import annotations

import base64
import os
from functools import lru_cache
from itertools import chain

DEFAULT_VOCAB = "/opt/tokenizers/byte_bpe_50k.tiktoken"

#: Fixed value: the public pattern that splits text before the merges of the rank files.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: A seam that always is a border of the pattern: one space between two characters that are no white space.
WORD_SEAM = r"(?<=\S)(?= \S)"

#: White space other than the space and the line feed; with it, or with a space beside white space, words are found by
#: WORD_SEAM, without it by the spaces alone.
RARE_SPACE = r"[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


class Bpe:
    """An encoder over one rank file; build it once a worker with :func:`encoder`."""

    #: Pieces kept in the memo; it is emptied when full, which changes no result.
    MEMO = 150_000

    def __init__(self, path: str):
        import ahocorasick
        import re

        import regex

        with open(path, "rb") as f:
            self.ids = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.of = {i: t for t, i in self.ids.items()}
        self.auto = ahocorasick.Automaton()
        for t, i in self.ids.items():
            self.auto.add_word(t.decode("latin-1"), (len(t), i))
        self.auto.make_automaton()
        self.pieces = regex.compile(PIECES).findall
        self.words = re.compile(WORD_SEAM).split
        self.rare_space = re.compile(RARE_SPACE).search
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.adjacent: dict[tuple[int, int], bool] = {}
        self.memo: dict[str, tuple[int, ...]] = {}
        self.wmemo: dict[str, tuple[int, ...]] = {}

    def split_of(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge made ``token``; None for a single byte.

        The last merge of a token is found by running the merges on its bytes until two parts are left.
        """
        if token in self.halves:
            return self.halves[token]
        word, ids = self.of[token], self.ids
        parts = [word[i : i + 1] for i in range(len(word))]
        while len(parts) > 2:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = ids.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        out = (ids[parts[0]], ids[parts[1]]) if len(parts) == 2 else None
        self.halves[token] = out
        return out

    def may_meet(self, left: int, right: int) -> bool:
        """Whether the exact merges leave ``left`` and ``right`` side by side."""
        key = (left, right)
        known = self.adjacent.get(key)
        if known is not None:
            return known
        ids, of = self.ids, self.of
        a, b, limit, ok = left, right, 1 << 60, True
        while True:
            joined = ids.get(of[a] + of[b])
            if joined is not None and joined < limit and self.split_of(joined) == (a, b):
                ok = False
                break
            if a > b:
                limit = a
                halves = self.split_of(a)
                if halves:
                    a = halves[1]
                if halves is None or a == limit:
                    limit = b + 1
                    halves = self.split_of(b)
                    if halves is None or halves[0] + 1 == limit:
                        break
                    b = halves[0]
            else:
                limit = b + 1
                halves = self.split_of(b)
                if halves:
                    b = halves[0]
                if halves is None or b + 1 == limit:
                    limit = a
                    halves = self.split_of(a)
                    if halves is None or halves[1] == limit:
                        break
                    a = halves[1]
        if len(self.adjacent) > 2_000_000:
            self.adjacent.clear()
        self.adjacent[key] = ok
        return ok

    def piece(self, raw: bytes) -> list[int]:
        """The ids of one piece of the pattern."""
        whole = self.ids.get(raw)
        if whole is not None:
            return [whole]
        n = len(raw)
        starts: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        for end, (length, token) in self.auto.iter(raw.decode("latin-1")):
            starts[end - length + 1].append((length, token))  # ends ascend, so the longest comes last
        dead = bytearray(n + 1)
        out: list[tuple[int, int]] = []  # token, index of its choice among the matches of its start
        at, choice = 0, len(starts[0]) - 1
        while at < n:
            options = starts[at]
            took = False
            while choice >= 0:
                length, token = options[choice]
                if not dead[at + length] and (not out or self.may_meet(out[-1][0], token)):
                    out.append((token, choice))
                    at += length
                    choice = len(starts[at]) - 1 if at < n else -1
                    took = True
                    break
                choice -= 1
            if not took:
                dead[at] = 1
                if not out:
                    raise ValueError("the vocabulary lacks a byte of the text")
                token, last = out.pop()
                at -= len(self.of[token])
                choice = last - 1
        return [t for t, _ in out]

    def _word(self, word: str) -> tuple[int, ...]:
        memo, out = self.memo, []
        for p in self.pieces(word):
            ids = memo.get(p)
            if ids is None:
                ids = tuple(self.piece(p.encode("utf-8", "surrogatepass")))
                if len(p) <= 64:
                    if len(memo) >= self.MEMO:
                        memo.clear()
                    memo[p] = ids
            out.extend(ids)
        return tuple(out)

    def _parts(self, text: str) -> list[tuple[int, ...]]:
        """The ids of every word of a non-empty text, in order."""
        if "  " in text or " \n" in text or "\n " in text or self.rare_space(text):
            words = self.words(text)
        else:
            first, *rest = text.split(" ")
            words = [first, *map(" ".__add__, rest)]
        memo = self.wmemo
        parts = list(map(memo.get, words))
        if None in parts:
            for k, ids in enumerate(parts):
                if ids is None:
                    w = words[k]
                    ids = parts[k] = self._word(w)
                    if len(w) <= 64:
                        if len(memo) >= self.MEMO:
                            memo.clear()
                        memo[w] = ids
        return parts

    def encode(self, text: str | None) -> list[int]:
        """The ids of a text, without special tokens; an empty or null text has none."""
        return list(chain.from_iterable(self._parts(text))) if text else []

    def count(self, text: str | None) -> int:
        """The number of ids of a text."""
        return sum(map(len, self._parts(text))) if text else 0


@lru_cache(maxsize=4)
def _encoder(path: str, stamp: float) -> Bpe:
    return Bpe(path)


def encoder(path: str = DEFAULT_VOCAB) -> Bpe:
    """The encoder of ``path``, one for each worker process."""
    return _encoder(path, os.path.getmtime(path))
