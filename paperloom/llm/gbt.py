"""Gradient-boosted regression trees for binary labels on small, bounded training sets (numpy only)."""

from __future__ import annotations


class Boosted:
    """Logistic boosting with trees of fixed depth over quantised features."""

    def __init__(self, trees: list[tuple], bias: float):
        self.trees = trees
        self.bias = bias
        self.memo: dict[tuple, float] = {}

    @staticmethod
    def fit(x, y, rounds: int = 30, depth: int = 4, rate: float = 0.3, bins: int = 16, l2: float = 1.0) -> "Boosted":
        """``x``: rows of features, ``y``: 0 or 1. Deterministic."""
        import numpy as np

        x, y = np.asarray(x, np.float64), np.asarray(y, np.float64)
        n, m = x.shape
        cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(m)]
        code = np.stack([np.searchsorted(cuts[j], x[:, j], side="left") for j in range(m)], 1)
        p = min(max(y.mean(), 1e-3), 1 - 1e-3)
        bias = float(np.log(p / (1 - p)))
        score, trees = np.full(n, bias), []
        for _ in range(rounds):
            q = 1 / (1 + np.exp(-score))
            g, h = y - q, q * (1 - q)

            def grow(idx, level):
                out = split(idx, level)
                if not isinstance(out, tuple):
                    score[idx] += out
                return out

            def split(idx, level):
                leaf = float(rate * g[idx].sum() / (h[idx].sum() + l2))
                if level == depth or len(idx) < 8:
                    return leaf
                best, at = 1e-6, None
                gt, ht = g[idx].sum(), h[idx].sum()
                base = gt * gt / (ht + l2)
                for j in range(m):
                    k = len(cuts[j])
                    if not k:
                        continue
                    gs = np.bincount(code[idx, j], g[idx], k + 1)[:-1].cumsum()
                    hs = np.bincount(code[idx, j], h[idx], k + 1)[:-1].cumsum()
                    gain = gs * gs / (hs + l2) + (gt - gs) ** 2 / (ht - hs + l2) - base
                    b = int(gain.argmax())
                    if gain[b] > best:
                        best, at = gain[b], (j, b)
                if at is None:
                    return leaf
                left = code[idx, at[0]] <= at[1]
                if left.all() or not left.any():
                    return leaf
                return (at[0], float(cuts[at[0]][at[1]]), grow(idx[left], level + 1), grow(idx[~left], level + 1))

            tree = grow(np.arange(n), 0)
            trees.append(tree)
        return Boosted(trees, bias)

    def logit(self, row: tuple) -> float:
        """The log odds of one row."""
        out = self.memo.get(row)
        if out is None:
            out = self.bias + sum(_walk(t, row) for t in self.trees)
            if len(self.memo) > 200_000:
                self.memo.clear()
            self.memo[row] = out
        return out


def _walk(tree, row) -> float:
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree
