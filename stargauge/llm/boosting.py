"""Gradient-boosted trees for a yes/no label, as flat numpy node arrays, with monotone features."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np


@dataclass
class Boosted:
    """All trees in one set of arrays: a node's feature (-1 in a leaf), threshold, children and value.

    A row goes left where its feature is at most the threshold. ``roots`` are the first nodes of the trees.
    """

    base: float
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def margin(self, rows: np.ndarray) -> np.ndarray:
        """The sum of the trees' values for each row; all rows step down all trees at once."""
        if not len(self.roots):
            return np.full(len(rows), self.base)
        at = np.repeat(self.roots[None, :], len(rows), axis=0)
        line = np.arange(len(rows))[:, None]
        for _ in range(self.depth):
            feature = self.feature[at]
            down = np.where(rows[line, np.maximum(feature, 0)] <= self.threshold[at], self.left[at], self.right[at])
            at = np.where(feature < 0, at, down)
        return self.base + self.value[at].sum(axis=1)

    def probability(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(rows), -50, 50)))


def _best(hist_g: np.ndarray, hist_h: np.ndarray, signs: np.ndarray, low: float, high: float, ridge: float, least: float):
    """Gain, feature, bin and child values of the best split that keeps the order of constrained features."""
    gl, hl = hist_g.cumsum(axis=1)[:, :-1], hist_h.cumsum(axis=1)[:, :-1]
    g, h = hist_g[0].sum(), hist_h[0].sum()
    gr, hr = g - gl, h - hl
    vl, vr = np.clip(-gl / (hl + ridge), low, high), np.clip(-gr / (hr + ridge), low, high)
    own = np.clip(-g / (h + ridge), low, high)

    def loss(v, gg, hh):
        return gg * v + 0.5 * (hh + ridge) * v * v

    gain = loss(own, g, h) - loss(vl, gl, hl) - loss(vr, gr, hr)
    gain[(hl < least) | (hr < least) | ((vr - vl) * signs[:, None] < 0)] = -np.inf
    f, b = np.unravel_index(np.argmax(gain), gain.shape)
    return gain[f, b], int(f), int(b), vl[f, b], vr[f, b]


def fit_boosted(
    rows: np.ndarray, label: np.ndarray, signs: Sequence[int], trees: int = 60, depth: int = 4, rate: float = 0.2,
    bins: int = 64, ridge: float = 1.0, least: float = 2.0,
) -> Boosted:
    """Fit to ``rows`` and 0/1 ``label``. A feature with sign +1 never lowers the score, with -1 never raises it.

    A split on such a feature must order its children's values, and their midpoint bounds all values below.
    """
    signs = np.asarray(signs)
    share = np.clip(label.mean() if len(label) else 0.5, 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    cuts = [np.unique(np.quantile(rows[:, k], np.linspace(0, 1, bins + 1)[1:-1])) if len(rows) else np.zeros(0) for k in range(len(signs))]
    code = np.stack([np.searchsorted(c, rows[:, k], side="left") for k, c in enumerate(cuts)], axis=1) if len(rows) else np.zeros((0, len(signs)), int)
    flat = code + np.arange(len(signs)) * bins
    out: dict[str, list] = {k: [] for k in ("feature", "threshold", "left", "right", "value")}
    roots, margin = [], np.full(len(rows), base)

    def node(value: float) -> int:
        for key, item in (("feature", -1), ("threshold", 0.0), ("left", 0), ("right", 0), ("value", value * rate)):
            out[key].append(item)
        return len(out["value"]) - 1

    for _ in range(trees if len(rows) and 0 < label.sum() < len(label) else 0):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - label, p * (1 - p)
        root = node(0.0)
        roots.append(root)
        level = [(root, np.arange(len(rows)), -np.inf, np.inf)]
        for _ in range(depth):
            below = []
            for at, which, low, high in level:
                cells = flat[which].ravel()
                hist = [np.bincount(cells, np.repeat(x[which], len(signs)), len(signs) * bins).reshape(len(signs), bins) for x in (g, h)]
                gain, f, b, vl, vr = _best(*hist, signs, low, high, ridge, least)
                if not gain > 1e-6 or b >= len(cuts[f]):
                    continue
                middle = (vl + vr) / 2
                bounds = {0: ((low, high), (low, high)), 1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}[int(signs[f])]
                goes = code[which, f] <= b
                out["feature"][at], out["threshold"][at] = f, float(cuts[f][b])
                for side, v, mask, (lo, hi) in (("left", vl, goes, bounds[0]), ("right", vr, ~goes, bounds[1])):
                    child = node(v)
                    out[side][at] = child
                    below.append((child, which[mask], lo, hi))
            level = below
        tree = Boosted(0.0, np.array([root]), *(np.array(out[k]) for k in ("feature", "threshold", "left", "right", "value")), depth)
        margin = margin + tree.margin(rows)
    return Boosted(base, np.array(roots, np.int64), *(np.array(out[k]) for k in ("feature", "threshold", "left", "right", "value")), depth)
