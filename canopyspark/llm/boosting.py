"""Gradient-boosted trees for a yes/no label, in numpy: monotonic constraints, and flat node arrays for vectorised scoring. Trees grow from
histograms alone, so the rows may lie here or in the partitions of a table."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Forest:
    """All trees in one set of arrays. A leaf's children are itself, so depth steps reach it whatever its level."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    base: float
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of the label for each row of x."""
        node = np.broadcast_to(self.roots, (len(x), len(self.roots)))
        row = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            node = np.where(x[row, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
        return 1 / (1 + np.exp(-(self.base + self.value[node].sum(axis=1))))


#: Bins of a feature; significant bits to which values are rounded before their quantiles become the bins' edges.
BINS, EDGE_BITS = 32, 10
#: Gradients are whole numbers of this unit, so that their sums are exact, whatever the order and wherever rows lie.
UNIT = 2.0**-30
#: A node of trees over binned features: feature, last bin that goes left, children (a leaf's are itself), value.
Node = list


def rounded(values: np.ndarray) -> np.ndarray:
    shifted = values * (2.0 ** (53 - EDGE_BITS) + 1)
    return shifted - (shifted - values)


def edges_of(x: np.ndarray) -> list[np.ndarray]:
    """Of each feature, the quantiles of its rounded values, each once: an edge is the first value that so many thirty-seconds of the rows
    don't exceed."""
    out = []
    for column in x.T:
        form, n = np.unique(rounded(column), return_counts=True)
        out.append(np.unique(form[np.searchsorted(np.cumsum(n) * BINS, np.arange(1, BINS) * len(column))]) if len(column) else form)
    return out


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Features by rows."""
    return np.stack([np.searchsorted(e, column, "left") for e, column in zip(edges, x.T, strict=True)]).astype(np.uint8)


def _walked(nodes: list[Node], at: int, bins: np.ndarray, leaf):
    feature, last, left, right, _ = nodes[at]
    return leaf(at) if left == at else np.where(bins[feature] <= last, _walked(nodes, left, bins, leaf), _walked(nodes, right, bins, leaf))


def histograms(bins: np.ndarray, y: np.ndarray, nodes: list[Node], roots: list[int], base: float, wanted: list[int]) -> np.ndarray:
    """Sums of gradients and second derivatives by node of the last tree, feature and bin, of the rows in the wanted nodes; the trees before
    it make the rows' margins."""
    margin = np.full(len(y), base)
    for root in roots[:-1]:
        margin += _walked(nodes, root, bins, lambda at: nodes[at][4])
    p = 1 / (1 + np.exp(-margin))
    number = {at: k for k, at in enumerate(wanted)}
    place = np.broadcast_to(_walked(nodes, roots[-1], bins, lambda at: number.get(at, -1)), len(y))
    inside = np.flatnonzero(place >= 0)
    sums = np.rint(np.stack([y - p, p * (1 - p)])[:, inside] / UNIT)
    out = np.zeros((len(wanted), len(bins), BINS, 2), np.int64)
    for f, column in enumerate(bins):
        cell = place[inside] * BINS + column[inside]
        for k in range(2):
            out[:, f, :, k] = np.bincount(cell, sums[k], len(wanted) * BINS).reshape(-1, BINS)
    return out


def grown(sums, edges: list[np.ndarray], rows: int, positive: float, monotone: np.ndarray, trees: int = 60, depth: int = 3, rate: float = 0.15, penalty: float = 2.0, least: float = 1.0) -> Forest:
    """The forest of so many rows, with the label's sum positive. sums(nodes, roots, base, wanted) are the histograms of all rows, asked for
    once a level of a tree; whoever holds the rows answers.

    monotone: 1 where the score may only rise with the feature, -1 where it may only fall, else 0. A split whose sides would break its
    feature's sign is not made, and its children's values stay on their side of the split's middle, so the whole forest keeps the signs.
    With one label only, or no rows, the forest is a constant.
    """
    share = float(np.clip(positive / rows, 1e-3, 1 - 1e-3)) if rows else 0.999
    base = float(np.log(share / (1 - share)))
    nodes: list[Node] = []
    roots: list[int] = []
    for _ in range(trees if 0 < positive < rows else 0):
        roots.append(len(nodes))
        nodes.append([0, 0, len(nodes), len(nodes), 0.0])
        open_nodes = [(roots[-1], -np.inf, np.inf)]
        for _ in range(depth):
            if not open_nodes:
                break
            further = []
            for (at, low, high), held in zip(open_nodes, sums(nodes, roots, base, [at for at, _, _ in open_nodes]) * UNIT, strict=True):
                g, h = held[0].sum(axis=0)
                value = float(np.clip(g / (h + penalty), low, high))
                nodes[at][4] = rate * value
                gl, hl = held[..., 0].cumsum(axis=1), held[..., 1].cumsum(axis=1)
                wl, wr = (np.clip(a / (b + penalty), low, high) for a, b in ((gl, hl), (g - gl, h - hl)))
                gain = wl * gl - 0.5 * (hl + penalty) * wl**2 + wr * (g - gl) - 0.5 * (h - hl + penalty) * wr**2 - (value * g - 0.5 * (h + penalty) * value**2)
                allowed = (hl >= least) & (h - hl >= least) & (monotone[:, None] * (wr - wl) >= 0)
                gain = np.where(allowed, gain, 0)
                f, b = np.unravel_index(np.argmax(gain), gain.shape)
                if gain[f, b] <= 1e-6:
                    continue
                middle = (wl[f, b] + wr[f, b]) / 2
                limits = {1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle)), 0: ((low, high), (low, high))}[int(monotone[f])]
                nodes[at][:4] = [int(f), int(b), len(nodes), len(nodes) + 1]
                for own, (lo, hi) in zip((wl[f, b], wr[f, b]), limits, strict=True):
                    further.append((len(nodes), lo, hi))
                    nodes.append([0, 0, len(nodes), len(nodes), rate * float(np.clip(own, lo, hi))])
            open_nodes = further
    limit = [np.inf if left == at else float(edges[f][b]) for at, (f, b, left, _, _) in enumerate(nodes)]
    table = np.array(nodes, dtype=float).reshape(-1, 5)
    feature, left, right = (table[:, k].astype(np.int64) for k in (0, 2, 3))
    return Forest(np.array(roots, np.int64), feature, np.array(limit), left, right, table[:, 4], base, depth)


def fit(x: np.ndarray, y: np.ndarray, monotone: np.ndarray, **settings) -> Forest:
    """The forest of rows that are held here."""
    edges = edges_of(x)
    bins = binned(x, edges)
    return grown(lambda nodes, roots, base, wanted: histograms(bins, y, nodes, roots, base, wanted), edges, len(y), float(y.sum()), monotone, **settings)
