"""Trees over binned numbers, with numpy alone: what the tasks of ``forest.py`` do with their rows.

A number's bin is the count of its feature's split points beneath it, so ``bin <= cut`` says that it is not above split
point ``cut``. A tree is a set of arrays: ``feature`` (-1 in a leaf), ``cut`` and ``left`` (the right child follows it), and
the entries ``ptr[i]:ptr[i + 1]`` of ``classes`` and ``values`` are the votes of leaf ``i``; a regressor's leaf has one.
"""

from __future__ import annotations

import numpy as np

BINS = 32
#: Numbers of the histograms that a task works on at once.
_CELLS = 2_000_000
_TINY = 1e-12


def copies(seed: int, tree: int, block: int, rows: int) -> np.ndarray:
    """How often a tree's bootstrap sample has each row of a block: Poisson(1) to 16 bits, equal at each call."""
    chances = np.exp(-1.0) / np.cumprod([1.0, 1, 2, 3, 4, 5, 6, 7])
    table = np.searchsorted(np.cumsum(chances), (np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.uint8)
    words = np.random.SFC64([seed & 0xFFFFFFFF, tree, block]).random_raw(-(-rows // 4))
    return table[words.view(np.uint16)[:rows]]


def histogram(place: np.ndarray, label: np.ndarray, weight: np.ndarray, size: int, classes: int) -> np.ndarray:
    """``(size, classes)`` weights of rows by class, or ``(size, 2)``: weights and weighted sums of numbers."""
    if classes:
        return np.bincount(place * classes + label, weight, size * classes).reshape(size, classes)
    return np.stack([np.bincount(place, weight, size), np.bincount(place, weight * label, size)], axis=1)


def best_splits(cells: np.ndarray, classes: int, floor: float):
    """From ``(nodes, features, BINS, stats)`` each node's best feature slot (-1: none), its cut, its gain (the fall of the
    impurity times the node's weight) and the stats of node and left child."""
    nodes, width, _, stats = cells.shape
    total = cells[:, 0].sum(axis=1)
    left = cells[:, :, :-1].cumsum(axis=2)
    with np.errstate(all="ignore"):
        if classes:
            n, n_left = total.sum(axis=1)[:, None, None], left.sum(axis=3)
            squares = (total * total).sum(axis=1)[:, None, None]
            ll, lt = np.einsum("nfbs,nfbs->nfb", left, left), np.einsum("nfbs,ns->nfb", left, total)
            gain = ll / n_left + (squares - 2 * lt + ll) / (n - n_left) - squares / n
        else:
            n, s = total[:, 0][:, None, None], total[:, 1][:, None, None]
            n_left, s_left = left[..., 0], left[..., 1]
            gain = s_left * s_left / n_left + (s - s_left) ** 2 / (n - n_left) - s * s / n
        gain = np.where((n_left > 0) & (n_left < n), gain, -1.0).reshape(nodes, -1)
    best = gain.argmax(axis=1)
    found = gain[np.arange(nodes), best]
    slot, cut = np.divmod(best, BINS - 1)
    least = _TINY * total.sum(axis=1) if classes else floor
    return np.where(found > least, slot, -1), cut.astype(np.uint8), found, total, left[np.arange(nodes), slot, cut]


def entries(total: np.ndarray, leaf: np.ndarray, classes: int):
    """``ptr``, ``classes`` and ``values`` of nodes with these stats; only leaves have entries."""
    if not classes:
        ptr = np.concatenate([[0], np.cumsum(leaf)]).astype(np.int32)
        return ptr, np.zeros(ptr[-1], np.int32), total[leaf, 1] / np.maximum(total[leaf, 0], _TINY)
    held = (total > 0) & leaf[:, None]
    ptr = np.concatenate([[0], np.cumsum(held.sum(axis=1))]).astype(np.int32)
    at, kinds = np.nonzero(held)
    return ptr, kinds.astype(np.int32), total[at, kinds] / total.sum(axis=1)[at]


def grow(bins: np.ndarray, label: np.ndarray, weight: np.ndarray, classes: int, subset: int, depth: int,
         random: np.random.Generator, floor: float):
    """One tree, level by level, from ``(rows, features)`` of bins: its arrays, and the gain of each feature.

    Every node looks at ``subset`` features drawn for it. The rows lie in the order of their nodes, so nodes are worked on
    in runs whose histograms are bounded.
    """
    features, width = bins.shape[1], min(subset, bins.shape[1])
    stats = classes or 2
    gains = np.zeros(features)
    node, nodes, made = np.zeros(len(label), np.int64), 1, 1
    parts = []
    for level in range(depth + 1):
        total = histogram(node, label, weight, nodes, classes)
        feature, cut, left = np.full(nodes, -1, np.int16), np.zeros(nodes, np.uint8), np.zeros(nodes, np.int32)
        if classes:
            open_ = total.max(axis=1) < total.sum(axis=1)
        else:
            open_ = total[:, 0] > 1
        if level < depth and open_.any():
            keep = open_[node]
            bins, label, weight, node = bins[keep], label[keep], weight[keep], node[keep]
            tried = np.nonzero(open_)[0]
            starts = np.searchsorted(node, np.append(tried, nodes))
            step = max(1, _CELLS // (width * BINS * stats))
            for first in range(0, len(tried), step):
                some = tried[first:first + step]
                rows = slice(starts[first], starts[first + len(some)])
                within = np.searchsorted(some, node[rows])
                if width < features:
                    drawn = random.random((len(some), features)).argpartition(width - 1, axis=1)[:, :width]
                else:
                    drawn = np.broadcast_to(np.arange(features), (len(some), features))
                mine, flat = bins[rows], np.arange(len(within)) * features
                cells = np.empty((len(some), width, BINS, stats))
                for k in range(width):
                    place = within * BINS + mine.ravel()[flat + drawn[within, k]]
                    cells[:, k] = histogram(place, label[rows], weight[rows], len(some) * BINS, classes).reshape(
                        len(some), BINS, stats)
                slot, cuts, gain, _, _ = best_splits(cells, classes, floor)
                good = slot >= 0
                feature[some[good]] = drawn[np.nonzero(good)[0], slot[good]]
                cut[some[good]] = cuts[good]
                gains += np.bincount(feature[some[good]], gain[good], features)
        split = feature >= 0
        left[split] = made + 2 * np.arange(split.sum())
        parts.append((feature, cut, left, *entries(total, ~split, classes)))
        made += 2 * int(split.sum())
        if not split.any():
            break
        keep = split[node]
        bins, label, weight, node = bins[keep], label[keep], weight[keep], node[keep]
        right = bins[np.arange(len(node)), feature[node]] > cut[node]
        node = (2 * (np.cumsum(split) - 1))[node] + right
        order = np.argsort(node, kind="stable")
        bins, label, weight, node = bins[order], label[order], weight[order], node[order]
        nodes = 2 * int(split.sum())
    return join_parts(parts), gains


def join_parts(parts) -> dict[str, np.ndarray]:
    """Consecutive nodes in one set of arrays."""
    ends = np.cumsum([0, *[p[3][-1] for p in parts]])
    ptr = np.concatenate([[0], *[p[3][1:] + e for p, e in zip(parts, ends)]]).astype(np.int32)
    names = ("feature", "cut", "left")
    found = {name: np.concatenate([p[i] for p in parts]) for i, name in enumerate(names)}
    return found | {"ptr": ptr, "classes": np.concatenate([p[4] for p in parts]), "values": np.concatenate([p[5] for p in parts])}


def walk(flat: np.ndarray, base: np.ndarray, start: int, feature: np.ndarray, cut: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The leaf that each row reaches. ``flat[base + f]`` is its bin of feature ``f``."""
    ends = np.full(len(base), start, np.int64)
    live, at = None, ends
    while True:
        f = feature[at]
        inner = f >= 0
        if not inner.all():
            if live is None:
                live = np.arange(len(base))
            ends[live[~inner]] = at[~inner]
            live, at, f = live[inner], at[inner], f[inner]
            if not len(live):
                return ends
        spots = base if live is None else base[live]
        at = left[at] + (flat[spots + f] > cut[at])


def vote(out: np.ndarray, rows: np.ndarray | slice, leaf: np.ndarray, first: np.ndarray, count: np.ndarray,
         classes: np.ndarray, values: np.ndarray) -> None:
    """Adds the entries of each row's leaf to its line of ``out``: ``count`` of them from ``first``."""
    if out.shape[1] == 1:
        out[rows, 0] += values[first[leaf]]
        return
    first, count = first[leaf], count[leaf]
    lines = np.arange(len(out))[rows]
    which = np.repeat(first - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
    out += np.bincount(np.repeat(lines, count) * out.shape[1] + classes[which], values[which], out.size).reshape(out.shape)


def to_bins(columns, points) -> np.ndarray:
    """``(features, rows)`` of bins."""
    return np.stack([np.searchsorted(p, x, side="left").astype(np.uint8) for x, p in zip(columns, points)])
