"""Blocks of binned rows and the histograms of trees over them: what tasks run, of numbers alone.

A block has of each fold the rows outside it, as (bins by feature, target).
"""

from __future__ import annotations

import math
import pickle

import numpy as np

#: Rows of one block.
BLOCK_ROWS = 1 << 16
#: Above every bin.
NO_BIN = (1 << 16) - 1


def packer(edges, means, folds, n_inputs):
    """Batches of (fold, label, inputs) as pickled blocks."""
    import pyarrow as pa

    def pack(batches):
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= BLOCK_ROWS:
                yield block(held)
                held, n = [], 0
        if n:
            yield block(held)

    def block(held):
        t = pa.Table.from_batches(held)
        at, y = t["f"].to_numpy(), t["y"].to_numpy()
        xs = [t[f"x{i}"].to_numpy() for i in range(n_inputs)]
        if not all(np.isfinite(x).all() for x in xs):
            raise ValueError("features must not be NaN or infinite")
        out = []
        for j in range(folds):
            own = at != j if folds > 1 else np.ones(len(at), bool)
            bins = [np.searchsorted(e, x[own]).astype(np.uint8 if len(e) < 256 else np.uint16)
                    for e, x in zip(edges[j], xs, strict=True)]
            out.append((bins, y[own] - means[j]))
        return pa.RecordBatch.from_pydict({"block": [pickle.dumps(out, protocol=5)]}, pa.schema([("block", pa.binary())]))
    return pack


def descend(flat: np.ndarray, rows: np.ndarray, n: int, tables, steps: int) -> np.ndarray:
    """The node of each row (a position in every feature of ``flat``, one after another) after ``steps`` splits."""
    feature, cut, left = tables
    start = feature * n
    node = np.zeros(len(rows), np.intp)
    for _ in range(steps):
        node = left.take(node) + (flat.take(start.take(node) + rows) > cut.take(node))
    return node


def poisson() -> np.ndarray:
    """How often a bootstrap draws a row (Poisson of mean 1), by 16 random bits."""
    below = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)])
    return np.searchsorted(below, (np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.uint8)


def histograms(open_nodes: dict, level: int, width: int, draws: tuple[int, int] | None):
    """Counts and sums by (feature, node, bin) of each tree (fold, number): one pair of tables a tree and partition."""
    by_fold: dict = {}
    for (j, k), about in open_nodes.items():
        by_fold.setdefault(j, []).append((k, about))

    def of(index, part):
        sums: dict = {}
        times = poisson() if draws else None
        for b, block in enumerate(part):
            for j, trees in by_fold.items():
                bins, target = block[j]
                n = len(target)
                flat = np.concatenate([x.astype(np.uint16) for x in bins])
                every = np.arange(n)
                if draws:
                    bits = np.random.Generator(np.random.SFC64([draws[0], j, index, b])).bytes(2 * n * draws[1])
                    drawn = times.take(np.frombuffer(bits, np.uint16)).reshape(draws[1], n)
                for k, (tables, local, count, chosen) in trees:
                    rows, weight, y = every, None, target
                    if draws:
                        rows = np.flatnonzero(drawn[k])
                    at = local.take(descend(flat, rows, n, tables, level))
                    if len(at) and at.min() < 0:
                        rows, at = rows[at >= 0], at[at >= 0]
                    if len(rows) < n:
                        y = y.take(rows)
                    if draws:
                        weight = drawn[k].take(rows).astype(np.float64)
                        y = y * weight
                    cells = at * width
                    size, slots = count * width, len(bins) if chosen is None else chosen.shape[1]
                    if (j, k) not in sums:
                        sums[j, k] = np.zeros((2, slots, size))
                    table = sums[j, k]
                    for s in range(slots):
                        if chosen is None:
                            x = bins[s] if len(rows) == n else bins[s].take(rows)
                        else:
                            x = flat.take((chosen[:, s] * n).take(at) + rows)
                        cell = cells + x
                        table[0, s] += np.bincount(cell, weight, size)
                        table[1, s] += np.bincount(cell, y, size)
        return iter(sums.items())
    return of


def best(table: np.ndarray, width: int):
    """Of each node (slot, bin, gain, rows, sum, rows and sum on the left); the first of equal gains."""
    n, s = np.cumsum(table.reshape(2, table.shape[1], -1, width), axis=-1)
    n_all, s_all = n[0, :, -1], s[0, :, -1]
    with np.errstate(divide="ignore", invalid="ignore"):
        whole = s_all * s_all / n_all
        right = n_all[:, None] - n
        gain = s * s / n + (s_all[:, None] - s) ** 2 / right - whole[:, None]
    gain = np.where((n > 0) & (right > 0), gain, -np.inf)
    at = gain.argmax(axis=-1)
    node = np.arange(len(n_all))
    slot = np.take_along_axis(gain, at[..., None], -1)[..., 0].argmax(axis=0)
    at = at[slot, node]
    gain = gain[slot, node, at]
    return slot, at, np.where(gain > 1e-13 * whole, gain, -np.inf), n_all, s_all, n[slot, node, at], s[slot, node, at]


def add(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a + b


def left_over(trees: dict, depth: int):
    """What remains of the target after a step of boosting; of each fold the tree and what its nodes add."""
    def of(block):
        out = []
        for j, (bins, target) in enumerate(block):
            table, value = trees[j]
            n = len(target)
            node = descend(np.concatenate([x.astype(np.uint16) for x in bins]), np.arange(n), n, table, depth)
            out.append((bins, target - value.take(node)))
        return out
    return of
