"""Cutting-stock column generation over a length histogram (numpy, size bounded by the histogram)."""

from __future__ import annotations

import numpy as np


def best_pattern(value: np.ndarray, capacity: int) -> np.ndarray:
    """Unbounded knapsack by dynamic programming: copies of each size (index = size) of most value."""
    best = np.zeros(capacity + 1)
    took = np.zeros(capacity + 1, dtype=np.int64)
    for c in range(1, capacity + 1):
        gain = value[1: c + 1] + best[c - 1:: -1][:c]
        w = int(gain.argmax()) + 1
        if gain[w - 1] > best[c - 1] + 1e-12:
            best[c], took[c] = gain[w - 1], w
        else:
            best[c] = best[c - 1]
    pattern, c = np.zeros(capacity + 1, dtype=np.int64), capacity
    while c > 0:
        if took[c]:
            pattern[took[c]] += 1
            c -= took[c]
        else:
            c -= 1
    return pattern


def column_generation(demand: np.ndarray, capacity: int, max_pivots: int = 20000) -> list[tuple[np.ndarray, float]]:
    """LP optimum of "fewest bins": (pattern, use) pairs whose patterns times uses equal ``demand``.

    Revised simplex: the basis starts with one single-size pattern per size, the knapsack prices
    entering columns with the dual values.  ``max_pivots`` only guards against cycling; stopping
    there leaves a valid, less tight cover.
    """
    sizes = np.flatnonzero(demand[: capacity + 1])
    m = len(sizes)
    if m == 0:
        return []
    scale = float(demand.sum())
    patterns = []
    inverse = np.zeros((m, m))
    for k, w in enumerate(sizes):
        pattern = np.zeros(capacity + 1, dtype=np.int64)
        pattern[w] = capacity // w
        patterns.append(pattern)
        inverse[k, k] = 1.0 / pattern[w]
    use = inverse @ (demand[sizes] / scale)
    for _ in range(max_pivots):
        dual = inverse.sum(axis=0)  # every bin costs 1
        value = np.zeros(capacity + 1)
        value[sizes] = np.maximum(dual, 0)
        entering = best_pattern(value, capacity)
        if float(value @ entering) <= 1 + 1e-9:
            break
        step = inverse @ entering[sizes]
        able = step > 1e-9
        if not able.any():
            break
        ratio = np.full(m, np.inf)
        ratio[able] = use[able] / step[able]
        leave = int(ratio.argmin())
        length = max(ratio[leave], 0.0)
        use = np.maximum(use - length * step, 0)
        use[leave] = length
        row = inverse[leave] / step[leave]
        inverse -= np.outer(step, row)
        inverse[leave] = row
        patterns[leave] = entering
    return [(p, float(u) * scale) for p, u in zip(patterns, use, strict=True) if u > 0]


def integer_patterns(demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """(pattern, whole number of bins) pairs that hold exactly ``demand``: LP uses rounded down, and
    what that leaves (at most a few patterns' worth, however large the demand) by best fit."""
    left = demand.astype(np.int64).copy()
    chosen = []
    for pattern, use in column_generation(demand, capacity):
        some = pattern > 0
        count = min(int(use + 1e-6), int((left[some] // pattern[some]).min()))
        if count > 0:
            left -= pattern * count
            chosen.append((pattern, count))
    open_bins: list[list[list[int]]] = [[] for _ in range(capacity + 1)]  # by free space
    for w in range(capacity, 0, -1):
        for _ in range(int(left[w])):
            free = next((f for f in range(w, capacity + 1) if open_bins[f]), None)
            bin_ = open_bins[free].pop() if free is not None else []
            bin_.append(w)
            open_bins[(capacity if free is None else free) - w].append(bin_)
    rest: dict[tuple[int, ...], int] = {}
    for bins in open_bins:
        for bin_ in bins:
            rest[tuple(bin_)] = rest.get(tuple(bin_), 0) + 1
    for bin_, count in rest.items():
        chosen.append((np.bincount(bin_, minlength=capacity + 1), count))
    return chosen
