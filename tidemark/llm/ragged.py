"""Recursions over sequences of unequal length, one step for all sequences at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np


def steps(lengths: np.ndarray) -> Iterator[np.ndarray]:
    """For t = 0, 1, ...: the rows of element t of all sequences longer than t, longest sequence first.

    Sequences lie one after the other in one array; `rows - 1` are the rows of the step before.
    """
    starts = np.cumsum(lengths) - lengths
    order = np.argsort(-lengths, kind="stable")
    starts, falling = starts[order], lengths[order]
    live = np.searchsorted(-falling, -np.arange(falling[0] if len(falling) else 0), side="left")
    for t, n in enumerate(live):
        yield starts[:n] + t


def by_step(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows, borders): all elements ordered by step, so that step t lies at borders[t]:borders[t + 1].

    Its first rows in step t - 1 are the same sequences' elements before, as the longest come first:
    a recursion then works on slices alone.
    """
    rows = list(steps(lengths))
    borders = np.cumsum([0, *(len(r) for r in rows)])
    return (np.concatenate(rows) if rows else np.zeros(0, np.int64)), borders
