"""Two-stage suffix sorting of a byte string, and the common prefixes of neighbours.

Suffixes smaller than the one that starts a byte later are sorted directly. All
others follow from them: scanning the buckets of first bytes in ascending order, the
suffix that starts a byte before a sorted one and with a greater byte takes the next free place
of its own bucket. Only the first ``depth`` bytes decide the order.
"""

from __future__ import annotations

import numpy as np


def _smaller_than_successor(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than its successor; the last one is not."""
    ends = np.append(np.flatnonzero(text[1:] != text[:-1]), len(text) - 1)
    run = np.diff(np.concatenate([[-1], ends]))
    following = np.append(text[ends[:-1] + 1], 0).astype(np.int16)
    following[-1] = -1
    return np.repeat(text[ends] < following, run)


def sort_suffixes(text: np.ndarray, depth: int) -> np.ndarray:
    """Starts of all suffixes of ``text`` in the order of their first ``depth`` bytes."""
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    direct = np.flatnonzero(_smaller_than_successor(text))
    whole = text.tobytes()
    keys = [whole[i : i + depth] for i in direct.tolist()]
    order = sorted(range(len(keys)), key=keys.__getitem__)
    direct = direct[np.array(order, np.int64)] if order else direct
    cuts = np.searchsorted(text[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[text[-1]].append(np.array([n - 1]))
    out = []
    for byte in np.flatnonzero(np.bincount(text, minlength=256)).tolist():
        wave = np.concatenate(waiting[byte]) if waiting[byte] else np.zeros(0, np.int64)
        bucket = []
        while len(wave):
            bucket.append(wave)
            before = wave[wave > 0] - 1
            wave = before[text[before] == byte]
        bucket.append(direct[cuts[byte] : cuts[byte + 1]])
        sorted_ = np.concatenate(bucket)
        out.append(sorted_)
        before = sorted_[sorted_ > 0] - 1
        before = before[text[before] > byte]
        first = text[before]
        before = before[np.argsort(first, kind="stable")]
        bounds = np.concatenate([[0], np.cumsum(np.bincount(first, minlength=256))])
        for later in np.flatnonzero(np.diff(bounds)).tolist():
            waiting[later].append(before[bounds[later] : bounds[later + 1]])
    return np.concatenate(out)


def equal_prefixes(text: np.ndarray, a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
    """Whether the common prefix of the suffixes at ``a`` and ``b`` has ``depth`` bytes (both have as many)."""
    words = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    for half in (1, 2, 4):
        words = (words[:-half] << np.uint64(8 * half)) | words[half:]
    steps = [*range(0, depth - 8, 8), depth - 8] if depth >= 8 else []
    left = np.arange(len(a))
    for step in steps:
        left = left[words[a[left] + step] == words[b[left] + step]]
    for step in range(0 if depth < 8 else depth, depth):
        left = left[text[a[left] + step] == text[b[left] + step]]
    same = np.zeros(len(a), bool)
    same[left] = True
    return same


def repeated_starts(text: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """For each of the ``starts``, whether its first ``depth`` bytes also begin at another of them."""
    among = np.zeros(len(text), bool)
    among[starts] = True
    order = sort_suffixes(text, depth)
    order = order[among[order]]
    same = equal_prefixes(text, order[:-1], order[1:], depth)
    repeated = np.zeros(len(text), bool)
    repeated[order[:-1][same]] = True
    repeated[order[1:][same]] = True
    return repeated[starts]
