"""Sorted runs of suffixes, front-coded, and their merge by a loser tree that never re-compares known prefixes.

A run is a sorted list of different entries. An entry is the bytes from an anchor on (``right`` of them belong to the
suffix), followed by the bytes before the anchor in reverse order, and a count. Front-coded, an entry is stored as the
length of the prefix that it shares with the one before it, and the rest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np


@dataclass
class Run:
    """``key``: sorted bytes; ``lcp``: prefix shared with the entry before; ``right``: length of the suffix part; ``count``."""

    key: list[bytes]
    lcp: list[int]
    right: list[int]
    count: list[int]


def common_prefix(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix of ``a`` and ``b``, which share ``known`` bytes at least."""
    n = min(len(a), len(b))
    if known >= n or a[known:n] == b[known:n]:
        return n
    differ = int.from_bytes(a[known:n], "big") ^ int.from_bytes(b[known:n], "big")
    return n - (differ.bit_length() + 7) // 8


def sorted_run(entries: dict[tuple[bytes, int], int]) -> Run:
    """The run of {(key, right): count}."""
    order = sorted(entries)
    lcp = [0] + [common_prefix(order[i - 1][0], order[i][0], 0) for i in range(1, len(order))]
    return Run([k for k, _ in order], lcp, [r for _, r in order], [entries[e] for e in order])


def encode(run: Run) -> tuple[bytes, bytes, bytes, bytes, bytes]:
    """(lcp, rest length, right, count, rests) as bytes."""
    rests = [key[lcp:] for key, lcp in zip(run.key, run.lcp, strict=True)]
    small = [np.array(x, dtype=np.uint16).tobytes() for x in (run.lcp, [len(r) for r in rests], run.right)]
    return (*small, np.array(run.count, dtype=np.int64).tobytes(), b"".join(rests))


def decode(lcp: bytes, rest: bytes, right: bytes, count: bytes, rests: bytes) -> Run:
    shared, sizes = np.frombuffer(lcp, np.uint16).tolist(), np.frombuffer(rest, np.uint16).tolist()
    keys, at, last = [], 0, b""
    for n, size in zip(shared, sizes, strict=True):
        last = last[:n] + rests[at : at + size]
        at += size
        keys.append(last)
    return Run(keys, shared, np.frombuffer(right, np.uint16).tolist(), np.frombuffer(count, np.int64).tolist())


def merge(runs: list[Run]) -> Iterator[tuple[bytes, int, int, int]]:
    """All runs' entries in order of their keys: (key, prefix shared with the one before, right, count).

    A candidate's known prefix is the one it shares with the last entry that was put out. Of two candidates the one with
    the longer known prefix is smaller; only equal ones compare bytes, and those beyond the known prefix alone.
    """
    k = len(runs)
    if k == 0:
        return
    at = [0] * k
    known = [0] * k
    done = [not r.key for r in runs]

    def beats(a: int, b: int) -> bool:
        """Whether candidate a goes before b; the loser's known prefix becomes the one it shares with the winner."""
        if done[a] or done[b]:
            return done[b]
        if known[a] != known[b]:
            return known[a] > known[b]
        x, y = runs[a].key[at[a]], runs[b].key[at[b]]
        n = common_prefix(x, y, known[a])
        first = n == len(x) if n in (len(x), len(y)) else x[n] < y[n]
        known[b if first else a] = n
        return first

    size = 1
    while size < k:
        size *= 2
    loser = [-1] * size

    def play(node: int) -> int:
        """The winner below a node, from the leaves on."""
        if node >= size:
            return node - size if node - size < k else -1
        a, b = play(2 * node), play(2 * node + 1)
        if a < 0 or b < 0:
            loser[node] = -1
            return max(a, b)
        first = beats(a, b)
        loser[node] = b if first else a
        return a if first else b

    winner = play(1)
    while not done[winner]:
        run, i = runs[winner], at[winner]
        yield run.key[i], known[winner], run.right[i], run.count[i]
        at[winner] = i + 1
        if i + 1 < len(run.key):
            known[winner] = run.lcp[i + 1]
        else:
            done[winner] = True
        node = (winner + size) // 2
        while node:
            other = loser[node]
            if other >= 0 and not beats(winner, other):
                loser[node], winner = winner, other
            node //= 2
