"""Sorted runs of suffixes, and their merge by loser trees that know common prefixes.

Of all suffixes of a text only those are sorted that can matter. Each window of
``WINDOW`` bytes belongs to its anchor, the ``ANCHOR`` bytes inside it with the least
hash. Equal windows have equal anchors, so windows whose anchor no other text holds
match nothing. Consecutive windows of one anchor make one suffix, cut off after its
last window; its key is the anchor's hash, and runs are sorted by key and bytes.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

WINDOW, ANCHOR = 50, 24
#: Windows of a suffix at most; longer stretches of one anchor (repeated characters) are cut.
_LONGEST = 64
#: Windows hashed at once: what the processor's cache holds.
_STEP = 1 << 15
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
PAD = b"\0" * 128


class Suffixes(NamedTuple):
    """start: place in the block; windows: how many begin there and after it; text: number of the text; key: the anchor's hash."""

    start: np.ndarray
    windows: np.ndarray
    text: np.ndarray
    key: np.ndarray


def _mixed(words: list[np.ndarray]) -> np.ndarray:
    h = words[0] * _ODD[0]
    for k, word in enumerate(words[1:], 1):
        h ^= h >> np.uint64(29)
        h += word
        h *= _ODD[k % 4]
    h ^= h >> np.uint64(32)
    h *= _ODD[3]
    h ^= h >> np.uint64(29)
    return h


def _hashes(buffer: bytes, at: int, n: int, offsets: tuple[int, ...]) -> np.ndarray:
    """Hashes of n places from at on, over the eight bytes at each offset from them."""
    return _mixed([np.ndarray((n,), "<u8", buffer, at + o, (1,)) for o in offsets])


def _least(h: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each width places."""
    reach = 1
    while 2 * reach <= width:
        h, reach = np.minimum(h[:-reach], h[reach:]), 2 * reach
    return np.minimum(h[: len(h) - (width - reach)], h[width - reach :]) if reach < width else h


def window_keys(buffer: bytes, at: np.ndarray) -> np.ndarray:
    """Hashes of the whole windows at some places."""
    return _mixed([np.ndarray((len(buffer) - 8 - o,), "<u8", buffer, o, (1,))[at] for o in (0, 8, 16, 24, 32, 40, WINDOW - 8)])


def suffixes(buffer: bytes, ends: np.ndarray) -> Suffixes:
    """The suffixes of a block of texts. buffer: their bytes and PAD; ends: where each ends."""
    total = int(ends[-1]) if len(ends) else 0
    opens = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else np.zeros(0, np.int64)
    valid = np.ones(total, bool)
    for a, b in zip(opens.tolist(), ends.tolist(), strict=True):
        valid[max(a, b - WINDOW + 1) : b] = False
    begins = np.zeros(total, bool)
    begins[opens[opens < total]] = True
    starts, keys = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for at in range(0, total, _STEP):
        n = min(_STEP, total - at)
        least = _least(_hashes(buffer, at, n + WINDOW - ANCHOR, (0, 8, 16)), WINDOW - ANCHOR + 1)
        new = begins[at : at + n].copy()
        new[0] = True
        new[1:] |= least[1:] != least[:-1]
        here = np.flatnonzero(new & valid[at : at + n])
        starts.append(here + at)
        keys.append(least[here])
    start, key = np.concatenate(starts), np.concatenate(keys)
    count = np.cumsum(valid, dtype=np.int32 if total < 1 << 31 else np.int64)
    windows = np.diff(np.concatenate([count[start] - 1, count[-1:]])).astype(np.int64) if len(start) else start
    if len(windows) and windows.max() > _LONGEST:
        pieces = -(-windows // _LONGEST)
        of = np.repeat(np.arange(len(start)), pieces)
        nth = np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start, key, windows = start[of] + nth * _LONGEST, key[of], np.minimum(windows[of] - nth * _LONGEST, _LONGEST)
    return Suffixes(start, windows, np.searchsorted(ends, start, side="right"), key)


def spread_windows(buffer: bytes, s: Suffixes) -> Suffixes:
    """Each window by itself, under its own hash: for anchors that too many suffixes share."""
    of = np.repeat(np.arange(len(s.start)), s.windows)
    start = s.start[of] + np.arange(len(of)) - np.repeat(np.cumsum(s.windows) - s.windows, s.windows)
    return Suffixes(start, np.ones(len(of), np.int64), s.text[of], window_keys(buffer, start))


def sorted_run(buffer: bytes, s: Suffixes) -> tuple[list[bytes], np.ndarray]:
    """The distinct suffixes, each after its key, in order; and for each of s its place among them."""
    heads = s.key.astype(">u8").tobytes()
    whole = [heads[8 * i : 8 * i + 8] + buffer[a : a + n] for i, (a, n) in enumerate(zip(s.start.tolist(), (s.windows + WINDOW - 1).tolist(), strict=True))]
    distinct = sorted(set(whole))
    place = dict(zip(distinct, range(len(distinct)), strict=True))
    return distinct, np.fromiter(map(place.__getitem__, whole), np.int64, len(whole))


def common_prefixes(run: list[bytes]) -> np.ndarray:
    """Bytes that each suffix of a sorted run shares with the one before it."""
    out = np.zeros(len(run), np.uint8)
    if len(run) > 1:
        sizes = np.fromiter(map(len, run), np.int64, len(run))
        width = int(sizes.max())
        for at in range(0, len(run) - 1, 1 << 14):
            rows = np.array(run[at : at + (1 << 14) + 1], f"S{width}").view(np.uint8).reshape(-1, width)
            differs = rows[1:] != rows[:-1]
            first = np.where(differs.any(axis=1), differs.argmax(axis=1), width)
            out[at + 1 : at + len(rows)] = np.minimum(first, np.minimum(sizes[at : at + len(rows) - 1], sizes[at + 1 : at + len(rows)]))
    return out


def prefix(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, of which known bytes need no look."""
    n = min(len(a), len(b))
    x, y = a[known:n], b[known:n]
    return n if x == y else n - ((int.from_bytes(x) ^ int.from_bytes(y)).bit_length() + 7) // 8


def front_coded(run: list[bytes], shared: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """Shared prefix lengths, remaining lengths and remaining bytes; the first suffix is whole."""
    shared = shared.tolist()
    if shared:
        shared[0] = 0
    rest = [s[k:] for s, k in zip(run, shared, strict=True)]
    return bytes(shared), bytes(map(len, rest)), b"".join(rest)


def decoded(shared: bytes, sizes: bytes, rest: bytes) -> list[bytes]:
    out, last, at = [], b"", 0
    for k, n in zip(shared, sizes, strict=True):
        last = last[:k] + rest[at : at + n]
        at += n
        out.append(last)
    return out


def merged(runs: list[list[bytes]], shared: list[bytes]) -> tuple[list[int], list[int]]:
    """The order of all runs' suffixes as run numbers, and how many bytes each shares with the one before it.

    A loser tree. Every entry knows its common prefix with the last winner that
    passed it: of two with different prefixes the longer one is the smaller
    suffix without a look at bytes, and of equal ones only what follows is looked at.
    """
    n = 1
    while n < max(2, len(runs)):
        n *= 2
    known, now, at = [-1] * n, [b""] * n, [0] * n
    for r, run in enumerate(runs):
        if run:
            known[r], now[r] = 0, run[0]

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser; the loser learns its common prefix with the winner."""
        x, y = known[a], known[b]
        if x != y or x < 0:
            return (a, b) if x >= y else (b, a)
        p, q = now[a], now[b]
        k = prefix(p, q, x)
        first = a < b if p == q else k == len(p) or (k < len(q) and p[k] < q[k])
        known[b if first else a] = k
        return (a, b) if first else (b, a)

    losers, winners = [0] * n, [0] * (2 * n)
    winners[n:] = range(n)
    for node in range(n - 1, 0, -1):
        winners[node], losers[node] = play(winners[2 * node], winners[2 * node + 1])
    best, order, common = winners[1], [], []
    while known[best] >= 0:
        order.append(best)
        common.append(known[best])
        at[best] = i = at[best] + 1
        if i < len(runs[best]):
            now[best], known[best] = runs[best][i], shared[best][i]
        else:
            known[best] = -1
        node, k = (best + n) >> 1, known[best]
        while node:
            other = losers[node]
            if known[other] > k:
                losers[node], best, k = best, other, known[other]
            elif known[other] == k >= 0:
                best, losers[node] = play(best, other)
                k = known[best]
            node >>= 1
    return order, common


def window_minima(rows: list[bytes], least: np.ndarray) -> list[np.ndarray]:
    """For each window of each suffix (after its key) the least of the numbers of all suffixes that hold it."""
    windows = np.fromiter(map(len, rows), np.int64, len(rows)) - 8 - WINDOW + 1
    bodies = np.frombuffer(b"".join(r[8:] for r in rows) + PAD, np.uint8)
    opens = np.cumsum(windows + WINDOW - 1) - (windows + WINDOW - 1)
    of = np.repeat(np.arange(len(rows)), windows)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows)
    place = opens[of] + nth
    # compared as seven numbers of eight bytes, the last one overlapping
    keys = [np.ndarray((len(bodies) - 8 - o,), "<u8", bodies, o, (1,))[place] for o in (0, 8, 16, 24, 32, 40, WINDOW - 8)]
    order = np.lexsort(keys)
    differs = np.zeros(len(of), bool)
    differs[:1] = True
    for k in keys:
        k = k[order]
        differs[1:] |= k[1:] != k[:-1]
    smallest = np.minimum.reduceat(least[of][order], np.flatnonzero(differs)) if len(of) else least[of]
    out = np.empty(len(of), np.int64)
    out[order] = smallest[np.cumsum(differs) - 1]
    return np.split(out, np.cumsum(windows)[:-1])
