"""Exact Hamming-range pairing of 64-bit fingerprints with vantage-point trees.

Two fingerprints that differ in at most three bits differ in at most one bit of
their left or of their right half. So there is a tree for each half, searched at
radius 1, which the triangle bound prunes far better than one tree over whole
fingerprints at radius 3 (random 64-bit distances pile up round 32). A node holds
a vantage point and a distance; items nearer than or at it go left, the others
right. A right item within the radius of the border also goes left as a guest,
to be compared with the items there; guests go wherever their ball reaches.
Leaves compare whole fingerprints, so the pairs are exact.

Items that share a half, or nearly, can't be split by it. They still differ in at
most three bits of the other half, so in at most one bit of one of its quarters,
and two more trees over those quarters split them in the same way.
"""

from __future__ import annotations

import numpy as np

DISTANCE = 3
#: Radius of every search in a part of the fingerprint.
RADIUS = 1
LEAF = 384
#: Parts that trees are grown over, as lowest bit and width: the two halves, the quarters of the right one, those of the left one.
PARTS = ((32, 32), (0, 32), (16, 16), (0, 16), (48, 16), (32, 16))
#: Parts that go on where a tree over a half can't split its items.
BEYOND = {0: (2, 3), 1: (4, 5)}


def take(prints: np.ndarray, part: int) -> np.ndarray:
    """prints: unsigned 64-bit. The bits of the part."""
    low, width = PARTS[part]
    return (prints >> np.uint64(low) & np.uint64((1 << width) - 1)).astype(np.uint32)


def choose(values: np.ndarray, tries: int = 8) -> tuple[int, int] | None:
    """The vantage point and distance that leave the fewest comparisons; None where nothing is gained."""
    best, best_cost = None, 0.85 * len(values) ** 2
    for vantage in values[np.linspace(0, len(values) - 1, tries).astype(int)]:
        counts = np.bincount(np.bitwise_count(values ^ vantage), minlength=65)
        left = np.cumsum(counts)
        border = sum(np.concatenate([counts[i:], np.zeros(i, counts.dtype)]) for i in range(1, RADIUS + 1))
        right = len(values) - left
        cost = left**2 + 2.0 * left * border + right**2
        at = int(np.argmin(cost))
        if right[at] and cost[at] < best_cost:
            best, best_cost = (int(vantage), at), cost[at]
    return best


def grow(sample: np.ndarray, leaf: int) -> list[tuple[int, int, int, int]]:
    """A tree over half-fingerprints as rows (vantage, distance, left, right); a negative child ~k is shard k."""
    nodes: list[tuple[int, int, int, int]] = []
    shards = 0

    def build(values: np.ndarray) -> int:
        nonlocal shards
        split = choose(values) if len(values) > leaf else None
        if split is None:
            shards += 1
            return ~(shards - 1)
        at = len(nodes)
        nodes.append((0, 0, 0, 0))
        near = np.bitwise_count(values ^ np.uint32(split[0])) <= split[1]
        nodes[at] = (*split, build(values[near]), build(values[~near]))
        return at

    root = build(sample)
    return nodes if root == 0 else []


def divide(values: np.ndarray, guest: np.ndarray, vantage: int, distance: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Masks: goes left, is a guest on the left, goes right (as what it is)."""
    d = np.bitwise_count(values ^ np.uint32(vantage)).astype(np.int16)
    home_left = ~guest & (d <= distance)
    border = ~guest & (d > distance) & (d <= distance + RADIUS)
    left = home_left | border | (guest & (d <= distance + RADIUS))
    right = (~guest & (d > distance)) | (guest & (d > distance - RADIUS))
    return left, left & ~home_left, right


def route(prints: np.ndarray, part: int, nodes: list[tuple[int, int, int, int]], guests: np.ndarray | None = None) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Shards with the positions of their items and which of those are guests."""
    values, out = take(prints, part), []
    stack = [(0 if nodes else ~0, np.arange(len(prints)), np.zeros(len(prints), bool) if guests is None else guests)]
    while stack:
        node, rows, guest = stack.pop()
        if not len(rows):
            continue
        if node < 0:
            out.append((~node, rows, guest))
            continue
        vantage, distance, to_left, to_right = nodes[node]
        left, left_guest, right = divide(values[rows], guest, vantage, distance)
        stack += [(to_left, rows[left], left_guest[left]), (to_right, rows[right], guest[right])]
    return out


class Labels:
    """Union-find over positions; a component's label is its smallest position."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self, rows: np.ndarray) -> np.ndarray:
        up = self.parent[rows]
        while True:
            over = self.parent[up]
            if np.array_equal(over, up):
                return up
            up = over

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.roots(a), self.roots(b)
            apart = a != b
            low, high = np.minimum(a, b)[apart], np.maximum(a, b)[apart]
            a, b = low, high
            np.minimum.at(self.parent, high, low)


def compare(prints: np.ndarray, rows: np.ndarray, guest: np.ndarray, labels: Labels) -> None:
    """Link all home-home and home-guest pairs within the distance, in blocks of bounded size."""
    home, all_rows = rows[~guest], np.concatenate([rows[~guest], rows[guest]])
    step = max(1, (1 << 21) // max(1, len(all_rows)))
    for at in range(0, len(home), step):
        block = home[at : at + step]
        near = np.bitwise_count(prints[block][:, None] ^ prints[all_rows[at:]][None, :]) <= DISTANCE
        i, j = np.nonzero(near)
        a, b = block[i], all_rows[at:][j]
        labels.link(a[a != b], b[a != b])


def components(prints: np.ndarray, guest: np.ndarray, part: int, leaf: int = LEAF) -> np.ndarray:
    """For each fingerprint of a shard the position of its local component's first member.

    Only links with at least one home member are sought; the shard's tree is
    grown from its own items.
    """
    labels = Labels(len(prints))
    stack = [(part, np.arange(len(prints)), guest)]
    while stack:
        part, rows, visiting = stack.pop()
        if visiting.all():
            continue
        values = take(prints[rows], part)
        split = choose(values[~visiting]) if len(rows) > leaf else None
        if split is not None:
            left, left_guest, right = divide(values, visiting, *split)
            stack += [(part, rows[left], left_guest[left]), (part, rows[right], visiting[right])]
        elif len(rows) > leaf and part in BEYOND:
            stack += [(p, rows, visiting) for p in BEYOND[part]]
        else:
            compare(prints, rows, visiting, labels)
    return labels.roots(np.arange(len(prints)))
