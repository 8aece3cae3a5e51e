"""Deep-shallow sorting of byte strings that share long prefixes.

All strings have one width; rows of a matrix. A multikey quicksort orders them to a shallow
depth, eight bytes a step: in each step every group of strings that agree so far is split by
the next eight bytes, all groups in one pass of array operations. Groups still equal at that
depth are ordered by blind tries: a trie over the places where strings differ, found by
walking to any leaf and comparing once.
"""

from __future__ import annotations

import numpy as np

SHALLOW = 32


def keys_of(rows: np.ndarray) -> np.ndarray:
    """Rows of bytes as rows of big-endian numbers, so that numbers compare as bytes do."""
    n, width = rows.shape
    padded = np.zeros((n, -(-width // 8) * 8), np.uint8)
    padded[:, :width] = rows
    return padded.view(">u8").astype(np.uint64)


def shallow(keys: np.ndarray, group: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The order by group and then by the first ``depth`` numbers, and the class, from 0 in that
    order, of strings that agree so far."""
    order = np.argsort(group, kind="stable")
    classes = np.zeros(len(group), np.int64)
    if len(group):
        classes[1:] = np.cumsum(group[order][1:] != group[order][:-1])
    for step in range(min(depth, keys.shape[1])):
        sizes = np.bincount(classes)
        open_ = sizes[classes] > 1
        if not open_.any():
            break
        at = np.flatnonzero(open_)
        rows = order[at]
        part = np.lexsort((keys[rows, step], classes[at]))
        order[at] = rows[part]
        values, own = keys[order, step], classes
        new = np.zeros(len(order), bool)
        new[1:] = (own[1:] != own[:-1]) | (open_[1:] & (values[1:] != values[:-1]))
        classes = np.cumsum(new)
    return order, classes


class BlindTrie:
    """Strings of numbers in a trie that keeps, for each inner node, only where its children
    first differ and their number there."""

    def __init__(self, keys: np.ndarray, depth: int):
        self.keys, self.depth = keys, depth
        self.root = None

    def add(self, row: int) -> None:
        """Puts a string in; equal strings share a leaf. A node is [place, children by number] or a
        leaf [width, rows]."""
        width = self.keys.shape[1]
        if self.root is None:
            self.root = [width, [row]]
            return
        own = self.keys[row]
        node, path = self.root, []
        while node[0] < width:
            path.append(node)
            child = node[1].get(int(own[node[0]]))
            node = child if child is not None else next(iter(node[1].values()))
        other = self.keys[node[1][0]]
        apart = np.flatnonzero(own[self.depth :] != other[self.depth :])
        if not len(apart):
            node[1].append(row)
            return
        place = self.depth + int(apart[0])
        above = None
        for step in path:
            if step[0] >= place:
                break
            above = step
        if above is None:
            below = self.root
        else:
            below = above[1][int(own[above[0]])]
        if below[0] == place:
            below[1][int(own[place])] = [width, [row]]
            return
        fork = [place, {int(other[place]): below, int(own[place]): [width, [row]]}]
        if above is None:
            self.root = fork
        else:
            above[1][int(own[above[0]])] = fork

    def rows(self) -> list[list[int]]:
        """The rows of each leaf, leaves in order."""
        width, found = self.keys.shape[1], []
        waiting = [self.root] if self.root is not None else []
        while waiting:
            node = waiting.pop()
            if node[0] == width:
                found.append(node[1])
            else:
                waiting.extend(node[1][number] for number in sorted(node[1], reverse=True))
        return found


def deep_shallow(rows: np.ndarray, group: np.ndarray, depth: int = SHALLOW) -> np.ndarray:
    """The order of the rows by group and then by their bytes."""
    keys = keys_of(rows)
    steps = depth // 8
    order, classes = shallow(keys, group, steps)
    sizes = np.bincount(classes) if len(classes) else np.zeros(0, np.int64)
    first = np.cumsum(sizes) - sizes
    for which in np.flatnonzero(sizes > 1):
        start, end = first[which], first[which] + sizes[which]
        trie = BlindTrie(keys, steps)
        for row in order[start:end]:
            trie.add(int(row))
        order[start:end] = [row for leaf in trie.rows() for row in leaf]
    return order


def agreement(rows: np.ndarray, group: np.ndarray, order: np.ndarray) -> np.ndarray:
    """How many bytes each row in order shares with the one before it; -1 at the start of a group."""
    found = np.full(len(order), -1, np.int64)
    if len(order) > 1:
        for start in range(1, len(order), 1 << 14):
            a, b = order[start - 1 : start - 1 + (1 << 14)], order[start : start + (1 << 14)]
            a = a[: len(b)]
            differ = rows[a] != rows[b]
            some = differ.any(axis=1)
            shared = np.where(some, differ.argmax(axis=1), rows.shape[1])
            found[start : start + len(b)] = np.where(group[a] == group[b], shared, -1)
    return found
