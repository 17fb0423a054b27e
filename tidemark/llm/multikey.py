"""Multikey quicksort of byte strings and the windows that sorted neighbours share.

A symbol is 8 bytes, so a ternary partition settles 8 bytes at a time; all
segments of a block are partitioned together, each around its own pivot, and
only the equal part moves on to the next symbol.
"""

from __future__ import annotations

import numpy as np

SYMBOL = 8


def symbols(data: np.ndarray, at: np.ndarray, sizes: np.ndarray, width: int, step: int = 1) -> np.ndarray:
    """(strings, symbols): the ``sizes`` bytes from ``at`` on, forwards or (``step`` -1) backwards, padded by zeros."""
    width = -(-width // SYMBOL) * SYMBOL
    inside = np.arange(width)
    where = at[:, None] + step * inside[None, :]
    cells = data.take(where, mode="clip") if len(data) else np.zeros(where.shape, np.uint8)
    cells[inside[None, :] >= sizes[:, None]] = 0
    return np.ascontiguousarray(cells).view(">u8").astype(np.uint64)


def multikey_sort(words: np.ndarray, sizes: np.ndarray, order: np.ndarray, start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Sort the stretches (``start``, ``count``) of ``order``, each by its rows of ``words``.

    Padding sorts like zero bytes; strings that then agree stand by size, so a
    string comes before those it begins.
    """
    order, depth = order.copy(), np.zeros(len(start), np.int64)
    while True:
        live = count > 1
        start, count, depth = start[live], count[live], depth[live]
        if not len(start):
            return order
        ended = depth == words.shape[1]
        if ended.any():
            pos = _positions(start[ended], count[ended])
            rows = order[pos]
            order[pos] = rows[np.lexsort((sizes[rows], np.repeat(start[ended], count[ended])))]
            start, count, depth = start[~ended], count[~ended], depth[~ended]
            if not len(start):
                return order
        first, middle, last = (words[order[start + k], depth] for k in (0 * count, count // 2, count - 1))
        pivot = np.maximum(np.minimum(first, middle), np.minimum(np.maximum(first, middle), last))
        segment = np.repeat(np.arange(len(start)), count)
        pos = _positions(start, count)
        rows = order[pos]
        symbol = words[rows, depth[segment]]
        side = 3 * segment + (symbol >= pivot[segment]) + (symbol > pivot[segment])
        order[pos] = rows[np.argsort(side, kind="stable")]
        parts = np.bincount(side, minlength=3 * len(start)).reshape(-1, 3)
        start = (start[:, None] + np.cumsum(parts, 1) - parts).ravel()
        depth = (depth[:, None] + np.array([0, 1, 0])).ravel()
        count = parts.ravel()


def _positions(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    return np.arange(count.sum()) + np.repeat(start - (np.cumsum(count) - count), count)


def neighbour_prefix(words: np.ndarray, sizes: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Bytes that each string in ``order`` has in common with the one before it (0 for the first)."""
    out = np.zeros(len(order), np.int64)
    if len(order) < 2:
        return out
    a, b = order[:-1], order[1:]
    differ = words[a] != words[b]
    at = np.argmax(differ, 1)
    some = differ[np.arange(len(a)), at]
    x = words[a, at] ^ words[b, at]
    same = (x[:, None] < (np.uint64(1) << np.arange(56, 0, -8, dtype=np.uint64))[None, :]).sum(1)   # leading bytes that agree
    common = np.where(some, SYMBOL * at + same, SYMBOL * words.shape[1])
    out[1:] = np.minimum(common, np.minimum(sizes[a], sizes[b]))
    return out


def repeated_windows(data: np.ndarray, anchor: np.ndarray, left: np.ndarray, right: np.ndarray, length: int, gram: int):
    """(row, first, last): windows of ``length`` bytes that start ``first`` down to
    ``last`` bytes before the row's ``anchor`` and that another row of the same
    gram holds at the same distance.

    A row may use ``left`` bytes before its anchor and ``right`` from it on; the
    gram is the ``gram`` bytes at the anchor.  A window j bytes before the anchor
    is shared by two rows if they agree on j bytes to the left and on length - j
    to the right.  Rows of one gram, ordered by their left contexts, form a tree
    of common left parts; among the rows below a node, the best right agreement of
    each is that with a neighbour in the suffix order.  So nothing is compared but
    neighbours.
    """
    n = len(anchor)
    left, right = np.minimum(left, length), np.minimum(right, length)
    words = symbols(data, anchor, right, length)
    order = multikey_sort(words, right, np.arange(n), np.array([0]), np.array([n]))
    ahead = neighbour_prefix(words, right, order)
    head = np.flatnonzero(ahead < gram)                         # the first row of each gram
    count = np.diff(np.append(head, n))
    head, count = head[count > 1], count[count > 1]
    if not len(head):
        return (np.zeros(0, np.int64),) * 3
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    pos = _positions(head, count)
    begin = np.cumsum(count) - count
    members, ahead_of = order[pos], ahead[pos]

    back = symbols(data, anchor[members] - 1, left[members], max(1, length - gram), -1)
    by_left = multikey_sort(back, left[members], np.arange(len(members)), begin, count)
    behind = neighbour_prefix(back, left[members], by_left)
    lowest = _lowest(ahead_of)
    start, above = begin, np.full(len(begin), -1)
    found = []
    while len(start):                                            # one level of all trees at a time
        node = np.repeat(np.arange(len(start)), count)
        pos, opens = _positions(start, count), np.cumsum(count) - count
        shared = behind[pos]
        shared[opens] = length + 1
        here = np.minimum.reduceat(shared, opens)
        place = by_left[pos]
        place = place[np.lexsort((place, node))]
        common = np.zeros(len(place) + 1, np.int64)
        inner = np.flatnonzero(node[1:] == node[:-1])
        common[inner + 1] = _between(lowest, place[inner] + 1, place[inner + 1])
        low = np.maximum(above[node] + 1, length - np.maximum(common[:-1], common[1:]))
        hit = low <= here[node]
        found.append(np.stack([members[place[hit]], here[node[hit]], low[hit]], 1))
        # below a node the rows part where no more than ``here`` bytes agree
        first = np.flatnonzero(shared == here[node])
        first = np.sort(np.concatenate([opens, first]))
        size = np.diff(np.append(first, len(pos)))
        more = size > 1
        start, count, above = pos[first[more]], size[more], here[node[first[more]]]
    out = np.concatenate(found)
    return out[:, 0], out[:, 1], out[:, 2]


def _lowest(values: np.ndarray) -> list[np.ndarray]:
    """Minima of all stretches of 1, 2, 4, ... values."""
    out = [values]
    while 2 << (len(out) - 1) <= len(values):
        half = 1 << (len(out) - 1)
        out.append(np.minimum(out[-1][:-half], out[-1][half:]))
    return out


def _between(lowest: list[np.ndarray], a: np.ndarray, z: np.ndarray) -> np.ndarray:
    """Minimum of the values a to z, both included."""
    out = np.empty(len(a), np.int64)
    power = np.frexp((z - a + 1).astype(float))[1] - 1
    for i in np.unique(power).tolist():
        at = power == i
        out[at] = np.minimum(lowest[i][a[at]], lowest[i][z[at] - (1 << i) + 1])
    return out
