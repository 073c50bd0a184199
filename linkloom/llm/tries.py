"""Tries of many groups at once, searched with Levenshtein automata.

The tries of a batch's groups are arrays, level by level, and all searches go down together: a frontier holds
pairs of an automaton and a node, and one step moves every automaton over the letters of its node's children.  An
automaton accepts the words within one or two errors: letters put in, left out, replaced, or two neighbours swapped.
Its state holds, for each number of errors, a bit for each prefix of its text that the letters read so far can have come
from, so texts of the frontier have MOST letters at most; longer ones are compared by themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

MOST = 62  #: letters of a text whose prefixes fit the bits of a state
FRONTIER = 100_000  #: home texts that the searches of one round may meet together, about


def few_errors(a: str, b: str, most: int = 2) -> int | None:
    """The number of errors between a and b, None if more than ``most``; the work grows with the length alone."""
    if abs(len(a) - len(b)) > most:
        return None
    far = most + 1
    before: dict[int, int] = {}
    last = {j: j for j in range(min(len(b), most) + 1)}
    for i, x in enumerate(a, 1):
        row: dict[int, int] = {}
        for j in range(max(0, i - most), min(len(b), i + most) + 1):
            if j == 0:
                row[0] = i
                continue
            best = min(last.get(j, far) + 1, row.get(j - 1, far) + 1, last.get(j - 1, far) + (x != b[j - 1]))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == b[j - 1]:
                best = min(best, before.get(j - 2, far) + 1)
            row[j] = best
        if min(row.values()) > most:
            return None
        before, last = last, row
    return last[len(b)] if last.get(len(b), far) <= most else None


def letters(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A row of letter codes for each text, 0 behind its end, and the lengths; of texts beyond MOST letters only the length counts."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int32, n + 1, texts.offset * 4)
    size = np.diff(offsets)
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    if n and not (raw[offsets[0] : offsets[-1]] >= 128).any():
        width = int(min(size.max(initial=0), MOST))
        at = offsets[:-1, None] + np.arange(width, dtype=np.int32)
        codes = raw[np.minimum(at, max(len(raw) - 1, 0))] if width else np.zeros((n, 0), np.uint8)
        codes = np.where(np.arange(width) < size[:, None], codes, 0).astype(np.uint8)
        return codes, size
    plain = texts.to_pylist()
    size = np.array([len(t) for t in plain], np.int64)
    width = int(min(size.max(initial=0), MOST))
    codes = np.zeros((n, width), np.uint32)
    for i, t in enumerate(plain):
        part = t[:width]
        codes[i, : len(part)] = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
    # Few letters occur in a batch: number them.
    seen, numbers = np.unique(codes, return_inverse=True)
    if len(seen) and seen[0] != 0:
        numbers = numbers + 1
    return numbers.reshape(codes.shape).astype(np.uint16), size


class Tries:
    """The tries of the groups 0, 1, ...: texts of a group, given by their letters, under one root each."""

    def __init__(self, codes: np.ndarray, size: np.ndarray, group: np.ndarray, groups: int):
        wide = np.ascontiguousarray(codes.astype(f">u{codes.dtype.itemsize}"))
        n, width = codes.shape
        order = np.argsort(wide.view(f"S{max(1, width * codes.dtype.itemsize)}").ravel(), kind="stable") if width else np.arange(n)
        order = order[np.argsort(group[order], kind="stable")]
        self.order = order
        codes, size, group = codes[order], size[order], group[order]
        # Letters that a text shares with the one before it; -1 at the beginning of a group.
        shared = np.full(n, -1, np.int64)
        if n > 1:
            differ = codes[1:] != codes[:-1]
            shared[1:] = np.where(differ.any(1), differ.argmax(1), width) if width else 0
            shared[1:][group[1:] != group[:-1]] = -1
        starts = np.flatnonzero(shared < 0)
        self.root = np.full(groups, -1, np.int64)
        self.root[group[starts]] = np.arange(len(starts))
        self.levels = []
        ends = np.append(starts[1:], n)
        letter = np.zeros(len(starts), codes.dtype)
        for depth in range(width + 1):
            done = np.concatenate([[0], np.cumsum(size == depth)])
            leaves = done[ends] - done[starts]
            if depth < width:
                border = np.flatnonzero(shared <= depth)
                following = np.append(border[1:], n)
                goes_on = size[border] > depth
                below, until = border[goes_on], following[goes_on]
                first = np.searchsorted(below, starts)
                children = np.searchsorted(below, ends) - first
            else:
                below = until = np.zeros(0, np.int64)
                first = children = np.zeros(len(starts), np.int64)
            self.levels.append((letter, starts, ends, leaves, first, children))
            if not len(below):
                break
            starts, ends, letter = below, until, codes[below, depth]


def search(tries: Tries, codes: np.ndarray, size: np.ndarray, group: np.ndarray, weight: np.ndarray, rank: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For texts searching the trie of their group: numbers of the searching and of the found texts, and the errors between them (0 to 2).

    weight: texts in the trie that a search may meet, which bounds the searches done together.  rank: the place in the
    order of the tries up to which a search finds nothing, -1 for all.
    """
    asked = np.flatnonzero(tries.root[group] >= 0)
    rounds = np.cumsum(weight[asked]) // FRONTIER
    for part in np.split(asked, np.flatnonzero(np.diff(rounds)) + 1) if len(asked) else []:
        yield from _descend(tries, codes[part], size[part], tries.root[group[part]], part, rank[part])


def _descend(tries: Tries, codes: np.ndarray, size: np.ndarray, root: np.ndarray, numbers: np.ndarray, rank: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    one = np.uint64(1)
    two = np.uint64(2)
    kinds = int(codes.max(initial=0)) + 1
    for level in tries.levels:
        kinds = max(kinds, int(level[0].max(initial=0)) + 1)
    # The places of each letter in each searching text.
    places = np.zeros(len(numbers) * kinds, np.uint64)
    base = np.arange(len(numbers), dtype=np.int64) * kinds
    for at in range(codes.shape[1]):
        there = size > at
        places[(base + codes[:, at])[there]] |= one << np.uint64(at)
    length = size.astype(np.uint64)
    end_of = one << length
    full_of = (two << length) - one
    q = np.arange(len(numbers))
    node = root
    r0, r1, r2 = np.ones(len(q), np.uint64), np.uint64(3) & full_of, np.uint64(7) & full_of
    o0 = o1 = before = np.zeros(len(q), np.uint64)
    for depth, (_, starts, _, leaves, first, children) in enumerate(tries.levels):
        here = leaves[node]
        hit = np.flatnonzero((here > 0) & ((r2 & end_of[q]) != 0))
        if len(hit):
            end = end_of[q[hit]]
            wrong = np.where(r0[hit] & end, 0, np.where(r1[hit] & end, 1, 2))
            count = here[hit]
            within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            at, who = np.repeat(starts[node[hit]], count) + within, np.repeat(q[hit], count)
            new = np.flatnonzero(at > rank[who])
            yield numbers[who[new]], tries.order[at[new]], np.repeat(wrong, count)[new]
        if depth + 1 == len(tries.levels):
            return
        count = children[node]
        parent = np.repeat(np.arange(len(q)), count)
        if not len(parent):
            return
        child = first[node[parent]] + np.arange(len(parent)) - np.repeat(np.cumsum(count) - count, count)
        # Below a node whose last text a search has behind it there is nothing for it.
        ahead = np.flatnonzero(tries.levels[depth + 1][2][child] > rank[q[parent]] + 1)
        parent, child = parent[ahead], child[ahead]
        q = q[parent]
        m = places[base[q] + tries.levels[depth + 1][0][child]]
        full = full_of[q]
        p0, p1, p2 = r0[parent], r1[parent], r2[parent]
        swap = m & (before[parent] >> one)
        n0 = (p0 & m) << one
        n1 = ((((p1 & m) | p0 | n0) << one) | p0 | ((o0[parent] & swap) << two)) & full
        n2 = ((((p2 & m) | p1 | n1) << one) | p1 | ((o1[parent] & swap) << two)) & full
        alive = np.flatnonzero(n2)
        q, node, r0, r1, r2, o0, o1, before = q[alive], child[alive], n0[alive], n1[alive], n2[alive], p0[alive], p1[alive], m[alive]


def whole_groups(batches: Iterator[pa.RecordBatch], least: int = 60_000) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups, and the row where each begins, from batches in order of their first column."""
    held: list[pa.RecordBatch] = []
    rows, most = 0, least
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            rows += batch.num_rows
        if rows >= most:
            table = pa.Table.from_batches(held).combine_chunks()
            starts = _starts(table)
            if starts[-1]:
                yield table.slice(0, starts[-1]), starts[:-1]
                table, most = table.slice(starts[-1]), least
            else:
                most *= 2
            held, rows = table.to_batches(), table.num_rows
    if held:
        table = pa.Table.from_batches(held).combine_chunks()
        yield table, _starts(table)


def _starts(table: pa.Table) -> np.ndarray:
    key = table.column(0).combine_chunks()
    differ = pa.compute.not_equal(key.slice(1), key.slice(0, len(key) - 1)).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.flatnonzero(differ) + 1])


def near(texts: pa.Array, group: np.ndarray, home: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """All pairs of a text and a home text of its group within two errors, two home texts once: their numbers, and the errors.

    Groups are numbered from 0.
    """
    codes, size = letters(texts)
    short = size <= MOST
    homes = np.flatnonzero(home & short)
    groups = int(group.max(initial=-1)) + 1
    tries = Tries(codes[homes], size[homes], group[homes], groups)
    members = np.bincount(group[homes], minlength=groups)
    asking = np.flatnonzero(short)
    rank = np.full(len(size), -1, np.int64)
    rank[homes[tries.order]] = np.arange(len(homes))
    for a, b, wrong in search(tries, codes[asking], size[asking], group[asking], members[group[asking]], rank[asking]):
        yield asking[a], homes[b], wrong
    long = np.flatnonzero(size > MOST - 2)
    if len(long) and (size > MOST).any():
        yield from _compare(texts, group, home, long, size)


def _compare(texts: pa.Array, group: np.ndarray, home: np.ndarray, long: np.ndarray, size: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of which a text at least is too long for the tries."""
    plain = {int(i): texts[int(i)].as_py() for i in long}
    by: dict[int, list[int]] = {}
    for i in long:
        by.setdefault(int(group[i]), []).append(int(i))
    rows = []
    for members in by.values():
        for i in members:
            for j in members:
                if home[j] and (i < j or not home[i]) and i != j and max(size[i], size[j]) > MOST and abs(int(size[i]) - int(size[j])) <= 2:
                    wrong = few_errors(plain[i], plain[j])
                    if wrong is not None:
                        rows.append((i, j, wrong))
    if rows:
        a, b, wrong = (np.array(c) for c in zip(*rows))
        yield a, b, wrong


def spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the links between numbers those from each number to the smallest it is linked to, directly or through others."""
    numbers, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(numbers))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != np.arange(len(numbers)))
    return numbers[label[moved]], numbers[moved]
