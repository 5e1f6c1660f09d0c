"""Repeated byte strings by a suffix sort that compares by prefix hashes.

Open segments (see `repeats`) of one group are sorted twice around their anchors: by the bytes from the
anchor on, and by the bytes before it read backwards. The sort is a merge sort whose comparisons find
the common extension of two suffixes by binary search over polynomial prefix hashes, so that a
comparison takes a logarithmic number of steps, for all pairs of a merge level at once. The common
extensions of neighbours are then verified on the bytes; where a hash collision had a part in the
order, the bytes are sorted directly.

In either order, suffixes with a common extension of at least x are neighbours. A window that begins o bytes
before its anchor equals another exactly if they share the o bytes before and the length - o bytes after the
anchor, that is, if they are in the same run of both orders. The first of each class is the one that
stays.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from caudal.llm.common import BYTE_VALUES, prefix_hashes, powers
from caudal.llm.repeats import Scheme, Texts, remove_repeats

LENGTH, GRAM = 100, 40
CLEANED = "doc_id long, kept binary, n_bytes long, n_removed long, spans array<struct<start:int,end:int>>"


class Suffixes:
    """Suffixes of one byte string, each with a length of its own beyond which it has ended."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
        self.data, self.starts, self.lengths = data, starts, lengths
        self.prefix = prefix_hashes(BYTE_VALUES[data])
        self.inverse = powers(len(data))[1]
        self.longest = int(lengths.max()) if len(lengths) else 0

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Common extension of suffixes i and j: binary search for the longest equal hash."""
        a, b = self.starts[i], self.starts[j]
        low, high = np.zeros(len(i), np.int64), np.minimum(self.lengths[i], self.lengths[j])
        ia, ib, pa_, pb = self.inverse[a], self.inverse[b], self.prefix[a], self.prefix[b]
        for _ in range(self.longest.bit_length()):
            middle = (low + high + 1) >> 1
            equal = (self.prefix[a + middle] - pa_) * ia == (self.prefix[b + middle] - pb) * ib
            low, high = np.where(equal, middle, low), np.where(equal, high, middle - 1)
        return low

    def before(self, i: np.ndarray, j: np.ndarray, ties: bool) -> np.ndarray:
        """Whether suffix i sorts before suffix j; `ties` is the answer for equal ones."""
        n = self.common(i, j)
        last = len(self.data) - 1
        x = np.where(n < self.lengths[i], self.data[np.minimum(self.starts[i] + n, last)].astype(np.int16), -1)
        y = np.where(n < self.lengths[j], self.data[np.minimum(self.starts[j] + n, last)].astype(np.int16), -1)
        return (x < y) | ((x == y) & ties)

    def verified(self, order: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Common extensions of neighbours within a group, by the bytes."""
        out = np.zeros(len(order), np.int64)
        for at in range(0, len(order) - 1, 50_000):
            i, j = order[at : at + 50_000], order[at + 1 : at + 50_001]
            i = i[: len(j)]
            step = np.arange(self.longest)
            inside = step < np.minimum(self.lengths[i], self.lengths[j])[:, None]
            last = len(self.data) - 1
            left = self.data[np.minimum(self.starts[i][:, None] + step, last)]
            right = self.data[np.minimum(self.starts[j][:, None] + step, last)]
            differ = (left != right) | ~inside
            out[at + 1 : at + 1 + len(j)] = np.where(differ.any(1), differ.argmax(1), self.longest)
        out[1:][group[order[1:]] != group[order[:-1]]] = -1
        return out


def merge_sorted(suffixes: Suffixes, group: np.ndarray) -> np.ndarray:
    """Order of the suffixes by group and content. All merges of one width run side by side: the rank of
    each element in the run beside its own is found by binary search."""
    order = np.argsort(group, kind="stable")
    n = len(order)
    g = group[order]
    first = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]])) if n else np.zeros(0, np.int64)
    size = np.diff(np.append(first, n))
    begin, total = np.repeat(first, size), np.repeat(size, size)
    place = np.arange(n)
    width = 1
    while n and width < size.max():
        inner = place - begin
        live = np.flatnonzero(total > width)
        run = inner[live] // width
        right = (run & 1) == 1
        other = begin[live] + np.where(right, run - 1, run + 1) * width
        end = begin[live] + total[live]
        low = np.minimum(other, end)
        high = np.minimum(other + width, end)
        base = low.copy()
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            middle = (low[open_] + high[open_]) >> 1
            # Elements of the other run that come before: equal ones of the left run come first.
            ahead = suffixes.before(order[middle], order[live[open_]], right[open_])
            low[open_] = np.where(ahead, middle + 1, low[open_])
            high[open_] = np.where(ahead, high[open_], middle)
        pair = begin[live] + (run >> 1) * 2 * width
        to = pair + (inner[live] % width) + (low - base)
        merged = order.copy()
        merged[to] = order[live]
        order = merged
        width *= 2
    return order


def sorted_runs(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes, and verified common extension of each with the one before (-1: none)."""
    suffixes = Suffixes(data, starts, lengths)
    order = merge_sorted(suffixes, group)
    common = suffixes.verified(order, group)
    if (common[1:] < suffixes.common(order[:-1], order[1:]))[common[1:] >= 0].any():  # a hash collision
        text = data.tobytes()
        keys = [(g, text[a : a + n]) for g, a, n in zip(group.tolist(), starts.tolist(), lengths.tolist(), strict=True)]
        order = np.array(sorted(range(len(keys)), key=keys.__getitem__), np.int64)
        common = suffixes.verified(order, group)
    return order, common


def repeated_windows(length: int, entries: dict) -> tuple[np.ndarray, np.ndarray]:
    """Entry and start of every window of open segments that an earlier one of them holds as well."""
    content = entries["content"]
    sizes = np.fromiter(map(len, content), np.int64, len(content))
    data = np.frombuffer(b"".join(content), np.uint8)
    begin = np.cumsum(sizes) - sizes
    offset, windows = entries["offset"].astype(np.int64), entries["windows"].astype(np.int64)
    _, group = np.unique(entries["route"], return_inverse=True)
    anchor = begin + offset
    right, right_common = sorted_runs(data, anchor, begin + sizes - anchor, group)
    left, left_common = sorted_runs(data[::-1], len(data) - anchor, offset, group)
    # Entries by place in the corpus: the first of a class is the one with the smallest rank.
    rank = np.empty(len(content), np.int64)
    rank[np.lexsort((entries["start"] + offset, entries["tag"], entries["doc"]))] = np.arange(len(content))
    found: list[tuple[np.ndarray, np.ndarray]] = []
    after, before = np.empty(len(content), np.int64), np.empty(len(content), np.int64)
    for o in range(int(offset.max()) + 1):
        mine = np.flatnonzero((o <= offset) & (o > offset - windows))
        if len(mine) < 2:
            continue
        after[right] = np.cumsum(right_common < length - o)
        before[left] = np.cumsum(left_common < o)
        mine = mine[np.lexsort((rank[mine], before[mine], after[mine]))]
        again = mine[1:][(after[mine][1:] == after[mine][:-1]) & (before[mine][1:] == before[mine][:-1])]
        found.append((again, entries["start"][again] + offset[again] - o))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([i for i, _ in found]), np.concatenate([s for _, s in found]).astype(np.int64)


def scheme(length: int = LENGTH, gram: int = GRAM) -> Scheme:
    return Scheme(length, gram, words=False, other_doc=False, solve=partial(repeated_windows, length))


def _cleaned(texts: Texts, covered: np.ndarray) -> pa.Table:
    kept = ~covered
    counts = np.concatenate([[0], np.cumsum(kept)])[texts.places]
    edge = np.zeros(len(covered) + 1, bool)
    edge[1:-1] = covered[1:] != covered[:-1]
    edge[texts.places[:-1]] = True
    edge = edge[:-1]
    starts = np.flatnonzero(edge & covered)
    cuts = np.flatnonzero(np.append(edge, True))
    ends = cuts[np.searchsorted(cuts, starts, "right")]
    row = np.searchsorted(texts.places, starts, "right") - 1
    base = texts.places[row]
    spans = pa.StructArray.from_arrays([pa.array(starts - base, pa.int32()), pa.array(ends - base, pa.int32())], ["start", "end"])
    n = np.diff(texts.places)
    return pa.table({
        "doc_id": texts.table.column("doc_id"),
        "kept": pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(counts.astype(np.int32)), pa.py_buffer(texts.data[kept])]),
        "n_bytes": pa.array(n, pa.int64()),
        "n_removed": pa.array(n - np.diff(counts), pa.int64()),
        "spans": pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(len(n) + 1)), pa.int32()), spans),
    })


def without_repeated_strings(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """One row for each row of docs: doc_id, kept (the remaining bytes), n_bytes, n_removed, spans (the
    maximal removed runs, in bytes).

    A byte goes if a string of `length` bytes that covers it also starts earlier: in a document with a
    smaller doc_id, or earlier in the same one; strings may overlap. Null texts are empty. Rows without
    doc_id come back whole; rows that repeat another get the same result.
    """
    return remove_repeats(docs, scheme(length, gram), _cleaned, CLEANED)
