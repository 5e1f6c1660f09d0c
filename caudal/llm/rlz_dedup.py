"""Repeated passages of words by relative Lempel-Ziv parsing.

Open segments (see `repeats`) of one group are blocks of words. Blocks of documents with smaller doc_id
are the reference: an index of the places where each window of words first starts. A block is parsed
greedily: the factor at a place is the reference's window there, extended as long as both go on
alike; the parse goes on behind it. Factors of at least `length` words are duplicate spans. A window that
straddles the end of a factor may have a source of its own, so the parse takes up again at the
first window that the factor doesn't hold whole.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from caudal.llm.repeats import Scheme, Texts, remove_repeats

LENGTH, GRAM = 13, 4
CLEANED = "doc_id long, kept string, n_words long, n_removed long, spans array<struct<start:int,end:int>>"


def factors(words: list[bytes], reference: dict[tuple, tuple[list, int]], length: int) -> list[tuple[int, int]]:
    """Greedy factors of at least `length` words as (start, end); they may overlap by less than a window."""
    found, at = [], 0
    while at + length <= len(words):
        source = reference.get(tuple(words[at : at + length]))
        if source is None:
            at += 1
            continue
        block, place = source
        n = length
        while at + n < len(words) and place + n < len(block) and words[at + n] == block[place + n]:
            n += 1
        found.append((at, at + n))
        at += n - length + 1
    return found


def repeated_windows(length: int, entries: dict) -> tuple[np.ndarray, np.ndarray]:
    """Entry and start of every window of open segments that a document with a smaller doc_id holds."""
    order = np.lexsort((entries["start"], entries["tag"], entries["doc"], entries["route"]))
    route, doc = entries["route"][order].tolist(), entries["doc"][order].tolist()
    index: list[int] = []
    start: list[int] = []
    reference: dict[tuple, tuple[list, int]] = {}
    waiting: list[list[bytes]] = []  # blocks of the document at hand, not yet part of the reference
    last_route = last_doc = None
    for i, r, d in zip(order.tolist(), route, doc, strict=True):
        if r != last_route:
            reference, waiting = {}, []
        elif d != last_doc:
            for block in waiting:
                for at in range(len(block) - length + 1):
                    reference.setdefault(tuple(block[at : at + length]), (block, at))
            waiting = []
        last_route, last_doc = r, d
        words = entries["content"][i].split(b" ")
        base = int(entries["start"][i])
        for a, b in factors(words, reference, length):
            for at in range(a, b - length + 1):
                index.append(i)
                start.append(base + at)
        waiting.append(words)
    return np.array(index, np.int64), np.array(start, np.int64)


def scheme(length: int = LENGTH, gram: int = GRAM) -> Scheme:
    return Scheme(length, gram, words=True, other_doc=True, solve=partial(repeated_windows, length))


def _cleaned(texts: Texts, covered: np.ndarray) -> pa.Table:
    kept, spans, removed = [], [], []
    places = texts.places.tolist()
    for a, b in zip(places[:-1], places[1:], strict=True):
        mine = covered[a:b]
        gone = int(mine.sum())
        removed.append(gone)
        if gone == b - a:
            kept.append("")
            spans.append([{"start": 0, "end": b - a}] if gone else [])
            continue
        which = np.flatnonzero(~mine) + a
        words = [texts.data[x:y].tobytes() for x, y in zip(texts.starts[which].tolist(), texts.ends[which].tolist(), strict=True)]
        kept.append(b" ".join(words).decode())
        edge = np.flatnonzero(np.diff(np.concatenate([[0], mine.astype(np.int8), [0]])))
        spans.append([{"start": int(x), "end": int(y)} for x, y in zip(edge[::2], edge[1::2], strict=True)])
    return pa.table({
        "doc_id": texts.table.column("doc_id"),
        "kept": pa.array(kept, pa.string()),
        "n_words": pa.array(np.diff(texts.places), pa.int64()),
        "n_removed": pa.array(removed, pa.int64()),
        "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
    })


def without_repeated_passages(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """One row for each row of docs: doc_id, kept (the remaining words, joined by one space), n_words,
    n_removed, spans (the removed runs, in words).

    Words are split at white space (space, codes 9 to 13). A word goes if a window of `length` words that
    covers it also starts in a document with a smaller doc_id. Null texts have no words. Rows without
    doc_id come back whole; rows that repeat another get the same result.
    """
    return remove_repeats(docs, scheme(length, gram), _cleaned, CLEANED)
