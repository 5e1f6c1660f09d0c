"""Repeated windows of a corpus, found exactly: what two substring deduplications have in common.

A document is a sequence of symbols (bytes or words). A window is `length` consecutive symbols. The job
finds every window that also starts in an earlier place, without sending a row for each window:

1. Anchors. A window's anchor is the run of `gram` symbols in it whose hash is smallest, which depends
   on the window's content alone, so equal windows have equal anchors at equal places. Consecutive
   windows mostly share their anchor; they form one segment, and about one symbol in
   (length - gram + 2) / 2 is an anchor.
2. Segments meet by anchor hash. One that equals an earlier segment as a whole is repeated. One whose
   anchor occurs only once is not. One whose anchor also occurs in another context is open.
3. Open segments meet with their content, by anchor, where the operator's own method finds the repeated
   windows among them.
4. The verdicts go back to the documents.

Rows of the exchanges are blobs of many entries, one for each pair of sender and receiver, so the JVM
handles few rows. Senders settle repetitions among their own entries first, so what a third of all
documents share sends one entry a sender. Anchors seen in very many contexts are dealt out by
window instead of by anchor.

Rows with equal doc_id are told apart by a checksum of the text; equal ones are the same document. A
null doc_id has no place in the order: such rows match nothing and come back whole.
"""

from __future__ import annotations

import secrets
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caudal.llm.common import (
    BYTE_VALUES, SPACE, gram_hashes, grouped, groups_for, mixed, packed, prefix_hashes, slices, span_hashes,
    stored, string_bytes, text_bytes, unpacked, word_digests,
)

#: Symbols handled at once; positions within take 18 bits of an anchor key.
BLOCK = 1 << 17
PLACE = np.uint64((1 << 18) - 1)
#: Anchors that a sender gathers before it passes them on.
FLUSH = 500_000
#: Contexts of one anchor in one sender, and in all, beyond which its windows are dealt out singly.
CONTEXTS_SENT, CONTEXTS = 64, 512
#: Bytes of text in a group of documents, of text behind a group of anchors, and of content in a group of open segments.
GROUP_BYTES, ANCHOR_BYTES, OPEN_BYTES = 2 << 20, 16 << 20, 4 << 20

REPEATED, OPEN, SPREAD = 0, 1, 2
ANCHOR_KINDS = ["u8", "u8", "i8", "u4", "i4", "u2", "u2", "u1"]  # anchor, segment, doc, tag, start, offset, count, spread
VERDICT_KINDS = ["i8", "u4", "i4", "u2", "u2", "u1"]  # doc, tag, start, offset, count, state
SENT = "bucket int, part int, n_open long, blob binary"
VERDICTS = "part int, n_open long, blob binary"
SEGMENTS = "bucket int, part int, route long, doc long, tag long, start int, offset int, windows int, content binary, blob binary"


@dataclass(frozen=True)
class Scheme:
    length: int
    gram: int
    words: bool
    #: Whether "earlier" needs a smaller doc_id, or an earlier start in the same document will do.
    other_doc: bool
    #: Repeated windows among the open segments of one group: see `solve` of the operators.
    solve: Callable[[dict[str, np.ndarray | list]], list[np.ndarray]]
    #: Key of the word digests, drawn anew for each job, so that no text can be made to collide. Results don't depend on it.
    key: int = field(default_factory=lambda: secrets.randbits(64))


# ---------------------------------------------------------------- symbols


def byte_symbols(data: np.ndarray) -> np.ndarray:
    return BYTE_VALUES[data]


def words_of(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of several texts that stand one after another."""
    inside = ~separator[data]
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    before[cuts] = False
    after[cuts - 1] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def symbols_of(scheme: Scheme, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of several texts, and the offsets of the texts among them."""
    if not scheme.words:
        return byte_symbols(data), offsets
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    starts, ends = words_of(data, offsets)
    return word_digests(data, starts, ends, scheme.key), np.searchsorted(starts, offsets)


# ---------------------------------------------------------------- anchors


def anchors(scheme: Scheme, symbols: np.ndarray, offsets: np.ndarray):
    """Segments of the windows of several sequences in at most about BLOCK symbols: row, start, offset
    of the anchor, windows, anchor hash, segment hash."""
    length, gram, n = scheme.length, scheme.gram, len(symbols)
    if n < length:
        return None
    hashes = gram_hashes(symbols, gram)
    least = (hashes & ~PLACE) | np.arange(len(hashes), dtype=np.uint64)
    width, have = length - gram + 1, 1
    while have < width:  # minima of windows of 1, 2, 4, ... grams
        step = min(have, width - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    at = (least & PLACE).astype(np.int64)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    at[row[: n - length + 1] != row[length - 1 :]] = -1
    start = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    count = np.diff(np.append(start, len(at)))
    anchor = at[start]
    start, count, anchor = start[anchor >= 0], count[anchor >= 0], anchor[anchor >= 0]
    prefix = prefix_hashes(symbols)
    segment = mixed(span_hashes(prefix, start, start + count - 1 + length) + count.astype(np.uint64))
    return row[start], start - offsets[row[start]], anchor - start, count, hashes[anchor], segment


def blocks(scheme: Scheme, symbols: np.ndarray, offsets: np.ndarray):
    """Rows of symbols in blocks: whole rows together, long ones in parts that overlap by a window less
    one symbol. Yields first row, its shift, symbols, offsets."""
    for a, b in slices(len(offsets) - 1, offsets, BLOCK):
        if b - a > 1 or offsets[b] - offsets[a] <= BLOCK + scheme.length:
            yield a, 0, symbols[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            continue
        n = int(offsets[b] - offsets[a])
        for at in range(0, n - scheme.length + 1, BLOCK):
            part = symbols[offsets[a] + at : min(offsets[a] + at + BLOCK + scheme.length - 1, offsets[b])]
            yield a, at, part, np.array([0, len(part)])


def settle(scheme: Scheme, anchor, segment, doc, tag, start):
    """Of entries: the indexes of those whose anchor occurs again; and for them: repeated, contexts of
    the anchor, first of its context (twice at most an anchor), number of the anchor. Last, the indexes
    of entries of one place that another row of the same document has sent as well: all but one."""
    order = np.argsort(anchor, kind="stable")
    same = anchor[order][1:] == anchor[order][:-1]
    again = np.zeros(len(order), bool)
    again[1:] |= same
    again[:-1] |= same
    index = order[again]
    index = index[np.lexsort((start[index], tag[index], doc[index], segment[index], anchor[index]))]
    once = np.ones(len(index), bool)
    once[1:] = np.any([c[index][1:] != c[index][:-1] for c in (anchor, segment, doc, tag, start)], axis=0)
    twice, index = index[~once], index[once]
    a, u, d = anchor[index], segment[index], doc[index]
    new_anchor = np.concatenate([[True], a[1:] != a[:-1]])[: len(a)]
    new_context = new_anchor | np.concatenate([[True], u[1:] != u[:-1]])[: len(a)]
    context, group = np.cumsum(new_context) - 1, np.cumsum(new_anchor) - 1
    repeated = d > d[new_context][context] if scheme.other_doc else ~new_context
    contexts = np.bincount(group, weights=new_context).astype(np.int64)[group] if len(a) else np.zeros(0, np.int64)
    rank = context - context[new_anchor][group]
    return index, repeated, contexts, new_context & (rank < 2), group, twice


def part_of(doc: np.ndarray, parts: int) -> np.ndarray:
    return np.mod(np.mod(doc, 1_000_003), parts)


def part_column(parts: int):
    """The same in Spark; rows without doc_id are spread by their text."""
    by_id = F.pmod(F.pmod(F.col("doc_id"), F.lit(1_000_003)), F.lit(parts))
    return F.coalesce(by_id, F.pmod(F.crc32(F.col("text").cast("binary")), F.lit(parts))).cast("int")


def verdict_rows(parts: int, doc, tag, start, offset, count, state) -> list[tuple[int, int, bytes]]:
    columns = [c.astype(k) for c, k in zip((doc, tag, start, offset, count, state), VERDICT_KINDS, strict=True)]
    return [(p, int((c[5] != REPEATED).sum()), packed(*c)) for p, c in grouped(part_of(doc, parts), columns)]


def sent_batch(rows: list[tuple]) -> pa.RecordBatch:
    bucket, part, n_open, blob = zip(*rows, strict=True) if rows else ((), (), (), ())
    return pa.record_batch(
        [pa.array(bucket, pa.int32()), pa.array(part, pa.int32()), pa.array(n_open, pa.int64()), pa.array(blob, pa.binary())],
        ["bucket", "part", "n_open", "blob"],
    )


def send_anchors(scheme: Scheme, buckets: int, parts: int):
    """Documents to blobs of anchors by bucket, and of verdicts already certain by part."""

    def settled(found: list[tuple]) -> Iterator[pa.RecordBatch]:
        anchor, segment, doc, tag, start, offset, count = (np.concatenate(c) for c in zip(*found, strict=True))
        index, repeated, contexts, witness, _, twice = settle(scheme, anchor, segment, doc, tag, start)
        spread = contexts > CONTEXTS_SENT
        state = np.full(len(doc), -1, np.int8)
        state[index[spread]] = SPREAD
        state[index[repeated]] = REPEATED
        known = np.flatnonzero(state >= 0)
        rows = [
            (part % buckets, part, n_open, blob) for part, n_open, blob in
            verdict_rows(parts, *(c[known] for c in (doc, tag, start, offset, count, state)))
        ]
        marked = np.zeros(len(doc), np.uint8)
        marked[index[spread]] = 1
        send = state < 0
        send[twice] = False
        send[index[spread & witness]] = True
        columns = [c[send].astype(k) for c, k in zip((anchor, segment, doc, tag, start, offset, count, marked), ANCHOR_KINDS, strict=True)]
        rows += [(b, -1, 0, packed(*c)) for b, c in grouped((columns[0] % np.uint64(buckets)).astype(np.int64), columns)]
        for i in range(0, len(rows), 2000):
            yield sent_batch(rows[i : i + 2000])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []
        held = 0
        for batch in batches:
            batch = batch.filter(batch.column(0).is_valid())
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            data, offsets = string_bytes(batch.column(1))
            for a, b in slices(len(ids), offsets, 1 << 20):
                piece, at = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                tags = np.array([zlib.crc32(piece[x:y]) for x, y in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)], np.uint32)
                symbols, ends = symbols_of(scheme, piece, at)
                for row, shift, part, cuts in blocks(scheme, symbols, ends):
                    if (one := anchors(scheme, part, cuts)) is None:
                        continue
                    r, start, offset, count, anchor, segment = one
                    r = r + a + row
                    found.append((anchor, segment, ids[r], tags[r - a], start + shift, offset, count))
                    held += len(r)
                if held >= FLUSH:
                    yield from settled(found)
                    found, held = [], 0
        if found:
            yield from settled(found)

    return run


def judge_anchors(scheme: Scheme, parts: int):
    """All entries of a bucket of anchors to verdicts by part."""

    def run(table: pa.Table) -> pa.Table:
        part = table.column("part").to_numpy()
        blobs, opens = table.column("blob").to_pylist(), table.column("n_open").to_pylist()
        rows = [(int(p), n, b) for p, n, b in zip(part, opens, blobs, strict=True) if p >= 0]
        anchor, segment, doc, tag, start, offset, count, marked = unpacked([b for p, b in zip(part, blobs, strict=True) if p < 0], ANCHOR_KINDS)
        index, repeated, contexts, _, group, _ = settle(scheme, anchor, segment, doc, tag, start)
        if len(index):
            spread = (np.bincount(group, weights=marked[index]) > 0)[group] | (contexts > CONTEXTS)
            state = np.where(repeated, REPEATED, np.where(spread, SPREAD, OPEN))
            told = repeated | (contexts > 1)
            index, state = index[told], state[told]
            rows += verdict_rows(parts, *(c[index] for c in (doc, tag, start, offset, count)), state)
        return verdict_table(rows)

    return run


def verdict_table(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    part, n_open, blob = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.table({"part": pa.array(part, pa.int32()), "n_open": pa.array(n_open, pa.int64()), "blob": pa.array(blob, pa.binary())})


# ---------------------------------------------------------------- documents and verdicts


class Texts:
    """Documents of one part, with the place of each in the joined symbols."""

    def __init__(self, scheme: Scheme, table: pa.Table):
        table = table.combine_chunks()
        self.scheme, self.table = scheme, table
        text = table.column("text")
        self.data, self.offsets = string_bytes(text.chunk(0)) if text.num_chunks else (np.zeros(0, np.uint8), np.zeros(1, np.int64))
        ids = table.column("doc_id")
        self.known = ids.is_valid().to_numpy(zero_copy_only=False) if len(ids) else np.zeros(0, bool)
        self.ids = ids.fill_null(0).to_numpy().astype(np.int64)
        cuts = self.offsets.tolist()
        self.tags = np.array([zlib.crc32(self.data[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)], np.uint32)
        if scheme.words:
            if len(self.data):
                self.starts, self.ends = words_of(self.data, self.offsets)
            else:
                self.starts = self.ends = np.zeros(0, np.int64)
            self.places = np.searchsorted(self.starts, self.offsets)
        else:
            self.places = self.offsets

    def rows_of(self, doc: np.ndarray, tag: np.ndarray) -> np.ndarray:
        """The row of each entry; the first of equal rows."""
        mine = mixed(self.ids.view(np.uint64)) ^ self.tags
        rows = np.flatnonzero(self.known)
        order = rows[np.argsort(mine[rows], kind="stable")]
        return order[np.searchsorted(mine[order], mixed(doc.view(np.uint64)) ^ tag)]

    def first_rows(self) -> np.ndarray:
        """For each row the first row of the same document."""
        rows = np.arange(len(self.ids))
        if self.known.any():
            rows[self.known] = self.rows_of(self.ids[self.known], self.tags[self.known])
        return rows

    def content(self, a: int, b: int) -> bytes:
        """Symbols a to b of the joined ones as bytes."""
        if self.scheme.words:
            return b" ".join(self.data[x:y].tobytes() for x, y in zip(self.starts[a:b].tolist(), self.ends[a:b].tolist(), strict=True))
        return self.data[a:b].tobytes()


def send_open(scheme: Scheme, parts: int, buckets: int):
    """Open segments of a part with their content, dealt out by anchor, or by window where the anchor has
    very many contexts. Windows of the latter that repeat within the part are settled here."""
    length = scheme.length

    def run(docs: pa.Table, verdicts: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        if docs.num_rows and verdicts.num_rows:
            texts = Texts(scheme, docs)
            columns = unpacked(verdicts.column("blob").to_pylist(), VERDICT_KINDS)
            wanted = columns[5] != REPEATED
            entries = np.unique(np.stack([c[wanted].astype(np.int64) for c in columns]), axis=1)
            doc, tag, start, offset, count, state = entries
            tag = tag.astype(np.uint32)
            place = texts.places[texts.rows_of(doc, tag)]  # of the document among all symbols
            prefix = prefix_hashes(symbols_of(scheme, texts.data, texts.offsets)[0])
            whole = np.flatnonzero(state == OPEN)
            at = place[whole] + start[whole]
            route = mixed(span_hashes(prefix, at + offset[whole], at + offset[whole] + scheme.gram))
            for i, a, r in zip(whole.tolist(), at.tolist(), route.tolist(), strict=True):
                content = texts.content(a, a + int(count[i]) - 1 + length)
                rows.append((r % buckets, -1, r, int(doc[i]), int(tag[i]), int(start[i]), int(offset[i]), int(count[i]), content, None))
            single = np.flatnonzero(state == SPREAD)
            if len(single):
                which = np.repeat(single, count[single])
                first = start[which] + np.arange(len(which)) - np.repeat(np.cumsum(count[single]) - count[single], count[single])
                route = mixed(span_hashes(prefix, place[which] + first, place[which] + first + length))
                order = np.lexsort((first, tag[which], doc[which], route))
                which, first, route = which[order], first[order], route[order]
                new = np.concatenate([[True], route[1:] != route[:-1]])
                group = np.cumsum(new) - 1
                repeated = doc[which] > doc[which][new][group] if scheme.other_doc else ~new
                for i, s, x in zip(which[~repeated].tolist(), first[~repeated].tolist(), route[~repeated].tolist(), strict=True):
                    at = int(place[i]) + s
                    rows.append((x % buckets, -1, x, int(doc[i]), int(tag[i]), s, 0, 1, texts.content(at, at + length), None))
                i, s = which[repeated], first[repeated]
                one = np.ones(len(i), np.int64)
                for part, _, blob in verdict_rows(parts, doc[i], tag[i], s, 0 * one, one, 0 * one):
                    rows.append((part % buckets, part, 0, 0, 0, 0, 0, 0, b"", blob))
        names = ["bucket", "part", "route", "doc", "tag", "start", "offset", "windows", "content", "blob"]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
        columns[2] = [x - (1 << 64) if x >= 1 << 63 else x for x in columns[2]]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return run


def judge_open(scheme: Scheme, parts: int):
    """Open segments of a bucket to verdicts, by the operator's method."""

    def run(table: pa.Table) -> pa.Table:
        passed = [(p, 0, b) for p, b in zip(table.column("part").to_pylist(), table.column("blob").to_pylist(), strict=True) if p >= 0]
        table = table.filter(pc.less(table.column("part"), 0))
        if not table.num_rows:
            return verdict_table(passed)
        entries = {n: table.column(n).to_numpy() for n in ("route", "doc", "tag", "start", "offset", "windows")}
        entries["content"] = table.column("content").to_pylist()
        index, start = scheme.solve(entries)  # entry and start of each repeated window
        doc, tag = entries["doc"][index], entries["tag"][index].astype(np.uint32)
        order = np.lexsort((start, tag, doc))
        doc, tag, start = doc[order], tag[order], start[order]
        if not len(doc):
            return verdict_table(passed)
        new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1]) | (start[1:] > start[:-1] + 1)])
        first = np.flatnonzero(new)
        count = start[np.append(first[1:], len(start)) - 1] - start[first] + 1
        none = np.zeros(len(first), np.int64)
        rows: list[tuple[int, int, bytes]] = []
        for at in range(0, int(count.max()), 65_000):  # counts are kept in 16 bits
            more = count > at
            rows += verdict_rows(parts, doc[first][more], tag[first][more], start[first][more] + at, none[more], np.minimum(count[more] - at, 65_000), none[more])
        return verdict_table(passed + rows)

    return run


def cover(scheme: Scheme, finish: Callable):
    """Documents of a part with all their verdicts to result rows by `finish(texts, covered)`, where
    covered marks symbols in repeated windows."""

    def run(docs: pa.Table, verdicts: pa.Table) -> pa.Table:
        texts = Texts(scheme, docs)
        step = np.zeros(int(texts.places[-1]) + 1, np.int32)
        if verdicts.num_rows and docs.num_rows:
            doc, tag, start, _, count, state = unpacked(verdicts.column("blob").to_pylist(), VERDICT_KINDS)
            mine = state == REPEATED
            if mine.any():
                at = texts.places[texts.rows_of(doc[mine], tag[mine])] + start[mine]
                np.add.at(step, at, 1)
                np.add.at(step, at + count[mine].astype(np.int64) - 1 + scheme.length, -1)
        covered = np.cumsum(step[:-1]) > 0
        first = texts.first_rows()
        for r in np.flatnonzero(first != np.arange(len(first))).tolist():  # a row that repeats another
            a, b = texts.places[first[r]], texts.places[first[r] + 1]
            covered[texts.places[r] : texts.places[r + 1]] = covered[a:b]
        return finish(texts, covered)

    return run


def remove_repeats(docs: DataFrame, scheme: Scheme, finish: Callable, schema: str) -> DataFrame:
    """Runs the job described above over docs (doc_id, text; other columns are not read); null texts
    are empty. An empty table gives an empty result."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    amount = text_bytes(docs)
    parts, buckets = groups_for(spark, amount, GROUP_BYTES, 2), groups_for(spark, amount, ANCHOR_BYTES)
    dealt = docs.withColumn("part", part_column(parts)).groupBy("part")
    closed = stored(
        docs.mapInArrow(send_anchors(scheme, buckets, parts), SENT).groupBy("bucket").applyInArrow(judge_anchors(scheme, parts), VERDICTS),
        "anchors",
    )
    n_open = closed.agg(F.sum("n_open")).first()[0] or 0
    verdicts = closed.select("part", "blob")
    if n_open:
        groups = groups_for(spark, n_open * 200, OPEN_BYTES)
        segments = dealt.cogroup(closed.filter("n_open > 0").groupBy("part")).applyInArrow(send_open(scheme, parts, groups), SEGMENTS)
        opened = stored(segments.groupBy("bucket").applyInArrow(judge_open(scheme, parts), VERDICTS), "open")
        verdicts = verdicts.unionByName(opened.select("part", "blob"))
    return dealt.cogroup(verdicts.groupBy("part")).applyInArrow(cover(scheme, finish), schema)
