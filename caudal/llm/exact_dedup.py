"""Exact duplicates by a partitioned cuckoo-filter index.

Texts are equal when identical after lower-casing A-Z. Each text becomes a 64-bit live digest, and its
content key (SHA-256 of the normalised text). An index partition owns the digests
of its hash range. Its cuckoo filter holds 16-bit fingerprints in buckets of four; a filter hit is
verified against the content keys of that bucket pair, so that a false hit never merges two texts. When
a copy with a larger doc_id arrives, the digest of the older one is deleted and that of the newer
inserted. An insertion that finds no free place after a bounded number of moves doubles the filter and
fills it again from the stored keys, so the filter never forgets.

Copies are combined per input partition before the shuffle: a text that a third of all rows hold sends
one entry per input partition.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caudal.llm.common import free_name, join_by_key, stored, string_bytes

SLOTS = 4
MOVES = 200
#: Share of full places beyond which an overflow doubles the filter.
LOAD = 0.5
FIRST_BUCKETS = 256
#: Distinct texts that one input task gathers before it passes them on.
FLUSH = 200_000

DIGESTS = "doc_id long, key binary"
ENTRIES = "digest long, key binary, newest long, copies long, newest_rows long"
CLASSES = "key binary, keep_id long, group_size long, newest_rows long"


class CuckooIndex:
    """Cuckoo filter of 16-bit fingerprints with the keys they stand for.

    `slots[b]` lists the fingerprints of bucket b, `keys[b]` the stored entries beside them: the
    filter answers whether a digest can be there, the keys decide.
    """

    def __init__(self, buckets: int = FIRST_BUCKETS):
        self._empty(buckets)
        self.resized = self.live = 0

    def _empty(self, buckets: int) -> None:
        self.mask = buckets - 1
        self.slots: list[list[int]] = [[] for _ in range(buckets)]
        self.keys: list[list[tuple]] = [[] for _ in range(buckets)]

    def _places(self, digest: int) -> tuple[int, int, int]:
        fingerprint = (digest & 0xFFFF) or 1
        first = (digest >> 16) & self.mask
        return fingerprint, first, self._other(first, fingerprint)

    def _other(self, bucket: int, fingerprint: int) -> int:
        return bucket ^ (fingerprint * 0x5BD1E995 & self.mask)

    def find(self, digest: int, key: bytes) -> tuple | None:
        """The stored entry (digest, key, ...) of the same content, if it is live."""
        fingerprint, first, second = self._places(digest)
        for bucket in (first, second):
            if fingerprint in self.slots[bucket]:
                for entry in self.keys[bucket]:
                    if entry[0] == digest and entry[1] == key:
                        return entry
        return None

    def delete(self, entry: tuple) -> None:
        fingerprint, first, second = self._places(entry[0])
        for bucket in (first, second):
            for i, there in enumerate(self.keys[bucket]):
                if there is entry:
                    del self.keys[bucket][i], self.slots[bucket][i]
                    self.live -= 1
                    return
        raise KeyError(entry[0])

    def insert(self, entry: tuple) -> None:
        self.live += 1
        rest = self._place(entry)
        if rest is None:
            return
        if self.live <= LOAD * SLOTS * (self.mask + 1):
            self._overfill(rest)
            return
        stored_keys = [rest, *self.entries()]
        self._empty(2 * (self.mask + 1))
        self.resized += 1
        for each in stored_keys:
            if (rest := self._place(each)) is not None:
                self._overfill(rest)

    def _overfill(self, entry: tuple) -> None:
        """More than eight digests of one fingerprint and bucket pair never fit, whatever the size; a filter that is
        half empty makes such a bucket longer instead of growing."""
        fingerprint, first, _ = self._places(entry[0])
        self.slots[first].append(fingerprint)
        self.keys[first].append(entry)

    def _place(self, entry: tuple) -> tuple | None:
        """Puts an entry in, moving others; returns what has found no place in the end."""
        fingerprint, first, second = self._places(entry[0])
        for bucket in (first, second):
            if len(self.slots[bucket]) < SLOTS:
                self.slots[bucket].append(fingerprint)
                self.keys[bucket].append(entry)
                return None
        bucket = second
        for move in range(MOVES):
            at = move % SLOTS
            fingerprint, self.slots[bucket][at] = self.slots[bucket][at], fingerprint
            entry, self.keys[bucket][at] = self.keys[bucket][at], entry
            bucket = self._other(bucket, fingerprint)
            if len(self.slots[bucket]) < SLOTS:
                self.slots[bucket].append(fingerprint)
                self.keys[bucket].append(entry)
                return None
        return entry

    def add(self, digest: int, key: bytes, newest: int, copies: int, newest_rows: int) -> None:
        """A batch of copies of one text: newest is the largest doc_id among them."""
        old = self.find(digest, key)
        if old is not None:
            self.delete(old)
            copies += old[3]
            if newest == old[2]:
                newest_rows += old[4]
            elif newest < old[2]:
                newest, newest_rows = old[2], old[4]
        self.insert((digest, key, newest, copies, newest_rows))

    def entries(self) -> Iterator[tuple]:
        for keys in self.keys:
            yield from keys


#: Name of the content key beside the columns of documents.
KEY = "_content_key"
#: Stands for a null doc_id, which is older than any other.
NO_ID = -(2**63)


def _digest_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = string_bytes(batch.column(1))
        view = memoryview(data)
        keys = [
            hashlib.sha256(bytes(view[a:b]).lower()).digest()
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)
        ]
        yield pa.record_batch([batch.column(0), pa.array(keys, pa.binary())], ["doc_id", "key"])


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[bytes, list[int]] = {}

    def out() -> pa.RecordBatch:
        digests = [int.from_bytes(k[:8], "little", signed=True) for k in found]
        values = list(found.values())
        return pa.record_batch(
            [pa.array(digests, pa.int64()), pa.array(list(found), pa.binary()),
             *[pa.array([v[i] for v in values], pa.int64()) for i in range(3)]],
            ["digest", "key", "newest", "copies", "newest_rows"],
        )

    for batch in batches:
        for doc, key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            doc = NO_ID if doc is None else doc
            seen = found.get(key)
            if seen is None:
                found[key] = [doc, 1, 1]
                continue
            seen[1] += 1
            if doc == seen[0]:
                seen[2] += 1
            elif doc > seen[0]:
                seen[0], seen[2] = doc, 1
        if len(found) >= FLUSH:
            yield out()
            found.clear()
    yield out()


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    index = CuckooIndex()
    for batch in batches:
        for entry in zip(*[batch.column(i).to_pylist() for i in range(5)], strict=True):
            digest, key, newest, copies, newest_rows = entry
            index.add(digest & 0xFFFFFFFFFFFFFFFF, key, newest, copies, newest_rows)
    part: list[tuple] = []

    def out() -> pa.RecordBatch:
        ids = [None if e[2] == NO_ID else e[2] for e in part]
        return pa.record_batch(
            [pa.array([e[1] for e in part], pa.binary()), pa.array(ids, pa.int64()),
             pa.array([e[3] for e in part], pa.int64()), pa.array([e[4] for e in part], pa.int64())],
            ["key", "keep_id", "group_size", "newest_rows"],
        )

    for entry in index.entries():
        part.append(entry)
        if len(part) == 50_000:
            yield out()
            part.clear()
    yield out()


def text_keys(docs: DataFrame) -> DataFrame:
    """(doc_id, key): SHA-256 of the normalised text for every row; a null text is the empty one."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(_digest_rows, DIGESTS)


def classes(keys: DataFrame) -> DataFrame:
    """(key, keep_id, group_size, newest_rows): one row a text, by the cuckoo index."""
    entries = keys.mapInArrow(_combine, ENTRIES)
    return entries.repartition("digest").mapInArrow(_index, CLASSES)


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """One row for each row of docs (doc_id, text; other columns are not read): doc_id, keep_id,
    group_size, kept, text_sha256.

    The row with the largest doc_id of equal texts stays. Null and empty texts are equal. A null doc_id
    is smaller than any other. Rows that repeat the largest doc_id: one of them stays. An empty table
    gives an empty result.
    """
    keys = stored(text_keys(docs), "keys")
    found = stored(classes(keys), "classes")
    joined = join_by_key(keys, found, "key", "group_size")
    newest = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    # Only rows that repeat a doc_id need to be told apart.
    plain = joined.filter((F.col("newest_rows") == 1) | ~newest).withColumn("kept", newest)
    repeated = joined.filter((F.col("newest_rows") > 1) & newest).withColumn(
        "kept", F.row_number().over(Window.partitionBy("key", "doc_id").orderBy("group_size")) == 1
    )
    return plain.unionByName(repeated).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("key")).alias("text_sha256")
    )


def without_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, with all their columns; see `exact_duplicates`. Of rows equal in doc_id and text one stays, also
    where the doc_id is null; null texts count as empty ones. An empty table gives an empty one."""
    found = stored(exact_duplicates(docs), "duplicates")
    docs = docs.withColumn("text", F.col("text").cast("string"))
    key, kept_id, kept_key = (free_name(docs, n) for n in (KEY, "_id_kept", "_key_kept"))
    kept = found.filter("kept").select(F.col("doc_id").alias(kept_id), F.unhex("text_sha256").alias(kept_key))
    place = docs.columns.index("text")

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(place)
            keys = next(_digest_rows(iter([pa.record_batch([text, text], ["doc_id", "text"])]))).column(1)
            yield pa.record_batch([*batch.columns, keys], [*batch.schema.names, key])

    rows = docs.mapInArrow(keyed, T.StructType([*docs.schema.fields, T.StructField(key, T.BinaryType())]))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(kept_id)) & (F.col(key) == F.col(kept_key))
    left = rows.join(kept, same, "left_semi")
    # Rows that repeat a document as a whole are told apart only if there are any.
    if not found.groupBy("doc_id", "text_sha256").agg(F.count("*").alias("n")).filter("n > 1").isEmpty():
        left = left.dropDuplicates(["doc_id", key])
    return left.drop(key)
