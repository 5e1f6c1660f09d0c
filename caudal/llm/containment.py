"""Benchmark decontamination by size-partitioned MinHash containment search.

Containment of an item in a document is the share of the item's word shingles that the document has. A document's own
MinHash signature says little about a short item in it, so items are partitioned by size, and for items
of up to u shingles a document is seen as blocks of 2u shingles that overlap by half: a passage of u lies whole
in one of them, and the item and the block are of comparable size. Signatures are one-permutation MinHashes of 4u bins:
the smallest hash of each bin. A block and an item that agree in any bin are a candidate, and a candidate is
verified by exact containment over the whole document, on the words themselves.

With at least 14 of 17 shingles shared, each of which is the smallest of its bin on both sides with a chance of
about 0.7, a contained item is missed once in ten million. Items of up to 16 shingles get no signature: all their
shingles are looked up.

Items are broadcast in blocks of bounded size, documents are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caudal.llm.common import NOT_WORD, gram_hashes, importable, string_bytes, word_hashes, word_spans

SHINGLE, SHARE = 5, 0.8
#: What separates words beside the ASCII separators: all that is no letter, mark or digit.
OTHER = r"[^\x00-\x7F\p{L}\p{M}\p{N}]+"
#: Items of at most so many shingles are looked up shingle by shingle.
WHOLE = 16
BINS = 4
#: Bytes of item text that are broadcast at once.
ITEM_BYTES = 8 << 20
FOUND = "doc_id long, item_id long, n_shared long, n_shingles long, containment double"


def plain(texts: pa.Array | pa.Scalar) -> pa.Array | pa.Scalar:
    """Texts in lower case, with separators in ASCII only."""
    return pc.utf8_lower(pc.replace_substring_regex(texts, OTHER, " "))


def words_of(text: bytes) -> list[bytes]:
    data = np.frombuffer(text, np.uint8)
    return [text[a:b] for a, b in zip(*(x.tolist() for x in word_spans(data, NOT_WORD)), strict=True)]


def shingles_of(words: list[bytes], width: int) -> set[bytes]:
    return {b" ".join(words[i : i + width]) for i in range(len(words) - width + 1)}


class Items:
    """Signatures of a block of items, by size."""

    def __init__(self, items: list[tuple[int | None, bytes]], shingle: int, share: float):
        self.shingle, self.share = shingle, share
        self.ids: list[int | None] = []
        self.texts: list[set[bytes]] = []
        self.widths: list[int] = []
        values: dict[tuple[int, int], list[tuple[np.ndarray, int]]] = {}
        for item_id, text in items:
            words = words_of(text)
            if not words:
                continue
            width = min(shingle, len(words))  # an item of fewer words is one shingle
            k = len(self.ids)
            self.ids.append(item_id)
            self.widths.append(width)
            self.texts.append(shingles_of(words, width))
            data = np.frombuffer(text, np.uint8)
            hashes = np.unique(gram_hashes(word_hashes(data, *word_spans(data, NOT_WORD)), width))
            if len(hashes) <= WHOLE:
                values.setdefault((width, 0), []).append((hashes, k))
            else:
                u = 1 << (len(hashes) - 1).bit_length()
                values.setdefault((width, u), []).append((minima(hashes, BINS * u), k))
        #: By width and size class: sorted values and, beside them, the items they belong to.
        self.classes = {}
        for key, parts in values.items():
            flat = np.concatenate([h for h, _ in parts])
            owner = np.concatenate([np.full(len(h), k) for h, k in parts])
            order = np.argsort(flat, kind="stable")
            self.classes[key] = flat[order], owner[order]


def minima(hashes: np.ndarray, bins: int) -> np.ndarray:
    """The smallest hash of each bin that has any; hashes in ascending order."""
    return hashes[np.unique(hashes % np.uint64(bins), return_index=True)[1]]


def survivors(hashes: np.ndarray, order: np.ndarray, u: int) -> np.ndarray:
    """Which shingles of a document are the smallest of their bin in a block of 2u shingles; order sorts the
    hashes in descending order."""
    bins = BINS * u
    half = np.arange(len(hashes)) // u
    n = int(half[-1]) + 1
    place = half * bins + (hashes % np.uint64(bins)).astype(np.int64)
    least = np.full(n * bins, np.uint64(2**64 - 1))
    least[place[order]] = hashes[order]  # the last one written is the smallest
    block = least.copy()
    block[: (n - 1) * bins] = np.minimum(block[: (n - 1) * bins], least[bins:])
    before = np.maximum(place - bins, place % bins)  # the block that begins a half earlier
    return (block[place] == hashes) | (block[before] == hashes)


def owners(values: np.ndarray, items: np.ndarray, hashes: np.ndarray) -> set[int]:
    """Items that one of the hashes belongs to."""
    low = np.searchsorted(values, hashes)
    there = values[np.minimum(low, len(values) - 1)] == hashes
    found = np.unique(hashes[there])
    out: set[int] = set()
    for a, b in zip(np.searchsorted(values, found).tolist(), np.searchsorted(values, found, "right").tolist(), strict=True):
        out.update(items[a:b].tolist())
    return out


#: Bits of the table that tells quickly that a hash belongs to no item.
TABLE = 20


class Search:
    """Finds items in texts; made once a task."""

    def __init__(self, items: Items):
        self.items = items
        self.mask = np.uint64((1 << TABLE) - 1)
        self.tables = {}
        for key, (values, _) in items.classes.items():
            self.tables[key] = np.zeros(1 << TABLE, bool)
            self.tables[key][(values & self.mask).astype(np.int64)] = True
        self.widths = sorted({w for w, _ in items.classes})

    def candidates(self, text: np.ndarray) -> set[int]:
        starts, ends = word_spans(text, NOT_WORD)
        found: set[int] = set()
        if not len(starts):
            return found
        symbols = word_hashes(text, starts, ends)
        for width in self.widths:
            hashes = gram_hashes(symbols, width)
            order = None
            for (w, u), (values, owner) in self.items.classes.items():
                if w != width or not len(hashes):
                    continue
                maybe = self.tables[w, u][(hashes & self.mask).astype(np.int64)]
                if not maybe.any():
                    continue
                if u:
                    order = np.argsort(hashes)[::-1] if order is None else order
                    maybe &= survivors(hashes, order, u)
                found |= owners(values, owner, hashes[maybe])
        return found

    def text(self, text: np.ndarray) -> list[tuple[int | None, int, int]]:
        """(item_id, shared shingles, shingles) of the items contained in a text."""
        candidates, items = self.candidates(text), self.items
        if not candidates:
            return []
        words = words_of(text.tobytes())
        own = {w: shingles_of(words, w) for w in {items.widths[k] for k in candidates}}
        out = []
        for k in sorted(candidates):
            shared, n = len(items.texts[k] & own[items.widths[k]]), len(items.texts[k])
            if shared >= items.share * n:
                out.append((items.ids[k], shared, n))
        return out

    def column(self, column: pa.Array) -> list[list[tuple]]:
        data, offsets = string_bytes(plain(column))
        return [self.text(data[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]


def _rows_found(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(sent.value)
        for batch in batches:
            rows = [(i, *found) for i, each in enumerate(search.column(batch.column(1))) for found in each]
            i, item, shared, n = zip(*rows, strict=True) if rows else ((), (), (), ())
            yield pa.record_batch(
                [batch.column(0).take(pa.array(i, pa.int64())), *(pa.array(c, pa.int64()) for c in (item, shared, n)),
                 pa.array([s / m for s, m in zip(shared, n, strict=True)], pa.float64())],
                ["doc_id", "item_id", "n_shared", "n_shingles", "containment"],
            )

    return run


def _rows_without(sent, place: int):
    """Rows whose column `place`, the text, holds no item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(sent.value)
        for batch in batches:
            yield batch.filter(pa.array([not found for found in search.column(batch.column(place))], pa.bool_()))

    return run


def _item_blocks(items: DataFrame, shingle: int, share: float) -> Iterator:
    """Items in broadcast blocks of bounded size."""
    context = items.sparkSession.sparkContext
    items = items.select(F.col("item_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    n = -(-(items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // ITEM_BYTES)
    for k in range(n):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k) if n > 1 else items
        yield context.broadcast(Items([(r[0], plain(pa.scalar(r[1])).as_py().encode()) for r in part.collect()], shingle, share))


def contained(docs: DataFrame, items: DataFrame, shingle: int = SHINGLE, share: float = SHARE) -> DataFrame:
    """(doc_id, item_id, n_shared, n_shingles, containment) for each row of docs (doc_id, text) and row of items (item_id,
    text) whose containment is at least `share`; other columns are not read.

    Words are runs of letters, marks and digits of any script, in lower case. An item of fewer words than a shingle is one shingle of all its
    words. Items and documents without words (null, empty, blank) are in no row. Null ids stay null. Rows that repeat
    give rows that repeat. No items or no documents give an empty result.
    """
    spark = docs.sparkSession
    importable(spark)
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    out = spark.createDataFrame([], FOUND)
    for k, sent in enumerate(_item_blocks(items, shingle, share)):
        found = docs.mapInArrow(_rows_found(sent), FOUND)
        out = out.unionByName(found) if k else found
    return out


def without_contained(docs: DataFrame, items: DataFrame, shingle: int = SHINGLE, share: float = SHARE) -> DataFrame:
    """The rows of docs, with all their columns, that hold none of the items; see `contained`."""
    importable(docs.sparkSession)
    docs = docs.withColumn("text", F.col("text").cast("string"))
    for sent in _item_blocks(items, shingle, share):
        docs = docs.mapInArrow(_rows_without(sent, docs.columns.index("text")), docs.schema)
    return docs
