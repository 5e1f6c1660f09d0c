"""Byte-level BPE encoding in overlapping chunks, and decoding.

A long text is cut into chunks that overlap. Each chunk is pre-tokenised on its own, from its first character on. What
the pattern matches at a place depends only on the text from there on, so once two chunks have a boundary at the
same place of their overlap they agree from there: that place is a stitch. The pieces between stitches are encoded in
parallel, and the ids of a text are those of its pieces in order. Where two neighbours have no common boundary
(a match longer than the overlap), the chunks stay one piece. Near its end a chunk may see less than the pattern would
look at, so boundaries in the last part of it don't count.

Each match of the pattern is encoded by merging the adjacent pair of lowest rank, leftmost first, until no pair
has a rank. Decoding joins the bytes of the ids.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caudal.llm.common import importable, stored

#: Characters of a chunk and of its overlap with the next.
CHUNK, OVERLAP = 1 << 15, 1 << 10
#: A boundary counts in a chunk if so many characters follow it there.
MARGIN = 128
#: Matches whose ids a worker remembers.
REMEMBERED = 1 << 18


@lru_cache(maxsize=2)
def vocabulary(path: str) -> tuple[dict[bytes, int], list[bytes]]:
    """Ranks by bytes, and bytes by id, of a file of base64 tokens with ranks."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return ranks, tokens


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one match of the pattern."""
    if (whole := ranks.get(piece)) is not None:
        return [whole]
    if len(piece) > 64:
        return _merged_long(piece, ranks)
    cuts, get, far = list(range(len(piece) + 1)), ranks.get, len(ranks) * 2
    pairs = [get(piece[i : i + 2], far) for i in range(len(piece) - 1)]
    while pairs:
        best = min(pairs)
        if best == far:
            break
        i = pairs.index(best)
        del cuts[i + 1], pairs[i]
        if i:
            pairs[i - 1] = get(piece[cuts[i - 1] : cuts[i + 1]], far)
        if i < len(pairs):
            pairs[i] = get(piece[cuts[i] : cuts[i + 2]], far)
    return [ranks[piece[a:b]] for a, b in zip(cuts, cuts[1:], strict=False)]


def _merged_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same with a heap of pairs, for matches of any length."""
    end = list(range(1, len(piece) + 1))  # of the part that starts here
    before = list(range(-1, len(piece) - 1))
    alive = [True] * len(piece)
    heap = [(r, i, i + 2) for i in range(len(piece) - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, to = heapq.heappop(heap)
        if not alive[i]:
            continue
        j = end[i]
        if j >= len(piece) or end[j] != to:
            continue  # a part of this pair has changed
        alive[j] = False
        end[i] = to
        if to < len(piece):
            before[to] = i
            if (r := ranks.get(piece[i : end[to]])) is not None:
                heapq.heappush(heap, (r, i, end[to]))
        if (h := before[i]) >= 0 and (r := ranks.get(piece[h:to])) is not None:
            heapq.heappush(heap, (r, h, to))
    out, i = [], 0
    while i < len(piece):
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


class Encoder:
    def __init__(self, path: str, pattern: str):
        self.ranks, _ = vocabulary(path)
        self.find = regex.compile(pattern).findall
        self.known: dict[str, tuple[int, ...]] = {}

    def ids(self, text: str) -> np.ndarray:
        known, matches = self.known, self.find(text)
        found = list(map(known.get, matches))
        for i in [i for i, ids in enumerate(found) if ids is None]:
            match = matches[i]
            if (ids := known.get(match)) is None:  # else it has come up earlier in this text
                ids = tuple(merged(match.encode(), self.ranks))
                if len(match) <= 64:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[match] = ids
            found[i] = ids
        return np.fromiter(chain.from_iterable(found), "<u4")


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


def boundaries(text: str, pattern: str) -> np.ndarray:
    """Starts of the matches of the pattern, by character."""
    return np.array([m.start() for m in regex.finditer(pattern, text)], np.int64)


# ---------------------------------------------------------------- Spark


def _bounds_of_chunks(pattern: str, chunk: int, overlap: int):
    """Chunks (row, chunk, text) to the boundaries in their first and last overlaps, by character of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads, tails = [], []
            for number, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                found = boundaries(text, pattern)
                sure = found[found < len(text) - MARGIN]
                heads.append((sure[sure < overlap] + number * chunk).tolist())
                tails.append((sure[sure >= chunk] + number * chunk).tolist())
            kind = pa.list_(pa.int64())
            yield pa.record_batch([*batch.columns[:2], pa.array(heads, kind), pa.array(tails, kind)], ["row", "chunk", "head", "tail"])

    return run


def _encode(path: str, pattern: str):
    """Pieces (columns, then text) to their ids as 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = [code.ids(t).tobytes() if t else b"" for t in part.column(part.num_columns - 1).to_pylist()]
                yield pa.record_batch([*part.columns[:-1], pa.array(ids, pa.binary())], [*part.schema.names[:-1], "ids"])

    return run


def _join_pieces(table: pa.Table) -> pa.Table:
    order = np.argsort(table.column("start").to_numpy())
    ids = table.column("ids").to_pylist()
    return pa.table({"doc_id": table.column("doc_id")[:1], "ids": pa.array([b"".join(ids[i] for i in order)], pa.binary())})


def _decode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, tokens = vocabulary(path)
        get = tokens.__getitem__
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                text = [b"".join(map(get, np.frombuffer(ids, "<u4").tolist())) for ids in part.column("ids").to_pylist()]
                yield pa.record_batch([*part.columns, pa.array(text, pa.binary())], [*part.schema.names, "decoded"])

    return run


def encoded(docs: DataFrame, path: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """One row for each row of docs (doc_id, text; other columns are not read): doc_id, ids (the token ids as
    little-endian unsigned 32-bit integers, in one binary). Null and empty texts have no ids. Nothing depends on
    doc_id, so null and repeated ones are fine. The vocabulary file must be readable on every executor."""
    importable(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    length = F.length("text")
    short = docs.filter(length <= chunk).mapInArrow(_encode(path, pattern), "doc_id long, ids binary")
    long = docs.filter(length > chunk)
    pieces = stitched(long, pattern, chunk, overlap)
    ids = pieces.repartition("row", "start").mapInArrow(_encode(path, pattern), "row long, doc_id long, start long, ids binary")
    return short.unionByName(ids.groupBy("row").applyInArrow(_join_pieces, "doc_id long, ids binary"))


def stitched(long: DataFrame, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """Pieces (row, doc_id, start, text) of long texts between stitches; row numbers the rows of long."""
    rows = stored(long.withColumn("row", F.monotonically_increasing_id()), "long")
    last = F.greatest(F.ceil((F.length("text") - overlap) / F.lit(chunk)).cast("long") - 1, F.lit(0))
    chunks = rows.select("row", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("chunk"), "text").select(
        "row", "chunk", F.col("text").substr((F.col("chunk") * chunk + 1).cast("int"), F.lit(chunk + overlap)).alias("text")
    )
    bounds = chunks.repartition("row", "chunk").mapInArrow(
        _bounds_of_chunks(pattern, chunk, overlap), "row long, chunk long, head array<long>, tail array<long>"
    )
    by_row = Window.partitionBy("row").orderBy("chunk")
    starts = bounds.withColumn("common", F.array_intersect("head", F.lag("tail").over(by_row))).select(
        "row", F.when(F.col("chunk") == 0, F.lit(0).cast("long")).otherwise(F.array_min("common")).alias("start")
    ).filter("start is not null")
    ends = starts.withColumn("end", F.lead("start").over(Window.partitionBy("row").orderBy("start")))
    cut = F.col("text").substr((F.col("start") + 1).cast("int"), (F.coalesce(F.col("end"), F.length("text").cast("long")) - F.col("start")).cast("int"))
    return rows.join(ends, "row").select("row", "doc_id", "start", cut.alias("text"))


def decoded(ids: DataFrame, path: str) -> DataFrame:
    """Adds decoded, the bytes of the ids, to a table whose columns are doc_id and ids."""
    importable(ids.sparkSession)
    return ids.select("doc_id", "ids").mapInArrow(_decode(path), "doc_id long, ids binary, decoded binary")
