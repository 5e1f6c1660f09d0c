"""Near duplicates by SimHash, found through a segment-popcount embedding.

A fingerprint is cut into 32 segments of two bits, and each segment mapped to its number of set bits. The
Manhattan distance between two such vectors is never larger than the number of differing bits, so links
can be sought by a range join of the vectors. The vector is kept in thermometer code (count 0, 1, 2 as bits 00,
01, 11), where the Manhattan distance is a bit count again.

The grid has one axis a segment and cells of width one. The axes form `groups`; a distance of `bits` touches
at most `bits` groups, so two linked vectors agree on some `groups - bits` whole groups. Each
vector is therefore filed under one cell for each choice of so many groups, and meets all vectors within
the distance in at least one cell. Within a cell the Manhattan bound comes first, then the differing bits are
counted exactly.

Only different fingerprints take part, one row each. A cell gives all its links where they are
few, and a spanning forest of them where a group of copies is dense. For distances up to 4, cells larger than any task
should hold are exchanged for balls: fingerprints within 4 bits of each other share a point within 2 bits of both. Balls
of larger distances have too many points; there a large cell is compared block by block in its task.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caudal.llm.common import (
    LOWER, SPACE, free_name, groups_for, grouped, join_by_key, mixed, packed, slices, stored, string_bytes, unpacked, word_spans,
)
from caudal.llm.components import components

SHINGLE, BITS, SPARE = 4, 4, 3
EVEN = np.uint64(0x5555555555555555)
ONE = np.uint64(1)
#: Points of one cell from one sender, and in all, beyond which the cell is exchanged for balls.
CELL_SENT, CELL = 1024, 20_000
#: The largest distance for which balls are small enough.
BALL_BITS = 4
#: Points that a sender files at once, bytes of a group of cells, and pairs compared at once.
FLUSH, GROUP_BYTES, PAIRS = 20_000, 4 << 20, 1 << 22
#: Shingles hashed at once.
BLOCK = 1 << 16


# ---------------------------------------------------------------- fingerprints


def fingerprint(text: np.ndarray, shingle: int) -> int:
    """SimHash of the word shingles of a text (lower-cased bytes), repeats included."""
    starts, ends = word_spans(text, SPACE)
    if not len(starts):
        return 0
    # Words joined by one space: bytes that are no white space, each word followed by a space.
    joined = np.full(int((ends - starts).sum()) + len(starts), 32, np.uint8)
    to = np.concatenate([[0], np.cumsum(ends - starts + 1)])
    inside = np.ones(len(joined), bool)
    inside[to[1:] - 1] = False
    joined[inside] = text[~SPACE[text]]
    data, to = joined.tobytes(), to.tolist()
    n = max(len(starts) - shingle + 1, 1)
    width = min(shingle, len(starts))
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, BLOCK):
        hashes = np.fromiter(
            (digest(data[a : b - 1], 42) for a, b in zip(to[at : min(at + BLOCK, n)], to[at + width : at + width + BLOCK], strict=False)),
            np.uint64, min(BLOCK, n - at),
        )
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(shingles: tuple[int, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = string_bytes(batch.column(1))
            columns = [[] for _ in shingles]
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                text = LOWER[data[a:b]]
                for column, shingle in zip(columns, shingles, strict=True):
                    column.append(fingerprint(text, shingle))
            columns = [pa.array(np.array(c, np.uint64).view(np.int64)) for c in columns]
            yield pa.record_batch([batch.column(0), *columns], ["doc_id", *(f"f{s}" for s in shingles)])

    return run


# ---------------------------------------------------------------- grid


def embedded(points: np.ndarray) -> np.ndarray:
    """Bit counts of the two-bit segments, in thermometer code."""
    low, high = points & EVEN, (points >> ONE) & EVEN
    return (low | high) | ((low & high) << ONE)


def grid(bits: int, spare: int) -> list[int]:
    """Masks of the axes of each kind of cell: `spare` of bits + spare groups of segments."""
    groups = bits + spare
    edges = [round(i * 32 / groups) for i in range(groups + 1)]
    masks = [sum(3 << (2 * s) for s in range(a, b)) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    return [sum(chosen) for chosen in itertools.combinations(masks, spare)]


def _send_cells(masks: list[int], buckets: int, balls: bool):
    """Points (columns: fingerprints, then node) to blobs of their cells. Where one sender has many points of a cell,
    it sends a mark instead, and the points for balls."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, FLUSH):
                part = batch.slice(at, FLUSH)
                columns = [c.to_numpy(zero_copy_only=False) for c in part.columns]
                vector = embedded(columns[0].view(np.uint64))
                rows = []
                many = np.zeros(part.num_rows, bool)
                for k, mask in enumerate(masks):
                    cell = mixed((vector & np.uint64(mask)) + np.uint64(k * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
                    kinds, which, count = np.unique(cell, return_inverse=True, return_counts=True)
                    mine = (count[which] > CELL_SENT) & balls
                    many |= mine
                    for b, c in grouped((cell[~mine] % np.uint64(buckets)).astype(np.int64), [cell[~mine], *(c[~mine] for c in columns)]):
                        rows.append((b, 0, packed(*c)))
                    full = kinds[(count > CELL_SENT) & balls]
                    for b, c in grouped((full % np.uint64(buckets)).astype(np.int64), [full]):
                        rows.append((b, 1, packed(*c)))
                if many.any():
                    keys = columns[0][many].view(np.uint64) % np.uint64(buckets)
                    rows += [(b, 2, packed(*c)) for b, c in grouped(keys.astype(np.int64), [c[many] for c in columns])]
                # One blob a bucket and kind.
                joined: dict[tuple[int, int], list[bytes]] = {}
                for b, kind, blob in rows:
                    joined.setdefault((b, kind), []).append(blob)
                if joined:
                    keys = list(joined)
                    yield pa.record_batch(
                        [pa.array([b for b, _ in keys], pa.int32()), pa.array([k for _, k in keys], pa.int32()), pa.array([joined[k] for k in keys], pa.list_(pa.binary()))],
                        ["bucket", "kind", "blobs"],
                    )

    return run


def _forest(close, n: int) -> Iterator[tuple[int, int]]:
    """Spanning forest of the links among n points; close(i, rest) tells which of the rest are linked to i."""
    rest = np.arange(n)
    waiting: list[int] = []
    while len(rest) or waiting:
        if not waiting:
            waiting.append(int(rest[0]))
            rest = rest[1:]
        i = waiting.pop()
        if not len(rest):
            return
        linked = close(i, rest)
        for j in rest[linked].tolist():
            yield i, j
            waiting.append(j)
        rest = rest[~linked]


def cell_links(points: list[np.ndarray], limits: list[int], cut: np.ndarray) -> list[np.ndarray]:
    """Links (rows of indexes) of points sorted by cell; cut has the bounds of the cells. All fingerprints of
    linked points differ by at most their limits."""
    vector = embedded(points[0])
    found: list[np.ndarray] = []

    def exact(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        out = np.ones(len(i), bool)
        for p, limit in zip(points, limits, strict=True):
            out &= np.bitwise_count(p[i] ^ p[j]) <= limit
        return out

    size = np.diff(cut)
    small = np.flatnonzero((size > 1) & (size <= 24))
    first, end = cut[small], cut[small + 1]
    for d in range(1, int(size[small].max()) if len(small) else 0):
        keep = end - first > d
        first, end = first[keep], end[keep]
        n = end - first - d
        i = np.repeat(first, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        i = i[np.bitwise_count(vector[i] ^ vector[i + d]) <= limits[0]]  # the Manhattan bound
        i = i[exact(i, i + d)]
        found.append(np.stack([i, i + d]))
    for k in np.flatnonzero(size > 24).tolist():
        a, b = int(cut[k]), int(cut[k + 1])
        mine, pairs, total = vector[a:b], [], 0
        step = max(PAIRS // (b - a), 1)
        for at in range(0, b - a, step):
            near = np.bitwise_count(mine[at : at + step, None] ^ mine[None, at:]) <= limits[0]
            i, j = np.nonzero(near)
            i, j = i + at, j + at
            i, j = i[i < j] + a, j[i < j] + a
            yes = exact(i, j)
            pairs.append(np.stack([i[yes], j[yes]]))
            total += int(yes.sum())
            if total > 16 * (b - a):  # dense: a forest says as much

                def close(i, rest, a=a):
                    return exact(np.full(len(rest), a + i), a + rest)

                pairs = [np.array(list(_forest(close, b - a)), np.int64).reshape(-1, 2).T + a]
                break
        found += pairs
    return found


def _cells(table: pa.Table, kinds: list[str], kind: int) -> list[np.ndarray]:
    blobs = [b for k, bs in zip(table.column("kind").to_pylist(), table.column("blobs").to_pylist(), strict=True) if k == kind for b in bs]
    return unpacked(blobs, kinds)


def _links_of_cells(limits: list[int], with_balls: bool):
    names = [*(f"p{i}" for i in range(len(limits))), "node"]

    def run(table: pa.Table) -> pa.Table:
        kinds = ["u8"] * len(limits) + ["i8"]
        cell, *columns = _cells(table, ["u8", *kinds], 0)
        (full,) = _cells(table, ["u8"], 1)
        balls = _cells(table, kinds, 2)
        order = np.argsort(cell, kind="stable")
        cell, columns = cell[order], [c[order] for c in columns]
        cut = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1], [True]])) if len(cell) else np.zeros(1, np.int64)
        size = np.diff(cut)
        large = ((size > CELL) | np.isin(cell[cut[:-1]], full)) & with_balls if len(cell) else np.zeros(0, bool)
        if large.any():
            out = np.repeat(large, size)
            balls = [np.concatenate([b, c[out]]) for b, c in zip(balls, columns, strict=True)]
            columns, cut = [c[~out] for c in columns], np.concatenate([[0], np.cumsum(size[~large])])
        found = cell_links(columns[:-1], limits, cut)
        pairs = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
        node = columns[-1]
        links = np.unique(np.stack([np.minimum(node[pairs[0]], node[pairs[1]]), np.maximum(node[pairs[0]], node[pairs[1]])]), axis=1)
        none = pa.nulls(links.shape[1], pa.int64())
        data = {"a": pa.array(links[0]), "b": pa.array(links[1])} | {n: none for n in names}
        table = pa.table(data)
        if len(balls[-1]):
            empty = pa.nulls(len(balls[-1]), pa.int64())
            more = {"a": empty, "b": empty} | {n: pa.array(c.view(np.int64)) for n, c in zip(names, balls, strict=True)}
            table = pa.concat_tables([table, pa.table(more)])
        return table

    return run


def _balls(bits: int):
    """Points to all points within half the distance, one row each. For an odd distance, pairs within the smaller half
    of one and the larger half of the other: marked by side."""
    reach = [bits // 2, bits - bits // 2]
    flips = [
        np.array([sum(1 << i for i in c) for r in range(n + 1) for c in itertools.combinations(range(64), r)], np.uint64) for n in reach
    ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = batch.column(0).to_numpy().view(np.uint64)
            for i in range(batch.num_rows):
                for side in range(1 if reach[0] == reach[1] else 2):
                    keys = (flips[side] ^ points[i]).view(np.int64)
                    rest = [pa.array(np.full(len(keys), c[i].as_py(), np.int64)) for c in batch.columns]
                    yield pa.record_batch([pa.array(keys), pa.array(np.full(len(keys), side, np.int32)), *rest], ["ball", "side", *batch.schema.names])

    return run


def links_within(points: DataFrame, limits: list[int], spare: int) -> DataFrame:
    """Links (a, b) between nodes of points (p0 long, ..., node long) whose fingerprints all differ by at most their
    limits: all that share a cell, or a forest that connects the same nodes."""
    spark = points.sparkSession
    masks, balls = grid(limits[0], spare), limits[0] <= BALL_BITS and len(limits) == 1
    names = [*(f"p{i}" for i in range(len(limits))), "node"]
    buckets = groups_for(spark, points.count() * len(masks) * 8 * (len(names) + 1), GROUP_BYTES)
    filed = points.select(*names).mapInArrow(_send_cells(masks, buckets, balls), "bucket int, kind int, blobs array<binary>")
    schema = "a long, b long, " + ", ".join(f"{n} long" for n in names)
    found = stored(filed.groupBy("bucket").applyInArrow(_links_of_cells(limits, balls), schema), "links")
    links = found.filter("a is not null").select("a", "b")
    dense = found.filter("a is null").select(*names)
    if dense.isEmpty():
        return links
    return links.unionByName(_links_of_balls(dense.distinct(), limits))


def _links_of_balls(points: DataFrame, limits: list[int]) -> DataFrame:
    """Links among points of very full cells. Points that share a ball's centre are within twice its radius of each other;
    each is linked to the smallest node there."""
    schema = "ball long, side int, " + ", ".join(f"{n} long" for n in points.columns)
    balls = stored(points.mapInArrow(_balls(limits[0]), schema), "balls")
    # The smaller half's points are linked to the centre's smallest node of the larger half, and the other way round.
    one, other = (0, 0) if limits[0] % 2 == 0 else (0, 1)
    pairs = None
    for a, b in {(one, other), (other, one)}:
        least = balls.filter(F.col("side") == b).groupBy("ball").agg(F.min("node").alias("least"), F.count("*").alias("size"))
        found = join_by_key(balls.filter(F.col("side") == a), least, "ball", "size").filter("least is not null and node <> least")
        found = found.select(F.col("node").alias("a"), F.col("least").alias("b"))
        pairs = found if pairs is None else pairs.unionByName(found)
    return pairs.distinct()


# ---------------------------------------------------------------- operator


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS, spare: int = SPARE,
    second: int | None = None, second_bits: int = 0,
) -> DataFrame:
    """One row for each row of docs (doc_id, text; other columns are not read): doc_id, fingerprint (64 bits as a
    long), component_id (the smallest doc_id that can be reached over links, itself included).

    Fingerprints of `shingle`-word shingles of the text in lower case (A-Z) link at `bits` or fewer differing bits.
    With `second`, fingerprints of so long shingles must also agree but for `second_bits`. Null, empty and blank
    texts have fingerprint zero and are linked like any other. Rows without doc_id take part only
    through equal fingerprints; a component without any doc_id is null. Repeated rows get equal results.
    """
    shingles = (shingle,) if second is None else (shingle, second)
    limits = [bits] if second is None else [bits, second_bits]
    schema = "doc_id long, " + ", ".join(f"f{s} long" for s in shingles)
    prints = stored(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_fingerprints(shingles), schema), "prints")
    columns = [f"f{s}" for s in shingles]
    classes = stored(
        prints.groupBy(*columns).agg(F.min("doc_id").alias("node"), F.count("*").alias("size")), "classes"
    )
    points = classes.filter("node is not null").select(*[F.col(c).alias(f"p{i}") for i, c in enumerate(columns)], "node")
    found = components(links_within(points, limits, spare))
    named = classes.join(found, "node", "left").select(
        F.struct(*columns).alias("key"), F.coalesce("component", "node").alias("component_id"), "size"
    )
    rows = prints.select("doc_id", F.col(columns[0]).alias("fingerprint"), F.struct(*columns).alias("key"))
    return join_by_key(rows, stored(named, "named"), "key", "size").select("doc_id", "fingerprint", "component_id")


def without_near_duplicates(docs: DataFrame, **parameters) -> DataFrame:
    """The rows of docs, with all their columns, whose doc_id is the smallest of its component; rows without doc_id stay,
    and so do repeated rows of a doc_id that stays. Of texts without words, which all are near duplicates, one stays. An empty table gives
    an empty one. See `near_duplicates` for the parameters."""
    found, name = near_duplicates(docs, **parameters), free_name(docs, "_gone")
    gone = found.filter("doc_id <> component_id").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone, F.col("doc_id").cast("long") == F.col(name), "left_anti")
