"""Exact top-k search by inner product with MaxScore over sharded integer vectors.

A position of the vectors is a query term; its postings are the vectors with a nonzero component there. For each chunk of a
shard, a term's score bound is the largest contribution any of the chunk's postings can make. The terms of smallest bound whose
sum stays below the query's threshold are non-essential: a vector found in none of the other, essential postings can't reach
the threshold. Essential postings are traversed term by term; vectors whose partial score plus the non-essential bounds reaches
the threshold are probed for the other terms, largest bound first, while they stay competitive. The threshold is the
last score kept so far. Shards are searched independently, and their results merged.

Vectors are dealt to shards by their content, so copies meet: of equal vectors a shard keeps the vector once with the k + 1
smallest ids, all that a result can need. Each query looks first at one shard; what it finds there is its threshold in the others.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caudal.llm.common import dropped, shuffle_partitions, stored

#: Different vectors in a shard at most, on average; a shard is one value of a row and a task's memory.
SHARD_ROWS = 1 << 16
#: A shard of a small table isn't made smaller than this.
LEAST_ROWS = 1 << 11
#: Queries that are searched together in one shard.
BLOCK_QUERIES = 1 << 10
#: Vectors that have their own score bounds.
CHUNK = 1 << 13
#: A term with a smaller share of nonzero components keeps positions and weights instead of a full column.
SPARSE = 0.25
#: Essential terms between two looks at whether anything can still reach the threshold.
LOOK = 8

INDEX = "shard int, terms int, kind string, weights binary, ids binary, copies binary"
BLOCK = "block int, terms int, kind string, weights binary, queries binary, thresholds binary"
FOUND = "query long, vec_id long, score long, own long"


class ScoreOverflow(ValueError):
    """Components are so large that a score may not fit 64 bits."""


# ---------------------------------------------------------------- packing


def _packed(lists: pa.ListArray) -> tuple[int, str, bytes]:
    """Terms, numpy type and bytes of the matrix (terms x vectors); short vectors are filled up with zeros."""
    lengths = np.diff(lists.offsets.to_numpy())
    terms, values = int(lengths.max(initial=0)), lists.flatten().to_numpy()
    matrix = np.zeros((len(lists), terms), np.int64)
    matrix[np.arange(terms) < lengths[:, None]] = values
    most = max(int(values.max(initial=0)), -int(values.min(initial=0)))
    kind = next(k for k in ("i1", "i2", "i4", "i8") if most <= np.iinfo(k).max)
    return terms, kind, np.ascontiguousarray(matrix.T).astype(kind).tobytes()


def _lists(table: pa.Table, name: str):
    column = table.column(name).combine_chunks()
    return column.chunk(0) if isinstance(column, pa.ChunkedArray) else column


def _pack_shard(table: pa.Table) -> pa.Table:
    terms, kind, data = _packed(_lists(table, "terms"))
    ids = _lists(table, "ids")
    row = (table.column("shard")[0].as_py(), terms, kind, data, ids.flatten().to_numpy().astype(np.int64).tobytes(),
           np.diff(ids.offsets.to_numpy()).astype(np.int64).tobytes())
    return pa.table([[v] for v in row], schema=_schema(INDEX))


def _pack_block(table: pa.Table) -> pa.Table:
    terms, kind, data = _packed(_lists(table, "terms"))
    row = (table.column("block")[0].as_py(), terms, kind, data, table.column("query").to_numpy().tobytes(),
           table.column("threshold").to_numpy().astype(np.float64).tobytes())
    return pa.table([[v] for v in row], schema=_schema(BLOCK))


_ARROW = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}


def _schema(text: str) -> pa.Schema:
    return pa.schema([(name, _ARROW[kind]) for name, kind in (part.split() for part in text.split(", "))])


# ---------------------------------------------------------------- search in one shard


class Chunk:
    """Postings of some vectors: a weight column a term, and the range of its weights."""

    def __init__(self, matrix: np.ndarray, number: type, first: int):
        self.first, self.size = first, matrix.shape[1]
        self.columns = matrix.astype(number)
        self.high, self.low = self.columns.max(1), self.columns.min(1)
        self.postings = {}
        filled = np.count_nonzero(matrix, axis=1)
        for term in np.flatnonzero(filled < SPARSE * self.size):
            where = np.flatnonzero(matrix[term])
            self.postings[int(term)] = (where, self.columns[term, where])
        missing = filled < self.size
        self.high[missing] = np.maximum(self.high[missing], 0)
        self.low[missing] = np.minimum(self.low[missing], 0)

    def scores(self, query: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """Places of the vectors that reach the threshold, and their exact scores."""
        bounds = np.maximum(query * self.high, query * self.low).astype(np.float64)
        order = np.argsort(bounds, kind="stable")
        sums = np.cumsum(bounds[order])
        if not len(order):
            every = np.arange(0 if threshold > 0 else self.size)
            return every, np.zeros(len(every), self.columns.dtype)
        if sums[-1] < threshold:
            return np.zeros(0, np.int64), self.columns[0, :0]
        below = np.flatnonzero(sums < threshold)
        split = int(below[-1]) + 1 if len(below) else 0
        rest = float(sums[split - 1]) if split else 0.0

        # Essential postings, largest bound first.
        score = np.zeros(self.size, self.columns.dtype)
        essential = order[split:][::-1]
        open_sum = float(sums[-1]) - rest
        for step, term in enumerate(essential.tolist()):
            open_sum -= bounds[term]
            if not query[term]:
                continue
            if term in self.postings:
                where, weights = self.postings[term]
                score[where] += query[term] * weights
            else:
                score += query[term] * self.columns[term]
            if step % LOOK == LOOK - 1 and float(score.max()) + open_sum + rest < threshold:
                return np.zeros(0, np.int64), score[:0]

        # Others are probed while competitive.
        at = np.flatnonzero(score + rest >= threshold)
        score = score[at]
        for term in order[:split][::-1].tolist():
            if not len(at):
                break
            rest -= bounds[term]
            if query[term]:
                score = score + query[term] * self.columns[term, at]
            keep = score + rest >= threshold
            if not keep.all():
                at, score = at[keep], score[keep]
        return at, score


class Shard:
    def __init__(self, terms: int, kind: str, weights: bytes, ids: bytes, copies: bytes):
        self.matrix = np.frombuffer(weights, kind).reshape(terms, -1)
        self.ids = np.frombuffer(ids, np.int64)
        self.ends = np.cumsum(np.frombuffer(copies, np.int64))
        self.starts = np.concatenate([[0], self.ends[:-1]])
        self.least = self.ids[self.starts]
        self.most = int(np.abs(self.matrix.astype(np.int64)).max(initial=0))
        self.chunks: dict[type, list[Chunk]] = {}

    def of(self, number: type) -> list[Chunk]:
        if number not in self.chunks:
            self.chunks = {number: [
                Chunk(self.matrix[:, a : a + CHUNK], number, a) for a in range(0, self.matrix.shape[1], CHUNK)
            ]}
        return self.chunks[number]

    def top(self, query: np.ndarray, count: int, threshold: float, number: type) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the best `count` vectors, copies included, with the given threshold or more."""
        best, scores = np.zeros(0, np.int64), np.zeros(0, number)
        for chunk in self.of(number):
            at, found = chunk.scores(query, threshold)
            if not len(at):
                continue
            best, scores = np.concatenate([best, at + chunk.first]), np.concatenate([scores, found])
            if len(best) > count:
                order = np.lexsort((self.least[best], -scores))[:count]
                best, scores = best[order], scores[order]
            if len(best) == count:
                threshold = max(threshold, float(scores.min()))
        copies = self.ends[best] - self.starts[best]
        scores = np.repeat(scores.astype(np.int64), copies)
        ids = np.concatenate([self.ids[self.starts[b] : self.ends[b]] for b in best]) if len(best) else best
        order = np.lexsort((ids, -scores))[:count]
        return ids[order], scores[order]


def _number(terms: int, left: int, right: int) -> type:
    """The smallest type in which every score and bound is exact."""
    most = terms * left * right
    if most < 1 << 24:
        return np.float32
    if most < 1 << 53:
        return np.float64
    raise ScoreOverflow(f"scores up to {most} are not exact in 53 bits")


def _search(count: int):
    def search(batches):
        known, shard = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["shard"] != known:
                    shard = Shard(row["terms"], row["kind"], row["weights"], row["ids"], row["copies"])
                    known = row["shard"]
                queries = np.frombuffer(row["q_weights"], row["q_kind"]).reshape(row["q_terms"], -1).T.astype(np.int64)
                common = min(queries.shape[1], shard.matrix.shape[0])
                number = _number(common, int(np.abs(queries).max(initial=0)), shard.most)
                wide = np.zeros((len(queries), shard.matrix.shape[0]), np.int64)
                wide[:, :common] = queries[:, :common]
                out = []
                for name, whole, query, threshold in zip(
                    np.frombuffer(row["queries"], np.int64), queries, wide.astype(number),
                    np.frombuffer(row["thresholds"], np.float64), strict=True,
                ):
                    ids, scores = shard.top(query, count, float(threshold), number)
                    out.append((np.full(len(ids), name), ids, scores, np.full(len(ids), whole @ whole)))
                columns = [np.concatenate(c) for c in zip(*out, strict=True)]
                yield pa.record_batch(columns, schema=_schema(FOUND))

    return search


# ---------------------------------------------------------------- operator


def quantised(df: DataFrame, scale: int, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, terms): floor(scale * x) of each component as a double. Rows without id, without vector or with a null or
    non-finite component are left out."""
    whole = df.where(F.col(id_column).isNotNull() & F.col(vector).isNotNull()).select(
        F.col(id_column).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("x")
    ).where(F.forall("x", lambda x: x.isNotNull() & (F.abs(x) < float("inf"))))
    return whole.select("id", F.transform("x", lambda x: F.floor(x * scale).cast("bigint")).alias("terms"))


def _by_shuffle(left: DataFrame, right: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """A join that sends neither side through the driver. Index, queries and thresholds all grow with the input, and stored
    in few bytes they can pass for small enough to be broadcast."""
    return left.hint("merge").join(right.hint("merge"), on, how)


def _with_thresholds(queries: DataFrame, found: DataFrame, count: int) -> DataFrame:
    """A query that has found `count` vectors needs no lower score than the last of them."""
    last = found.groupBy("query").agg(F.count("*").alias("n"), F.min("score").alias("last")).where(F.col("n") >= count)
    return _by_shuffle(queries, last.select("query", F.col("last").cast("double").alias("threshold")), "query", "left").fillna(
        float("-inf"), ["threshold"])


def _best(found: DataFrame, count: int) -> DataFrame:
    """The best `count` rows a query, with their place; parts are cut to as many before the shuffle."""
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= count)


def exact_top_k(items: DataFrame, queries: DataFrame, k: int, skip_own: bool = True) -> DataFrame:
    """The k items of highest inner product for each query, ties to the smaller id.

    Both tables have (id long, terms array<long>), as from `quantised`; further columns are ignored. Result: (query_id, rank
    from 1, vec_id, score). With `skip_own` a query doesn't find its own row: one row of its id and vector. Every
    row counts: repeated rows are several items, and repeated queries several queries. Vectors of different
    lengths are compared as if the shorter one went on with zeros; an empty vector scores 0 with all. Null ids, vectors or
    components are left out. Fewer than k items give as many rows; an empty table gives none. Components so large
    that a score might not be exact in 53 bits raise `ScoreOverflow`.
    """
    spark, count = items.sparkSession, k + bool(skip_own)
    filled = F.col("id").isNotNull() & F.col("terms").isNotNull() & F.forall("terms", lambda x: x.isNotNull())
    items, queries = (df.where(filled).select(F.col("id").cast("long"), F.col("terms").cast("array<bigint>")) for df in (items, queries))
    rows = items.count()
    shards = max(-(-rows // SHARD_ROWS), min(shuffle_partitions(spark), -(-rows // LEAST_ROWS)), 1)
    copies = Window.partitionBy("terms").orderBy("id")
    index = stored(
        items.withColumn("_copy", F.row_number().over(copies)).where(F.col("_copy") <= count)
        .groupBy("terms").agg(F.sort_array(F.collect_list("id")).alias("ids"))
        .withColumn("shard", F.pmod(F.xxhash64("terms"), F.lit(shards)).cast("int"))
        .groupBy("shard").applyInArrow(_pack_shard, INDEX), "topk-index",
    )
    # Stored, because the numbers must not change when a task is run again.
    asked = stored(queries.withColumn("query", F.monotonically_increasing_id()), "topk-queries")
    blocks = max(-(-asked.count() // BLOCK_QUERIES), 1)
    block = F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("int")

    def searched(thresholds: DataFrame, pilot: bool) -> DataFrame:
        packs = thresholds.select(block.alias("block"), "query", "terms", "threshold").groupBy("block").applyInArrow(_pack_block, BLOCK)
        packs = packs.select("block", *[F.col(c).alias(f"q_{c}") for c in ("terms", "kind", "weights")], "queries", "thresholds")
        home = F.pmod("block", F.lit(shards))
        if pilot:
            dealt = packs.withColumn("shard", home)
        else:
            dealt = packs.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).where(F.col("shard") != home)
        return _by_shuffle(dealt, index, "shard").mapInArrow(_search(count), FOUND)

    found = stored(searched(asked.withColumn("threshold", F.lit(float("-inf"))), True), "topk-pilot")
    tables = [index, asked, found]
    if shards > 1:
        others = stored(searched(_with_thresholds(asked, found, count), False), "topk-others")
        tables.append(others)
        found = found.unionByName(others)
    best = _best(_by_shuffle(found, asked.select("query", F.col("id").alias("query_id")), "query"), count)
    if skip_own:
        own = F.min(F.when((F.col("vec_id") == F.col("query_id")) & (F.col("score") == F.col("own")), F.col("place")))
        best = best.withColumn("_own", F.coalesce(own.over(Window.partitionBy("query")), F.lit(count))).where(
            F.col("place") != F.col("_own")
        ).withColumn("place", F.col("place") - (F.col("place") > F.col("_own")).cast("int"))
    result = stored(best.select("query_id", F.col("place").cast("int").alias("rank"), "vec_id", "score"), "topk")
    dropped(*tables)
    return result
