"""Shards of near-equal size by sampled splitters.

The key of a record is the checksum of its text with a hash of its doc_id, so equal texts are neighbours and a group of
copies can still be cut anywhere. A sample of keys, drawn with a chance in proportion to the record's size, gives
the quantiles at which the key space is cut into ranges of near-equal size. Ranges that come out overfull are
sampled again and subdivided. Sizes of all ranges are then summed exactly, and each record's place in the
corpus is the range's offset plus the running size within its range; the place decides the shard. Ranges only divide the
work: boundaries of shards fall within one record of the exact quantiles whatever the sample was.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caudal.llm.common import importable, shuffle_partitions, stored

SHARDS = 40
#: Bytes every record counts besides its text.
OVERHEAD = 16
#: Bytes of text that one range should hold, sampled keys a range, and how many ranges there can be.
RANGE_BYTES, SAMPLES, MOST_RANGES = 256 << 20, 16, 20_000
#: A range with more than so many times the mean size is subdivided.
OVERFULL = 2


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    crc = F.crc32(text.cast("binary"))
    spread = F.xxhash64("doc_id").bitwiseAND(F.lit((1 << 31) - 1))
    return docs.select(
        F.col("doc_id").cast("long"), (F.octet_length(text).cast("long") + OVERHEAD).alias("size"), crc.alias("text_crc32"),
        F.shiftleft(crc, 31).bitwiseOR(spread).alias("key"),
    )


def _sampled(rows: DataFrame, rate: float, seed: int) -> list[int]:
    """Keys drawn with a chance of size x rate, at most 1: about rate x all bytes of them, twice that at most in
    expectation."""
    chance = F.pmod(F.xxhash64("key", "doc_id", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    return [r[0] for r in rows.filter(chance < F.col("size") * rate).select("key").collect()]


def _quantiles(keys: list[int], pieces: int) -> list[int]:
    keys = sorted(keys)
    return sorted({keys[len(keys) * i // pieces] for i in range(1, pieces)}) if keys else []


def _ranged(rows: DataFrame, splitters: list[int]) -> DataFrame:
    """Adds the number of the range: how many splitters are at or below the key."""
    cuts = np.array(splitters, np.int64)

    def run(batches):
        for batch in batches:
            found = np.searchsorted(cuts, batch.column(3).to_numpy(), "right").astype(np.int32)
            yield pa.record_batch([*batch.columns, pa.array(found)], [*batch.schema.names, "range"])

    return rows.mapInArrow(run, "doc_id long, size long, text_crc32 long, key long, range int")


def splitters(rows: DataFrame, total: int, ranges: int) -> list[int]:
    """Keys that cut the rows into about so many ranges of near-equal size; overfull ones are subdivided
    until none is left that more keys could divide."""
    cuts = _quantiles(_sampled(rows, SAMPLES * ranges / max(total, 1), 0), ranges)
    for seed in range(1, 5):
        sizes = (
            _ranged(rows, cuts).groupBy("range")
            .agg(F.sum("size").alias("size"), F.min("key").alias("low"), F.max("key").alias("high"))
            .filter((F.col("size") > OVERFULL * total / ranges) & (F.col("low") < F.col("high"))).collect()
        )
        more: set[int] = set()
        for r in sizes:
            inside = rows.filter(F.col("key").between(r["low"], r["high"]))
            pieces = -(-r["size"] * ranges // max(total, 1))
            more.update(_quantiles(_sampled(inside, SAMPLES * pieces / r["size"], seed), pieces))
        if not more - set(cuts):
            break
        cuts = sorted({*cuts, *more})
    return cuts


def sharded(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row for each row of docs (doc_id, text; other columns are not read): doc_id, size (bytes of the text plus 16),
    text_crc32, shard, slot (gapless from 0 within the shard, in key order).

    Sizes of shards differ from the mean by less than the largest record. Null texts count as empty. Equal texts are
    neighbours, so they share a shard unless a boundary falls among them. Rows without doc_id and rows that repeat
    each get a slot of their own. More shards than rows leave some empty; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    importable(spark)
    rows = stored(_keyed(docs), "keys")
    total, largest = rows.agg(F.sum("size"), F.max("size")).first()
    total = total or 0
    ranges = min(max(-(-total // RANGE_BYTES), 4 * shuffle_partitions(spark), shards), MOST_RANGES)
    placed = stored(_ranged(rows, splitters(rows, total, ranges)), "ranges")
    # One row a range: their number is bounded, so running sums over them are a small job.
    sums = placed.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        "range", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("first_byte"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first_row"),
    )
    within = Window.partitionBy("range").orderBy("key", "doc_id", "size")
    exact = placed.join(F.broadcast(starts), "range").select(
        "doc_id", "size", "text_crc32",
        (F.col("first_row") + F.row_number().over(within) - 1).alias("row"),
        # The middle of the record decides, so a boundary goes to the nearer side.
        (F.col("first_byte") + F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.floor(F.col("size") / 2) - 1).alias("byte"),
    ).withColumn(
        "shard", F.least(F.floor(F.col("byte").cast("decimal(38,0)") * shards / F.lit(max(total, 1)).cast("decimal(38,0)")), F.lit(shards - 1)).cast("int")
    )
    exact = stored(exact, "places")
    first = exact.groupBy("shard").agg(F.min("row").alias("first"))
    return exact.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("row") - F.col("first")).alias("slot")
    )
