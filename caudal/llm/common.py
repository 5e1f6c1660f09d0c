"""Helpers shared by the operators of this subpackage: scratch tables, joins with heavy keys, hashed sequences."""

from __future__ import annotations

import gc
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caudal.session import scratch_dir

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: A key with more than one row in so many is heavy; there can't be more heavy keys than this.
HEAVY_SHARE = 400


# ---------------------------------------------------------------- tables


#: Bytes of an Arrow batch: texts can be long, and both sides hold several batches a task.
BATCH_BYTES = 4 << 20


#: Workers live long and run one stage after another: large arrays go back to the system as soon as they are free.
WORKER_MEMORY = {"ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_ARENA_MAX": "1", "MALLOC_MMAP_THRESHOLD_": str(1 << 20), "MALLOC_TRIM_THRESHOLD_": str(1 << 20)}


def importable(spark: SparkSession) -> None:
    """Python workers find this package where the driver found it, if it isn't installed there, and get small batches."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    environment, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    environment.update(WORKER_MEMORY)
    path = environment.get("PYTHONPATH", "")
    if root not in path.split(":"):
        environment["PYTHONPATH"] = f"{root}:{path}".rstrip(":")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def shuffles_freed(spark: SparkSession):
    """Inside, Spark deletes the shuffle files of a query as soon as it has ended."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared scratch folder and read back: cuts the lineage, so that a lost
    executor costs a re-read of files and not the work again."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    with shuffles_freed(spark):
        df.write.parquet(path)
    gc.collect()
    return spark.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Deletes the files of stored tables that nothing reads any more."""
    for df in tables:
        context = df.sparkSession.sparkContext
        for folder in {name.rpartition("/")[0] for name in df.inputFiles()}:
            path = context._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def free_name(df: DataFrame, wanted: str) -> str:
    """The wanted name, longer if a column of df has it, in any case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(docs: DataFrame) -> int:
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def groups_for(spark: SparkSession, amount: int, each: int, least: int = 1) -> int:
    """How many hash groups to deal `amount` out to, so that one holds about `each`; `least` a partition
    at least."""
    return max(-(-amount // each), least * shuffle_partitions(spark), 1)


# ---------------------------------------------------------------- heavy keys


def join_by_key(rows: DataFrame, facts: DataFrame, key: str, count: str) -> DataFrame:
    """Left join of rows to one row of facts a key, where a key may hold a large share of the rows.

    `count` is a column of facts: rows of the key. Keys with more than 1/HEAVY_SHARE of all rows,
    HEAVY_SHARE at most by arithmetic, are broadcast; the others are shuffled, and none of them can
    fill a partition. Without heavy keys it is one plain join. Null keys match null keys. Columns of facts follow those of rows.
    """
    total, most = facts.agg(F.sum(count), F.max(count)).first()
    limit = max((total or 0) // HEAVY_SHARE, 100)
    names = [c for c in facts.columns if c != key]
    if (most or 0) <= limit:
        light = facts.select(F.col(key).alias("_key"), *names)
        return rows.join(light, F.col(key).eqNullSafe(F.col("_key")), "left").select(*rows.columns, *names)
    heavy = facts.filter(F.col(count) > limit).withColumn("_heavy", F.lit(True))
    first = rows.join(
        F.broadcast(heavy.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_h_{c}") for c in names], "_heavy")),
        F.col(key).eqNullSafe(F.col("_key")), "left",
    ).drop("_key")
    light = facts.filter(F.col(count) <= limit).select(F.col(key).alias("_key"), *names)
    done = first.filter(F.col("_heavy")).select(*rows.columns, *[F.col(f"_h_{c}").alias(c) for c in names])
    rest = first.filter(F.col("_heavy").isNull()).select(*rows.columns)
    return done.unionByName(
        rest.join(light, F.col(key).eqNullSafe(F.col("_key")), "left").select(*rows.columns, *names)
    )


# ---------------------------------------------------------------- hashed sequences

BASE = np.uint64(0x9E3779B97F4A7C15)
_powers = np.ones(1, np.uint64)
_inverse = np.ones(1, np.uint64)
#: One random 64-bit value a byte.
BYTE_VALUES = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the odd base and of its inverse, modulo 2^64."""
    global _powers, _inverse
    if len(_powers) <= n:
        size = 1 << (n + 1).bit_length()
        for name, base in (("_powers", int(BASE)), ("_inverse", pow(int(BASE), -1, 2**64))):
            values = np.full(size, base, np.uint64)
            values[0] = 1
            globals()[name] = np.multiply.accumulate(values)
    return _powers, _inverse


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def prefix_hashes(symbols: np.ndarray) -> np.ndarray:
    """Polynomial hashes of all prefixes of a sequence of 64-bit values."""
    out = np.zeros(len(symbols) + 1, np.uint64)
    np.cumsum(symbols * powers(len(symbols))[0][: len(symbols)], out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the symbols in [start, end): equal for equal sequences wherever they stand."""
    return (prefix[ends] - prefix[starts]) * powers(len(prefix))[1][starts]


def gram_hashes(symbols: np.ndarray, length: int) -> np.ndarray:
    """Mixed hash of every run of `length` symbols."""
    n = len(symbols) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    prefix = prefix_hashes(symbols)
    return mixed((prefix[length:] - prefix[:n]) * powers(len(symbols))[1][:n])


#: The white space of the contracts' words: space and 9 to 13.
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
#: Separators of the plain word shingles: every ASCII character but letters and digits.
NOT_WORD = np.ones(256, bool)
NOT_WORD[128:] = False
NOT_WORD[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False
#: Byte to the same byte in lower case, A-Z only.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_spans(data: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in bytes."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~separator[data]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    prefix = prefix_hashes(BYTE_VALUES[data])
    return mixed(span_hashes(prefix, starts, ends) + (ends - starts).astype(np.uint64))


#: Words of more bytes are hashed one by one.
LANES = 64
_FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def word_digests(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, key: int) -> np.ndarray:
    """Keyed 64-bit digests of words: eight bytes at a time, each mixed in before the next; XXH3 for long words. Unlike a
    polynomial modulo 2^64, which some patterns of letters make collide whatever its base, no pair of words collides
    for more than a tiny share of the keys."""
    size = ends - starts
    out = mixed(size.astype(np.uint64) + np.uint64(key))
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    lanes = np.ndarray(len(data) + 1, "<u8", padded, 0, (1,))  # the eight bytes from each place on
    rows = np.flatnonzero(size <= LANES)
    for at in range(0, LANES, 8):
        rows = rows[size[rows] > at]
        if not len(rows):
            break
        out[rows] = mixed(out[rows] ^ (lanes[starts[rows] + at] & _FIRST_BYTES[np.minimum(size[rows] - at, 8)]))
    for i in np.flatnonzero(size > LANES).tolist():
        out[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]].tobytes(), key)
    return out


# ---------------------------------------------------------------- Arrow


def string_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column in one array, and the offsets of its values; null is empty."""
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        kind = np.int64
    else:
        kind = np.int32
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, kind, len(column) + 1, column.offset * np.dtype(kind).itemsize)
    if data is None:
        return np.zeros(0, np.uint8), offsets.astype(np.int64)
    first = int(offsets[0])
    return np.frombuffer(data, np.uint8)[first : int(offsets[-1])], offsets.astype(np.int64) - first


def packed(*columns: np.ndarray) -> bytes:
    """Columns of equal length one after another, for a binary field."""
    return np.int64(len(columns[0])).tobytes() + b"".join(np.ascontiguousarray(c).tobytes() for c in columns)


def unpacked(blobs: list[bytes], kinds: list[str]) -> list[np.ndarray]:
    """The columns of any number of packed fields, joined."""
    parts: list[list[np.ndarray]] = [[] for _ in kinds]
    for blob in blobs:
        n, at = int(np.frombuffer(blob, np.int64, 1)[0]), 8
        for part, kind in zip(parts, kinds, strict=True):
            part.append(np.frombuffer(blob, kind, n, at))
            at += n * np.dtype(kind).itemsize
    return [np.concatenate(part) if part else np.zeros(0, kind) for part, kind in zip(parts, kinds, strict=True)]


def grouped(keys: np.ndarray, columns: list[np.ndarray]):
    """(key, columns of its entries) for each key."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    if not len(keys):
        return
    cuts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])).tolist()
    columns = [c[order] for c in columns]
    for a, b in zip(cuts, [*cuts[1:], len(keys)], strict=True):
        yield int(keys[a]), [c[a:b] for c in columns]


def slices(n: int, offsets: np.ndarray, size: int):
    """Row ranges of about `size` bytes; one row at least."""
    at = 0
    while at < n:
        to = max(int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1, at + 1)
        yield at, min(to, n)
        at = to
