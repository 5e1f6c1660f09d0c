"""Readers and writers of the zones."""

from __future__ import annotations

import logging
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, types as T, functions as F

from caudal import schemas
from caudal.functions.coerce import null_tokens
from caudal.session import scratch_dir
from caudal.sources import csv_records, folders

log = logging.getLogger(__name__)

CORRUPT = "_corrupt_record"
CSV_OPTIONS = {"header": True, "quote": '"', "escape": '"', "mode": "PERMISSIVE"}


def _headers(spark: SparkSession, files: list[str]) -> dict[str, list[str]]:
    """Files by their first line; empty files have none. First lines are read from the driver, several at a time."""
    with ThreadPool(min(len(files), 32)) as pool:
        found = pool.map(lambda file: folders.first_line(spark, file), files)
    groups: dict[str, list[str]] = {}
    for file, line in zip(files, found, strict=True):
        if line is not None:
            groups.setdefault(line, []).append(file)
    if len(groups) > csv_records.MOST_HEADERS:
        raise csv_records.TooManyHeaders(f"{len(groups)} different headers")
    return groups


def _together(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _spanning(spark: SparkSession, path: str, corrupt_column: bool, file_column: str | None) -> DataFrame:
    """Records with line breaks inside quotes, parsed in splits."""
    kept = scratch_dir(spark, "records")
    csv_records.records(spark, path).where(F.trim("text") != "").write.parquet(kept)
    texts = spark.read.parquet(kept)
    first = texts.groupBy("file").agg(F.min(F.struct("block", "line", "text")).alias("h")).select("file", "h.*")
    headers = [r["text"] for r in first.select("text").distinct().limit(csv_records.MOST_HEADERS + 1).collect()]
    if len(headers) > csv_records.MOST_HEADERS:
        raise csv_records.TooManyHeaders(f"more than {csv_records.MOST_HEADERS} different headers")
    headed = first.select(F.col("file").alias("_file"), F.struct("block", "line").alias("_at"), F.col("text").alias("_header"))
    heads = scratch_dir(spark, "heads")
    headed.write.parquet(heads)
    headed = spark.read.schema(headed.schema).parquet(heads)
    if headed.count() <= csv_records.MOST_SENT:  # else all records of a file would meet in one task
        headed = F.broadcast(headed)
    rows = texts.join(headed, F.col("file") == F.col("_file")).where(F.struct("block", "line") != F.col("_at"))
    parts = []
    for header in sorted(headers):
        names = csv_records.header_names(header)
        fields = [T.StructField(n, T.StringType()) for n in [*names, CORRUPT]]
        options = {k: str(v) for k, v in CSV_OPTIONS.items() if k != "header"} | {"columnNameOfCorruptRecord": CORRUPT, "multiLine": "true"}
        record = F.from_csv(F.regexp_replace("text", r"\r\z", ""), T.StructType(fields).toDDL(), options)
        part = rows.where(F.col("_header") == header).select(record.alias("r"), "file").select(
            *[F.col("r").getField(n).alias(n) for n in names], F.col("r").getField(CORRUPT).alias(CORRUPT), "file")
        keep = [*names, *([CORRUPT] if corrupt_column else [])]
        parts.append(part.select(*keep, *([F.col("file").alias(file_column)] if file_column else [])))
    if not parts:
        raise AnalysisException(f"no csv records below {path}")
    return _together(parts)


def read_raw(
    spark: SparkSession, path: str, corrupt_column: bool = False, multi_line: bool = False, file_column: str | None = None
) -> DataFrame:
    """Csv with header, every column as text under the name the header of its file gives it.

    Files of a folder may have their columns in any order; a column a file lacks is null in its rows. ``multi_line`` allows line
    breaks inside quotes; such files are read in splits like others. ``file_column`` adds the path of a row's file.
    """
    files = sorted(spark.read.text(path).inputFiles())
    if multi_line:
        return _spanning(spark, path, corrupt_column, file_column)
    groups = _headers(spark, files) if len(files) > 1 else {"": [path]}
    parts = []
    for members in groups.values():
        at = path if len(groups) == 1 else members
        names = spark.read.options(**CSV_OPTIONS).csv(members[0]).columns
        fields, options = [T.StructField(n, T.StringType()) for n in names], dict(CSV_OPTIONS)
        if corrupt_column:
            fields.append(T.StructField(CORRUPT, T.StringType()))
            # The parser only sees that a record is too long or short if it reads all columns.
            options |= {"columnNameOfCorruptRecord": CORRUPT, "columnPruning": False}
        part = spark.read.schema(T.StructType(fields)).options(**options).csv(at)
        parts.append(part.withColumn(file_column, F.col("_metadata.file_path")) if file_column else part)
    return _together(parts)


def read_bronze(spark: SparkSession, path: str, **options) -> DataFrame:
    """Raw table with missing-value words as null; an unreadable record keeps its text."""
    return null_tokens(read_raw(spark, path, **options), skip=(CORRUPT,))


def write_bronze(df: DataFrame, path: str) -> None:
    """Raw csv, texts exactly as they are."""
    df.write.mode("overwrite").options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Replaces a Parquet table; until the new one is complete, the old one stays. Partitioned output is rebalanced
    first: small partitions get few files, large ones are split over several tasks."""
    def write(folder):
        if partition_by:
            df.hint("rebalance", *partition_by).write.partitionBy(*partition_by).parquet(folder)
        else:
            df.write.parquet(folder)

    folders.replace(df.sparkSession, path, write)


def load_gold(spark: SparkSession, path: str, entity: str, nanos: bool = False) -> DataFrame:
    """Gold table with its contract types; a missing one is empty, an unreadable one is an error.

    ``nanos`` reads tables whose timestamps were written in nanoseconds by other tools. It sets a
    session option that must stay on until the table has been read.
    """
    schema = schemas.gold_schema(entity)
    if nanos:
        spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    folders.recover(spark, path)
    try:
        found = spark.read.parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        log.warning("gold table %s is taken as empty: %s", path, str(problem).splitlines()[0])
        return spark.createDataFrame([], schema)
    have = {f.name: f.dataType for f in found.schema}
    columns = []
    for f in schema:
        if f.name not in have:
            column = F.lit(None)
        elif isinstance(f.dataType, T.TimestampType) and isinstance(have[f.name], T.LongType):
            column = F.timestamp_micros(F.expr(f"{f.name} div 1000"))
        else:
            column = F.col(f.name)
        columns.append(column.cast(f.dataType).alias(f.name))
    return found.select(*columns)


def gold_location(root: str, entity: str) -> str:
    return f"{root.rstrip('/')}/{entity}/{entity}_enriched.parquet"


def load_all_gold(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """All five tables by name. Nothing is read until a table is used."""
    return {e: load_gold(spark, gold_location(root, e), e) for e in schemas.ENTITIES}
