"""Csv records that span lines, read in splits.

A line break inside quotes doesn't end a record, and whether a place is inside quotes depends on everything before it.
But a line can only do one of four things to that: leave it, turn it round, or end inside or outside whatever was before. So
each split says what it does to a start outside and to one inside; running through the splits of a file gives the true
start of each; then every task puts the lines of its split together, and only records that go on over the end of a split
are shuffled. Records are parsed by Spark's own csv parser.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from caudal.session import scratch_dir

#: Distinct headers in one folder.
MOST_HEADERS = 1_000
#: Splits that begin inside quotes, some hundred bytes each, up to which they are sent to all tasks.
MOST_SENT = 100_000
PIECES = "file string, block long, line long, owner long, whole boolean, text string"
_BATCH_BYTES = 8 << 20


class TooManyHeaders(ValueError):
    """The files of a folder have more different headers than can be told apart in one plan."""


def line_effects(value: Column, delimiter: str = ",", quote: str = '"') -> tuple[Column, Column]:
    """Whether a line ends inside quotes, if it began outside, and if it began inside. A quote opens a value only where
    the value begins, a doubled quote is a character, and what follows a closing quote belongs to the value."""
    d, q = re.escape(delimiter), re.escape(quote)
    inside = f"[^{q}]*+(?:{q}{q}[^{q}]*+)*+{q}"
    tail = f"[^{d}]*+"
    value_pattern = f"(?:{q}{inside}{tail}|(?!{q}){tail})"
    closed = f"{value_pattern}(?:{d}{value_pattern})*+"
    without = F.instr(value, quote) == 0
    return (
        ~(without | value.rlike(f"\\A{closed}\\z")),
        without | ~value.rlike(f"\\A{inside}{tail}(?:{d}{value_pattern})*+\\z"),
    )


def _lines(spark: SparkSession, path: str | list[str], delimiter: str, quote: str) -> DataFrame:
    """Lines with file, start of the split and a number that grows within the split. Only line feeds end a line here."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"), "value")
    from_outside, from_inside = line_effects(F.col("value"), delimiter, quote)
    return lines.withColumns({"from_outside": from_outside, "from_inside": from_inside})


def _starts(lines: DataFrame) -> DataFrame:
    """(file, block, owner) for each split that begins inside quotes: `owner` is the split in which the open record began.

    Lines that leave things as they are, nearly all, are not looked at. A file's splits are one row."""
    row = F.struct("line", F.col("from_outside").alias("o"), F.col("from_inside").alias("i"))
    changing = lines.where(F.col("from_outside") | ~F.col("from_inside"))
    start = F.struct(F.lit(False).alias("o"), F.lit(True).alias("i"), F.lit(False).alias("left"))

    def after(now: Column, line: Column) -> Column:
        # o, i: the state now for a split that began outside, inside; left: the latter has been outside once
        o = F.when(now["o"], line["i"]).otherwise(line["o"])
        i = F.when(now["i"], line["i"]).otherwise(line["o"])
        return F.struct(o.alias("o"), i.alias("i"), (now["left"] | ~i).alias("left"))

    effects = changing.groupBy("file", "block").agg(F.sort_array(F.collect_list(row)).alias("lines")).select(
        "file", "block", F.aggregate("lines", start, after).alias("e"))
    # Splits without such lines leave a start inside as it is, and must be told of it.
    every = lines.select("file", "block").distinct().join(effects, ["file", "block"], "left").select(
        "file", "block", F.coalesce("e", start).alias("e"))
    kind = "struct<inside:boolean,owner:bigint,out:array<struct<block:bigint,owner:bigint>>>"
    nothing = F.from_json(F.lit('{"inside":false,"owner":0,"out":[]}'), kind)

    def through(now: Column, split: Column) -> Column:
        b, e = split["block"], split["e"]
        out = F.when(now["inside"], F.concat(now["out"], F.array(F.struct(b.alias("block"), now["owner"].alias("owner"))))).otherwise(now["out"])
        return F.struct(
            F.when(now["inside"], e["i"]).otherwise(e["o"]).alias("inside"),
            F.when(now["inside"] & ~e["left"], now["owner"]).otherwise(b).alias("owner"), out.alias("out"),
        ).cast(kind)

    splits = every.groupBy("file").agg(F.sort_array(F.collect_list(F.struct("block", "e"))).alias("splits"))
    return splits.select(F.col("file").alias("_file"), F.explode(F.aggregate("splits", nothing, through)["out"]).alias("s")).select(
        "_file", F.col("s.block").alias("_block"), "s.owner")


def _put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of whole splits to records. A record that isn't all in this split is a piece with the split it began in."""
    out, size = [], 0

    def packed():
        nonlocal out, size
        columns = list(zip(*out, strict=True)) or [()] * 6
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.string()]
        out, size = [], 0
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["file", "block", "line", "owner", "whole", "text"])

    def end(whole):
        nonlocal held, size
        if held:
            text = "\n".join(held)
            out.append((split[0], split[1], first, owner, whole, text))
            size += len(text)
        held = []

    split, held, inside, first, owner, piece = None, [], False, 0, 0, False
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("file", "block", "line", "value", "from_outside", "from_inside", "owner")]
        for file, block, line, value, from_outside, from_inside, open_owner in zip(*columns, strict=True):
            if (file, block) != split:
                end(False)  # a record still open goes on in the next split
                split, inside = (file, block), open_owner is not None
                piece, owner = inside, open_owner if inside else block
            if not held:
                first = line
            held.append(value)
            inside = from_inside if inside else from_outside
            if not inside:
                end(not piece)
                piece, owner = False, block
            if size >= _BATCH_BYTES:
                yield packed()
    end(False)
    yield packed()


def records(spark: SparkSession, path: str | list[str], delimiter: str = ",", quote: str = '"') -> DataFrame:
    """(file, block, line, text): the records of csv files, in order of block and line within a file; headers are
    records like others. An unclosed quote makes the rest of its file one record, as it does for any parser."""
    lines = _lines(spark, path, delimiter, quote)
    kept = scratch_dir(spark, "starts")
    _starts(lines).write.parquet(kept)
    starts = spark.read.schema("_file string, _block bigint, owner bigint").parquet(kept)
    same = (F.col("file") == F.col("_file")) & (F.col("block") == F.col("_block"))
    if starts.count() <= MOST_SENT:
        placed = lines.join(F.broadcast(starts), same, "left")
    else:  # a shuffle mixes the lines of a split, so they are sorted again
        placed = lines.join(starts, same, "left").repartition("file", "block").sortWithinPartitions("file", "block", "line")
    pieces = placed.drop("_file", "_block").mapInArrow(_put_together, PIECES)
    whole = pieces.where("whole").select("file", "block", "line", "text")
    part = F.sort_array(F.collect_list(F.struct("block", "line", "text")))
    split_up = pieces.where("not whole").groupBy("file", "owner").agg(part.alias("p")).select(
        "file", F.col("owner").alias("block"), F.col("p")[0]["line"].alias("line"), F.array_join(F.col("p.text"), "\n").alias("text"))
    return whole.unionByName(split_up)


def header_names(text: str, delimiter: str = ",", quote: str = '"') -> list[str]:
    """Column names of a header record as Spark has them: nameless columns and repeated names get their place."""
    names = next(csv.reader([text.removeprefix("﻿").rstrip("\r\n")], delimiter=delimiter, quotechar=quote), [])
    low = [n.lower() for n in names]
    return [f"_c{i}" if not n else f"{n}{i}" if low.count(n.lower()) > 1 else n for i, n in enumerate(names)]
