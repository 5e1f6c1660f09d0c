"""Csv in splits, columns by header name, and tables that survive a failed replacement."""

import random

import pytest
from pyspark.sql import functions as F

from caudal.sources import csv_records, folders, tables


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


@pytest.fixture
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def written(folder, name, records, end="\n", header="a,b,c"):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(end.join([header, *records]) + end, newline="")


def invented(rng, n):
    """Values with line breaks, doubled quotes, delimiters, blanks; quotes inside plain values; one value over many lines."""
    def value():
        kind = rng.randrange(7)
        if kind == 0:
            return '"' + rng.choice(["x\ny", 'say ""hi""\n', "\n\n", ",\n,", 'a""', "", '""', "é\nñ"]) * rng.randint(1, 9) + '"'
        if kind == 1:
            return rng.choice(['5" pipe', 'it"s', ' "z"', "plain text", ""])
        return f"v{rng.randrange(1000)}"

    return [",".join([f"k{i}", value(), value()]) for i in range(n)]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_over_lines_are_read_in_splits(spark, tmp_path, small_splits, end):
    for seed in range(3):
        rng, folder = random.Random(seed), tmp_path / f"in{seed}"
        written(folder, "one.csv", invented(rng, 400), end)
        written(folder, "two.csv", [*invented(rng, 5), 'k,"' + "long\n" * 900 + '",z', *invented(rng, 50)], end)
        path = str(folder)
        want = spark.read.options(**tables.CSV_OPTIONS, multiLine=True).csv(path)
        got = tables.read_raw(spark, path, multi_line=True)
        assert got.columns == want.columns and rows_of(got) == rows_of(want)
    lines = csv_records._lines(spark, path, ",", '"')
    assert lines.rdd.getNumPartitions() > 10 and csv_records._starts(lines).count() > 5


def test_records_of_a_large_file_do_not_meet_in_one_task(spark, tmp_path):
    written(tmp_path / "in", "one.csv", ["1,2,3", '4,"5\n5",6'])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    got = tables.read_raw(spark, str(tmp_path / "in"), multi_line=True)
    plan = got._jdf.queryExecution().sparkPlan().toString()
    found = rows_of(got)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" not in plan and found == [("1", "2", "3"), ("4", "5\n5", "6")]


def test_unreadable_records_and_their_files(spark, tmp_path):
    written(tmp_path / "in", "one.csv", ["1,2,3", "4,5", '6,"7\n7",8', "", "9,9,9,9"])
    got = tables.read_raw(spark, str(tmp_path / "in"), corrupt_column=True, multi_line=True, file_column="f")
    assert sorted(r[tables.CORRUPT] or "" for r in got.collect()) == ["", "", "4,5", "9,9,9,9"]
    assert got.where("f like '%/in/one.csv'").count() == 4
    plain = tables.read_raw(spark, str(tmp_path / "in"), corrupt_column=True, file_column="f")
    found = plain.collect()
    assert len(found) == 5 and sum(r[tables.CORRUPT] is None for r in found) == 1 and {r["f"][-11:] for r in found} == {"/in/one.csv"}


@pytest.mark.parametrize("multi_line", [False, True])
def test_columns_go_by_the_header_of_their_file(spark, tmp_path, multi_line):
    written(tmp_path / "in", "one.csv", ["1,2,3"])
    written(tmp_path / "in", "two.csv", ["30,10,20"], header="c,a,b")
    written(tmp_path / "in", "three.csv", ["100,7"], header="a,d")
    (tmp_path / "in" / "empty.csv").write_text("")
    got = tables.read_raw(spark, str(tmp_path / "in"), multi_line=multi_line)
    assert rows_of(got.select("a", "b", "c", "d")) == sorted(
        [("1", "2", "3", None), ("10", "20", "30", None), ("100", None, None, "7")], key=repr)


def test_header_names(spark, tmp_path):
    (tmp_path / "x.csv").write_text('﻿a,,b,B,"q ""x""\ny"\n1,2,3,4,5\n')
    want = spark.read.options(**tables.CSV_OPTIONS, multiLine=True).csv(str(tmp_path / "x.csv")).columns
    assert tables.read_raw(spark, str(tmp_path / "x.csv"), multi_line=True).columns == want


def test_a_failed_replacement_keeps_the_old_table(spark, tmp_path):
    path = str(tmp_path / "zone" / "t.parquet")
    tables.write_table(spark.range(5), path)
    bad = spark.range(100).repartition(8).select(F.when(F.col("id") == 77, F.raise_error(F.lit("stop"))).otherwise(F.col("id").cast("string")).alias("id"))
    with pytest.raises(Exception, match="stop"):
        tables.write_table(bad, path)
    assert spark.read.parquet(path).count() == 5 and folders.children(spark, str(tmp_path / "zone")) == ["t.parquet"]
    tables.write_table(spark.read.parquet(path).selectExpr("id + 1 as id"), path)  # reads what it replaces
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [1, 2, 3, 4, 5]
    tables.write_table(spark.range(6).withColumn("k", F.col("id") % 2), path, ["k"])
    assert folders.children(spark, path)[:1] == ["_SUCCESS"] and spark.read.parquet(path).count() == 6


@pytest.mark.parametrize("complete", [True, False])
def test_a_switch_that_was_cut_off_is_ended(spark, tmp_path, complete):
    path, zone = str(tmp_path / "z" / "t"), tmp_path / "z"
    tables.write_table(spark.range(5), path)
    spark.range(9).write.parquet(str(zone / "_t-new-1"))
    if not complete:
        (zone / "_t-new-1" / "_SUCCESS").unlink()
    folders.rename(spark, path, str(zone / "_t-old-1"))  # here the writer died
    folders.recover(spark, path)
    assert spark.read.parquet(path).count() == (9 if complete else 5)
    tables.write_table(spark.range(2), path)
    assert folders.children(spark, str(zone)) == ["t"]
