"""Exact top-k search against brute force."""

import numpy as np
import pytest

from caudal.llm import maxscore
from caudal.llm.maxscore import exact_top_k, quantised


def brute(items, queries, k, skip_own=True):
    out = []
    for name, q in queries:
        scored = []
        for i, v in items:
            n = min(len(q), len(v))
            scored.append((-sum(a * b for a, b in zip(q[:n], v[:n])), i, tuple(v)))
        scored.sort()
        if skip_own:
            own = next((x for x in scored if x[1] == name and x[2] == tuple(q)), None)
            if own:
                scored.remove(own)
        out += [(name, r, i, -s) for r, (s, i, _) in enumerate(scored[:k], 1)]
    return sorted(out)


def search(spark, items, queries, k, **options):
    schema = "id long, terms array<long>, score string, shard string"
    tables = [spark.createDataFrame([(i, v, "x", "y") for i, v in rows], schema) for rows in (items, queries)]
    return sorted(tuple(r) for r in exact_top_k(*tables, k, **options).collect())


@pytest.fixture
def small(monkeypatch):
    """Many shards and chunks for few rows. Workers get the operator's functions with the module, so sizes that only the
    driver uses can be set here."""
    monkeypatch.setattr(maxscore, "LEAST_ROWS", 40)
    monkeypatch.setattr(maxscore, "BLOCK_QUERIES", 7)


def test_clustered_dense_vectors(spark, small):
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 12, (6, 24))
    rows = [(i, [int(x) for x in np.floor(centres[i % 6] + rng.normal(0, 5, 24))]) for i in range(300)]
    queries = rows[::20]
    assert search(spark, rows, queries, 20) == brute(rows, queries, 20)
    assert search(spark, rows, queries, 3, skip_own=False) == brute(rows, queries, 3, skip_own=False)


def test_sparse_vectors_and_ties(spark, small):
    rng = np.random.default_rng(2)
    rows = [(i, [int(x) if keep else 0 for x, keep in zip(rng.integers(-2, 4, 30), rng.random(30) < 0.1)]) for i in range(400)]
    queries = rows[::20]
    assert search(spark, rows, queries, 20) == brute(rows, queries, 20)


def test_a_third_of_all_rows_equal_and_repeated_rows(spark, small):
    rng = np.random.default_rng(3)
    rows = [(i, [5, -3, 2, 0] if i % 3 == 0 else [int(x) for x in rng.integers(-5, 6, 4)]) for i in range(240)]
    rows += rows[:25]
    queries = [r for r in rows if r[0] % 20 == 0]
    assert search(spark, rows, queries, 20) == brute(rows, queries, 20)


def test_odd_rows(spark, small):
    rows = [(1, []), (2, [3]), (3, [1, 2, 3]), (3, [1, 2, 3]), (3, [2, 2, 2]), (4, [-(2**20), 7]), (5, [0, 0])]
    assert search(spark, [*rows, (None, [9]), (7, None), (8, [1, None])], rows, 20) == brute(rows, rows, 20)
    assert search(spark, [], rows, 20) == [] and search(spark, rows, [], 20) == []
    with pytest.raises(Exception, match="not exact"):
        search(spark, [(1, [2**40]), (2, [2**40])], [(1, [2**40])], 2)


def test_quantised(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, [0.5, -0.01]), (2, [inf]), (3, [nan]), (4, None), (None, [1.0]), (5, [None]), (6, []), (7, [0.1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = {r["id"]: r["terms"] for r in quantised(df, 64).collect()}
    assert found == {1: [32, -1], 6: [], 7: [int(np.floor(64 * float(np.float32(0.1))))]}


def test_chunks_prune_exactly():
    """Whatever the threshold, exactly the vectors that reach it are found, with their scores."""
    rng = np.random.default_rng(4)
    for density in (1.0, 0.1):
        matrix = (rng.integers(-20, 21, (16, 500)) * (rng.random((16, 500)) < density)).astype(np.int64)
        chunk = maxscore.Chunk(matrix, np.float32, 0)
        for query in rng.integers(-20, 21, (10, 16)):
            exact = query @ matrix
            for threshold in (-np.inf, -100, 0, 300, 800, float(exact.max()), float(exact.max()) + 1):
                at, scores = chunk.scores(query.astype(np.float32), threshold)
                assert sorted(zip(at.tolist(), scores.tolist())) == [(i, s) for i, s in enumerate(exact.tolist()) if s >= threshold]


def test_no_table_is_sent_through_the_driver(spark, monkeypatch):
    """Not even tables as small as these: index, queries and thresholds grow with the input."""
    plans, write = {}, maxscore.stored

    def recorded(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, name)

    monkeypatch.setattr(maxscore, "stored", recorded)
    monkeypatch.setattr(maxscore, "LEAST_ROWS", 8)
    items = spark.range(40).selectExpr("id", "array(id % 7 - 3, id % 5, 1L) as terms")
    assert maxscore.exact_top_k(items, items.where("id % 5 = 0"), 3).count() == 24
    assert {"topk-pilot", "topk-others", "topk"} <= set(plans)
    for name, plan in plans.items():
        assert "Broadcast" not in plan, name
