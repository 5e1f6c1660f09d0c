"""Revisits, shards, containment, classifier, pipeline."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

import corpus_pipeline
from caudal.llm import containment, cotraining, shards
from caudal.llm.revisits import canonical_url, resolved_revisits
from tests.llm.cases import ODD

# ---------------------------------------------------------------- revisits

CAPTURES = "capture_id long, url string, at timestamp, revisit boolean, etag string, last_modified string, headers map<string,string>"


def test_canonical_urls(spark):
    same = ["http://WWW.Site.org:80/a/?b=2&a=1&utm_source=x#f", "https://site.org/a?a=1&ref=q&b=2", "site.org/a///?a=1&b=2"]
    rows = spark.createDataFrame([(u,) for u in [*same, None, "", "http://h", "http://h?"]], "url string")
    got = [r[0] for r in rows.select(canonical_url(F.col("url"))).collect()]
    assert got == ["site.org/a?a=1&b=2"] * 3 + [None, "", "h", "h"]


def test_revisits_against_brute_force(spark):
    rnd = random.Random(1)
    rows = []
    for i in range(600):
        headers = rnd.choice([None, {"ETag": "e", "Content-Type": "t", "content-type": "t"}, {"Cache-Control": str(i), "Content-Length": "0"}])
        rows.append((i, rnd.choice(["http://a/x", "https://a/x/", "http://b", None]), rnd.choice([None] + [1000 * k for k in range(40)]),
                     rnd.choice([True, False, None]), rnd.choice([None, "1", "2", "W/1"]), rnd.choice([None, "m", "n"]), headers))
    rows += rows[:5]
    df = spark.createDataFrame([(a, u, None, r, e, m, h) for a, u, _, r, e, m, h in rows], CAPTURES)
    times = spark.createDataFrame(sorted({(r[0], r[2]) for r in rows}), "capture_id long, s long")
    df = df.join(times, "capture_id").withColumn("at", F.timestamp_seconds("s")).withColumn("response", F.lit("clash"))
    got = Counter((r.capture_id, r.response_id, r.status, tuple(sorted((r.headers or {"-": "-"}).items()))) for r in resolved_revisits(df).collect())
    site = {"http://a/x": "a/x", "https://a/x/": "a/x", "http://b": "b", None: None}
    low = lambda h: None if h is None else {k.lower(): v for k, v in h.items()}
    want = Counter()
    for a, u, t, r, e, m, h in rows:
        if not r:
            continue
        earlier = [x for x in rows if not x[3] and u is not None and t is not None and x[2] is not None and site[x[1]] == site[u] and x[2] < t]
        if not earlier:
            want[a, None, "orphan", tuple(sorted((low(h) or {"-": "-"}).items()))] += 1
            continue
        x = max(earlier, key=lambda x: (x[2], x[0]))
        strip = lambda v: None if v is None else v.removeprefix("W/")
        agree = strip(e) == strip(x[4]) if e and x[4] else (m == x[5] if m and x[5] else True)
        headers = low(h)
        if agree:
            headers = (low(x[6]) or {}) | {k: v for k, v in (low(h) or {}).items() if k in {"cache-control", "etag"}}
        want[a, x[0], "resolved" if agree else "changed", tuple(sorted((headers or {"-": "-"}).items()))] += 1
    assert got == want


def test_no_captures(spark):
    assert resolved_revisits(spark.createDataFrame([], CAPTURES)).collect() == []


# ---------------------------------------------------------------- shards


@pytest.mark.parametrize(("rows", "n"), [(None, 7), (ODD, 40), ([(1, "a")], 3), ([(5, "same")] * 300, 4)])
def test_shards(make, rows, n):
    rnd = random.Random(3)
    rows = rows or ODD + [(i, "w" * rnd.choice([1, 10, 100, 5000])) for i in range(1500)]
    got = shards.sharded(make(rows), n).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows
    )
    slots, sizes = {}, Counter()
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
        sizes[r.shard] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) <= set(range(n))
    total, largest = sum(sizes.values()), max(r.size for r in got)
    assert all(abs(sizes[k] - total / n) <= largest for k in range(n))


def test_overfull_ranges_are_subdivided(spark, monkeypatch):
    monkeypatch.setattr(shards, "SAMPLES", 1)
    rows = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit(100).cast("long").alias("size"), F.lit(0).cast("long").alias("text_crc32"), F.expr("case when id < 3900 then id else id * 1000000 end").alias("key"))
    cuts = shards.splitters(rows, 400_000, 40)
    sizes = [r[0] for r in shards._ranged(rows, cuts).groupBy("range").agg(F.sum("size")).collect()]
    assert max(sizes) <= 2 * 400_000 / 40


def test_no_documents_to_shard(make):
    assert shards.sharded(make([])).collect() == []


# ---------------------------------------------------------------- containment


def grams(text):
    words = regex.findall(r"[\p{L}\p{M}\p{N}]+", (text or "").lower())
    k = min(5, len(words))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set(), k


def held(text, k):
    words = regex.findall(r"[\p{L}\p{M}\p{N}]+", (text or "").lower())
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def benchmark_case():
    rnd = random.Random(5)
    words = [f"word{i}" for i in range(400)]
    items = [(i, " ".join(rnd.choice(words) for _ in range(rnd.choice([1, 3, 5, 9, 21, 30, 60, 200])))) for i in range(60)]
    items += [(None, "an item without a number but with enough words"), (90, None), (91, "  ?! "), items[4]]
    rows = list(ODD) + [(200, "Say: an item, without a NUMBER but with enough words!"),
                        (201, "“An item—without a number…but with ‘enough’ words”"), (202, "an ítem without a number but with enough wórds")]
    for i in range(300):
        text = [rnd.choice(words) for _ in range(rnd.choice([5, 100, 3000]))]
        if i % 3 == 0:
            part = rnd.choice(items[:60])[1].split()
            for _ in range(rnd.choice([0, 0, 1, 2])):
                part[rnd.randrange(len(part))] = "other"
            at = rnd.randrange(len(text))
            text[at:at] = part
        rows.append((1000 + i, " ".join(text)))
    return rows, items


def test_containment_against_brute_force(spark, make, monkeypatch):
    rows, items = benchmark_case()
    want = Counter()
    for j, item in items:
        shingles, k = grams(item)
        for i, text in rows if shingles else []:
            shared = len(shingles & held(text, k))
            if shared >= 0.8 * len(shingles):
                want[i, j, shared, len(shingles)] += 1
    assert len(want) > 60
    for most in (containment.ITEM_BYTES, 3000):  # one block of items, and several
        monkeypatch.setattr(containment, "ITEM_BYTES", most)
        table = spark.createDataFrame(items, "item_id long, text string")
        got = containment.contained(make(rows), table).collect()
        assert Counter(tuple(r)[:4] for r in got) == want
        left = containment.without_contained(make(rows), table)
        bad = {w[0] for w in want}
        assert Counter(r.doc_id for r in left.collect()) == Counter(i for i, _ in rows if i not in bad)
        assert left.columns == make([]).columns


def test_containment_of_nothing(spark, make):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert containment.contained(make(ODD), none).collect() == []
    assert containment.contained(make([]), some).collect() == []
    assert containment.without_contained(make(ODD), none).count() == len(ODD)


# ---------------------------------------------------------------- classifier


def quality_case(spark, make, n=1200):
    rnd = random.Random(6)
    rows, labels = list(ODD), []
    for i in range(100, 100 + n):
        good = rnd.random() < 0.7
        words = ["".join(rnd.choice("aeioulnrst") for _ in range(rnd.randint(2, 8))) for _ in range(rnd.randint(20, 250))]
        rows.append((i, " ".join(words) + "." if good else " ".join(w.upper() + "!!" for w in words)))
        if i % 2:
            labels.append((i, int(good), 0))
    truth = {i: not (t or "").isupper() for i, t in rows[len(ODD):]}
    return make(rows), rows, truth, spark.createDataFrame(labels + [(None, 1, 0), (101, None, 0), (9999, 1, 1)], "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark, make):
    docs, rows, truth, labels = quality_case(spark, make)
    got = cotraining.scored(docs, labels)
    assert got.columns == [c for c in docs.columns if c != "p_quality"] + ["p_content", "p_page", "p_quality"]
    got = got.collect()
    assert len(got) == len(rows)
    assert all(0 <= r.p_quality <= 1 for r in got)
    unseen = [(r.p_quality >= 0.5) == truth[r.doc_id] for r in got if r.doc_id in truth and r.doc_id % 2 == 0]
    assert sum(unseen) / len(unseen) > 0.98


def test_lessons_are_the_surest_of_each_stratum_and_class(spark):
    """Against a plain selection: whole bins from the surest on, until a stratum has its share; one stratum has most rows."""
    rng = np.random.default_rng(4)
    n = 4000
    stratum = np.where(rng.random(n) < 0.7, 0, rng.integers(1, 6, n))
    content, page = (rng.normal(0, 2, (n, k)).astype(np.float32) for k in (3, 2))
    content[:50] = [3, 3, 3]  # ties
    views = {"content": cotraining.View(np.array([1.0, 2.0, -1.0]), 0.1), "page": cotraining.View(np.array([2.0, 1.0]), -0.5)}
    rows = [(int(s), c.tolist(), p.tolist()) for s, c, p in zip(stratum, content, page, strict=True)]
    pool = spark.createDataFrame(rows, "stratum int, content array<float>, page array<float>").repartition(5)
    for share in (0.02, 0.2):
        got, counts = cotraining.lessons(pool, views, share, 0.6, 100)
        got = sorted((r.teacher, r.label, tuple(r.features)) for r in got.collect())
        want = []
        for teacher, (x, pupil) in enumerate(((content, page), (page, content))):
            score = views[cotraining.VIEWS[teacher]].log_odds(x)
            for s in range(6):
                for label in (0, 1):
                    sure = np.flatnonzero((stratum == s) & ((score > 0) == label) & (np.abs(score) >= np.log(19)))
                    bins = (np.abs(score[sure]) * cotraining.FINE).astype(int)
                    quota = (stratum == s).sum() * share * (0.6 if label else 1 - 0.6)
                    want += [(teacher, label, tuple(map(float, pupil[i]))) for i, b in zip(sure, bins, strict=True) if (bins > b).sum() < quota]
        assert got == sorted(want)
        assert counts == [sum(t == teacher for t, *_ in want) for teacher in (0, 1)]
        assert {s for s in range(6)} == set(stratum.tolist()) and min(counts) > 0


def test_every_unlabelled_document_is_in_the_pool(spark, make):
    docs, rows, _, labels = quality_case(spark, make, 300)
    truth = cotraining._truth(labels.select("doc_id", *[F.col(c).cast("double") for c in ("quality", "toxic")]))
    known, words = cotraining.known_rows(docs, truth, 10_000)
    has = {r.doc_id for r in truth.collect()}
    ids = [i for i, _ in rows if i is not None]
    assert known.count() == sum(i in has for i in ids)
    assert cotraining.pool_rows(docs, truth, words).count() == sum(i not in has for i in ids)
    assert 20 < cotraining.known_rows(docs, truth, 50)[0].count() < 90


def test_toxic_documents_are_not_good(spark):
    """Toxic documents differ from clean ones by a few words only, and most are labelled as of good quality."""
    rnd = random.Random(16)
    vocabulary = ["".join(rnd.choice("aeioulnrst") for _ in range(rnd.randint(2, 8))) for _ in range(3000)]
    insults = [f"insult{chr(97 + k)}" for k in range(10)]
    rows, labels, toxic = [], [], set()
    for i in range(2400):
        words = [rnd.choice(vocabulary) for _ in range(rnd.randint(40, 250))]
        if i % 8 < 1:
            toxic.add(i)
            for w in rnd.sample(insults, 3):
                words.insert(rnd.randrange(len(words)), w.capitalize() + ",")
        low = rnd.random() < 0.12
        rows.append((i, " ".join(w.upper() + "!!" for w in words) if low and i not in toxic else " ".join(words), "en", "s", 5))
        if rnd.random() < 0.6:
            labels.append((i, 0 if low and i not in toxic else 1, int(i in toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    seen = {i for i, _, _ in labels}
    left = {r.doc_id for r in cotraining.good(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    unseen = toxic - seen
    clean = {i for i, t, *_ in rows if not t.isupper()} - toxic - seen
    assert len(unseen) > 80 and len(unseen & left) <= 0.05 * len(unseen)
    assert len(clean - left) <= 0.02 * len(clean)


def test_labels_of_one_class_or_none_keep_all(spark, make):
    docs = make(ODD)
    for rows in ([], [(4, 1), (5, 1)]):
        labels = spark.createDataFrame(rows, "doc_id long, quality int")
        left = cotraining.good(docs, labels)
        assert left.columns == docs.columns
        assert left.count() == len(ODD)
    assert cotraining.scored(make([]), spark.createDataFrame([], "doc_id long, quality int")).collect() == []


# ---------------------------------------------------------------- pipeline


def test_pipeline_removes_what_was_planted(spark, make, tmp_path):
    docs, rows, truth, labels = quality_case(spark, make, 800)
    rnd = random.Random(9)

    def words(n):
        return ["".join(rnd.choice("aeioulnrst") for _ in range(rnd.randint(3, 8))) for _ in range(n)]

    base, other, third, item = words(200), words(200), words(170), " ".join(words(30))
    edited = list(base)
    edited[-1] = "changed"  # one shingle: few bits of the fingerprint
    planted = [(5000, " ".join(base)), (5001, " ".join(base)), (5002, " ".join(edited)), (5003, " ".join(third) + " " + item)]
    planted += [(5004, " ".join(other))]
    everything = [(i, t) for i, t in rows if i is not None] + planted
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in everything], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    left = {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert left & {i for i, _ in planted} == {5001, 5004}
    good, bad = ({i for i, ok in truth.items() if ok is wanted} for wanted in (True, False))
    assert len(left & bad) <= 0.02 * len(bad)
    assert len(good - left) <= 0.02 * len(good)


@pytest.mark.parametrize("name", ["exact_dedup", "near_dedup"])
def test_filtering_stages_on_odd_rows_and_clashing_names(spark, make, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    clashing = ["_id", "_ID_kept", "_content_key", "_key_kept", "_gone", "_key", "_heavy", "component_id", "fingerprint"]
    docs = make(ODD).withColumns({c: F.lit("x") for c in clashing if c != "_ID_kept"}).withColumn("_ID_kept", F.lit("x"))
    left = stage(spark, docs, None)
    assert left.columns == docs.columns
    texts = sorted((r.doc_id if r.doc_id is not None else -1, r.text or "") for r in left.collect())
    if name == "exact_dedup":  # of equal texts the largest doc_id, each row once
        assert texts == sorted([(-1, "no id"), (2, ""), (3, " \n\t "), (5, "one TWO three"), (6, ODD[-3][1]), (7, ODD[-2][1]), (8, ODD[-1][1])])
    else:  # 1, 2, 3 have no words; 5 is 4 in other case
        assert {i for i, _ in texts} == {-1, 1, 4, 6, 7, 8} and len(texts) == 8
    assert stage(spark, make([]), None).count() == 0
