"""Exact, near and substring deduplication against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash

from caudal.llm import components as components_module
from caudal.llm import repeats, rlz_dedup, simhash_dedup, suffix_dedup
from caudal.llm.common import word_digests
from caudal.llm.exact_dedup import CuckooIndex, exact_duplicates, without_duplicates
from caudal.llm.rlz_dedup import without_repeated_passages
from tests.llm.cases import ODD


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# ---------------------------------------------------------------- exact


def test_cuckoo_index_inserts_deletes_and_grows():
    index, rnd, live = CuckooIndex(4), random.Random(1), {}
    for _ in range(5_000):
        digest = rnd.randrange(1 << 64)
        key = digest.to_bytes(8, "big")
        if live and rnd.random() < 0.3:
            gone = live.pop(rnd.choice(list(live)))
            index.delete(gone)
            assert index.find(gone[0], gone[1]) is None
        live[key] = (digest, key, 0, 1, 1)
        index.insert(live[key])
    assert index.resized > 3
    assert all(index.find(d, k) is e for k, e in live.items() for d in [e[0]])
    assert sorted(e[1] for e in index.entries()) == sorted(live)


def test_cuckoo_index_keeps_texts_of_equal_fingerprints_apart():
    index = CuckooIndex(4)
    for i in range(40):  # one digest, many contents: more than any bucket pair holds
        index.add(12345, bytes([i]), i, 1, 1)
    assert all(index.find(12345, bytes([i]))[2] == i for i in range(40))
    assert index.find(12345, b"other") is None


def test_exact_duplicates(make):
    rnd = random.Random(2)
    rows = ODD + [(100 + i, rnd.choice(["Same text", "same TEXT", f"own {i % 70}"])) for i in range(400)]
    got = exact_duplicates(make(rows)).collect()
    assert len(got) == len(rows)
    groups = {}
    for i, t in rows:
        groups.setdefault(hashlib.sha256(lower(t).encode()).hexdigest(), []).append(i)
    for r in got:
        ids = groups[r.text_sha256]
        assert r.group_size == len(ids)
        assert r.keep_id == max((i for i in ids if i is not None), default=None)
        assert not r.kept or r.doc_id == r.keep_id
    kept = [r.text_sha256 for r in got if r.kept]
    assert sorted(kept) == sorted(groups)


def test_without_duplicates_keeps_columns_and_one_row_a_text(make):
    docs = make(ODD)
    left = without_duplicates(docs)
    assert left.columns == docs.columns
    assert sorted(lower(r.text) for r in left.collect()) == sorted({lower(t) for _, t in ODD})


@pytest.mark.parametrize("operator", [
    exact_duplicates, without_duplicates, simhash_dedup.near_duplicates, simhash_dedup.without_near_duplicates,
    rlz_dedup.without_repeated_passages, suffix_dedup.without_repeated_strings,
])
def test_empty_table(make, operator):
    assert operator(make([])).collect() == []


# ---------------------------------------------------------------- near


def fingerprint(text, n=4):
    words = re.findall(rb"[^\x20\x09-\x0D]+", lower(text).encode())
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + n]), seed=42) for i in range(max(1, len(words) - n + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def closed(nodes, linked):
    """Smallest node of each component."""
    left, out = sorted(nodes), {}
    while left:
        group, waiting = set(), [left[0]]
        while waiting:
            x = waiting.pop()
            group.add(x)
            waiting += [y for y in left if y not in group and y not in waiting and linked(x, y)]
        out |= dict.fromkeys(group, min(group))
        left = [x for x in left if x not in group]
    return out


def test_fingerprints_are_those_of_the_contract():
    for _, text in ODD[3:-2] + [(0, "a b c"), (0, "a b c d e"), (0, "A b\tc\nd  e " * 30)]:
        data = np.frombuffer(lower(text).encode(), np.uint8)
        assert simhash_dedup.fingerprint(data, 4) == fingerprint(text)


@pytest.mark.parametrize(("limits", "spare", "dense"), [([4], 3, False), ([4], 3, True), ([3], 2, True), ([6], 2, False), ([6, 40], 2, False)])
def test_links_connect_what_brute_force_connects(spark, monkeypatch, limits, spare, dense):
    if dense:
        monkeypatch.setattr(simhash_dedup, "CELL_SENT", 3)
        monkeypatch.setattr(simhash_dedup, "CELL", 6)
    rnd = random.Random(limits[0])
    points = set()
    for _ in range(12):
        centre = rnd.getrandbits(64)
        for _ in range(14 if dense else 40):
            point = centre
            for _ in range(rnd.randint(0, limits[0])):
                point ^= 1 << rnd.randrange(64)
            points.add(point)
    points = [[p, *(rnd.getrandbits(64) for _ in limits[1:])] for p in sorted(points)]
    signed = [tuple(x - (1 << 64) if x >> 63 else x for x in p) + (i,) for i, p in enumerate(points)]
    schema = ", ".join(f"p{k} long" for k in range(len(limits))) + ", node long"
    links = simhash_dedup.links_within(spark.createDataFrame(signed, schema), limits, spare)
    got = {r.node: r.component for r in components_module.components(links).collect()}
    want = closed(range(len(points)), lambda i, j: all((a ^ b).bit_count() <= n for a, b, n in zip(points[i], points[j], limits, strict=True)))
    assert all(got.get(i, i) == c for i, c in want.items())


def test_near_duplicates(make):
    rnd = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    rows = list(ODD)
    for k in range(20):
        base = [rnd.choice(words) for _ in range(400)]
        for j in range(4):
            copy = list(base)
            for _ in range(j):
                copy[rnd.randrange(400)] = "changed"
            rows.append((100 + 10 * k + j, " ".join(copy)))
    got = simhash_dedup.near_duplicates(make(rows)).collect()
    prints = {(i, t): fingerprint(t) for i, t in rows if i is not None}
    ids = {}
    for (i, _), f in prints.items():
        ids[f] = min(i, ids.get(f, i))
    want = closed(ids, lambda a, b: (a ^ b).bit_count() <= 4)
    least = {}
    for f, c in want.items():
        least[c] = min(ids[f], least.get(c, ids[f]))
    assert len(got) == len(rows)
    for r in got:
        f = r.fingerprint % (1 << 64)
        assert r.component_id == (least[want[f]] if f in want else None)
        assert r.doc_id is None or f in {prints[p] for p in prints if p[0] == r.doc_id}


def test_components_of_paths_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 140)] + [(200, 200), (None, 5), (301, 300)]
    got = {r.node: r.component for r in components_module.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == dict.fromkeys(range(51), 0) | dict.fromkeys(range(100, 140), 100) | {300: 300, 301: 300}


# ---------------------------------------------------------------- substrings


def corpus(seed):
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abcdé") for _ in range(rnd.randint(1, 5))) for _ in range(60)]
    line, passage = (" ".join(rnd.choice(words) for _ in range(n)) for n in (14, 40))
    rows = []
    for i in range(250):
        text = " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 60)))
        if i % 2:
            text = " ".join(rnd.choice(words) for _ in range(12)) + " " + line[: rnd.choice([60, 70, 80])] + " " + text
        if i % 7 == 0:
            text += " " + passage + " " + text
        rows.append((3 * i, text))
    return rows + ODD + rows[40:44] + [(7000, "y" * 700), (7001, "y" * 300)]


def removed(rows, length, symbols, other_doc):
    """Marks of removed symbols for each different row."""
    docs = sorted({(i, t or "") for i, t in rows if i is not None})
    first = {}
    for i, t in docs:
        s = symbols(t)
        for p in range(len(s) - length + 1):
            first.setdefault(tuple(s[p : p + length]), (i, t, p))
    out = {}
    for i, t in docs:
        s = symbols(t)
        gone = [False] * len(s)
        for p in range(len(s) - length + 1):
            source = first[tuple(s[p : p + length])]
            if source[0] < i or (not other_doc and (source[0], source[1]) == (i, t) and source[2] < p):
                gone[p : p + length] = [True] * length
        out[i, t] = (s, gone)
    return out


@pytest.fixture(params=[None, (3, 8)])
def contexts(request, monkeypatch):
    """Also with limits so low that common contexts are dealt out by window."""
    if request.param:
        monkeypatch.setattr(repeats, "CONTEXTS_SENT", request.param[0])
        monkeypatch.setattr(repeats, "CONTEXTS", request.param[1])


def test_repeated_passages(make, contexts):
    rows = corpus(5)
    got = rlz_dedup.without_repeated_passages(make(rows)).collect()
    want = removed(rows, 13, lambda t: re.findall("[^\x20\x09-\x0D]+", t), True)
    assert len(got) == len(rows)
    kept = {}
    for (i, _), (s, gone) in want.items():
        kept.setdefault(i, set()).add((len(s), sum(gone), " ".join(w for w, g in zip(s, gone, strict=True) if not g)))
    for r in got:
        if r.doc_id is None:
            assert r.n_removed == 0
        else:
            assert (r.n_words, r.n_removed, r.kept) in kept[r.doc_id]
            assert sum(s.end - s.start for s in r.spans) == r.n_removed


def test_repeated_strings(make, contexts):
    rows = corpus(6)
    got = suffix_dedup.without_repeated_strings(make(rows)).collect()
    want = removed(rows, 100, lambda t: t.encode(), False)
    assert len(got) == len(rows)
    kept = {}
    for (i, _), (s, gone) in want.items():
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        kept.setdefault(i, set()).add((len(s), sum(gone), runs, bytes(b for b, g in zip(s, gone, strict=True) if not g)))
    for r in got:
        if r.doc_id is None:
            assert r.n_removed == 0
        else:
            assert (r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) in kept[r.doc_id]


def test_suffix_sort_survives_hash_collisions(monkeypatch):
    rnd = random.Random(7)
    data = np.array([rnd.choice(b"ab") for _ in range(600)], np.uint8)
    starts = np.arange(500)
    lengths = np.array([rnd.randint(1, 90) for _ in starts])
    group = np.array([rnd.randrange(3) for _ in starts])
    text = data.tobytes()
    want = sorted((int(g), text[s : s + n]) for g, s, n in zip(group, starts, lengths, strict=True))
    for broken in (False, True):
        if broken:  # every substring has the same hash
            monkeypatch.setattr(suffix_dedup, "prefix_hashes", lambda symbols: np.zeros(len(symbols) + 1, np.uint64))
        order, common = suffix_dedup.sorted_runs(data, starts, lengths, group)
        keys = [(int(group[i]), text[starts[i] : starts[i] + lengths[i]]) for i in order]
        assert keys == want
        for k in range(1, len(keys)):
            (g, a), (h, b) = keys[k - 1], keys[k]
            assert common[k] == (next((n for n, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b))) if g == h else -1)


def test_factors_take_up_at_the_boundary():
    a, b = [f"a{i}".encode() for i in range(6)], [f"b{i}".encode() for i in range(6)]
    joint = a[3:] + b[:3]
    reference = {}
    for block in (a, b, joint):
        for at in range(len(block) - 3):
            reference.setdefault(tuple(block[at : at + 4]), (block, at))
    assert rlz_dedup.factors(a + b, reference, 4) == [(0, 6), (3, 9), (6, 12)]


def test_words_that_collide_in_polynomials_are_told_apart(make):
    """A doubling pattern of two letters and its mirror image: equal modulo 2^64 for every odd base."""
    a, b = "a", "b"
    for _ in range(10):
        a, b = a + b, b + a
    twelve = " ".join(f"w{i}" for i in range(12))
    got = without_repeated_passages(make([(1, f"{a} {twelve}"), (2, f"{b} {twelve}"), (3, f"{a} {twelve}")])).collect()
    assert {r.doc_id: (r.n_words, r.n_removed) for r in got} == {1: (13, 0), 2: (13, 0), 3: (13, 13)}


def test_word_digests_are_those_of_the_bytes():
    words = [b"", b"a", b"a\0", b"abcdefg", b"abcdefgh", b"abcdefghi", b"x" * 64, b"x" * 65, b"x" * 63 + b"y", b"a", b"y" * 300]
    data = np.frombuffer(b" ".join(words), np.uint8)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = ends - [len(w) for w in words]
    for key in (0, 1, 2**64 - 1):
        got = word_digests(data, starts, ends, key).tolist()
        assert got[1] == got[9] and len(set(got)) == len(set(words))
