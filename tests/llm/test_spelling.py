"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from cases import ODD

from caudal.llm import spelling
from caudal.llm.queries import misspelt, op13_spelling
from caudal.llm.spelling import spelling_variants, word_counts


def brute(counts):
    """Near words by the deletions two words share, verified by code point."""
    by_deletion = defaultdict(set)
    for w in counts:
        for form in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            by_deletion[form].add(w)

    def one_edit(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    near = defaultdict(set)
    for group in by_deletion.values():
        for a in group:
            near[a] |= {b for b in group if b not in near[a] and a != b and one_edit(a, b)}
    forms = {}
    for w in counts:
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        forms[w] = best if best and counts[best] >= 2 * counts[w] else None

    def root(w):
        while forms[w]:
            w = forms[w]
        return w

    return {(w, forms[w], root(w), n, len(near[w]), counts[forms[w]] if forms[w] else None) for w, n in counts.items()}


def variants(spark, counts):
    df = spark.createDataFrame([(w, n, "x", "y") for w, n in counts.items()], "word string, n long, root string, cell string").repartition(3)
    rows = [tuple(r) for r in spelling_variants(df.select("word", "n")).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def invented(rng, many, letters="abcdeé", sizes=(3, 9)):
    return {"".join(rng.choice(letters) for _ in range(rng.randint(*sizes))): rng.choice([1, 2, 3, 5, 9, 30, 100]) for _ in range(many)}


@pytest.mark.parametrize("cell", [1 << 15, 100])
def test_invented_words(spark, monkeypatch, cell):
    monkeypatch.setattr(spelling, "CELL_WORDS", cell)
    counts = invented(random.Random(cell), 4000)
    assert variants(spark, counts) == brute(counts)


def test_anagrams_long_words_and_other_letters(spark, monkeypatch):
    monkeypatch.setattr(spelling, "CELL_WORDS", 20)
    rng = random.Random(5)
    counts = {"".join(rng.sample("abcdefg", 7)): rng.randint(1, 9) for _ in range(300)}
    counts |= {"x" * 3000: 5, "x" * 3001: 10, "x" * 1500 + "y" + "x" * 1500: 30, "日本語語彙": 4, "日本語彙": 8, "😀a": 1, "a": 2, "b": 2, "ßßßßß": 1, "ßßßßÿ": 3}
    assert variants(spark, counts) == brute(counts)


def test_no_words(spark):
    assert variants(spark, {}) == set()
    assert variants(spark, {"alone": 3}) == {("alone", None, "alone", 3, 0, None)}


def test_chain_of_forms(spark):
    counts = {"a" * k: 2 ** (40 - k) for k in range(1, 40)}
    assert {r[2] for r in variants(spark, counts)} == {"a"}


def counted(rows):
    total = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 97 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            total[word] += 1
    return total


def test_word_counts(spark, make, monkeypatch):
    rows = [*ODD, (9, "Ünder ÜNDER under×wood naïve " * 50), *((i, "Some words repeat, others Do not; straße x") for i in range(100, 400))]
    assert any(misspelt(i, w) != w for i, t in rows if t for w in t.split() if w.isalpha())
    found = {r["word"]: r["n"] for r in word_counts(make(rows), 5, misspelt).collect()}
    assert found == {w: n for w, n in counted(rows).items() if len(w) >= 5}
    assert word_counts(make([]), 5).count() == 0


def test_search_boxes_lose_no_cell():
    rng = np.random.default_rng(3)
    words = sorted({"".join(rng.choice(list("abcdef"), 6)) for _ in range(900)})
    tree = spelling.fitted({6: (words[::3], 16)})[6]
    counts = spelling.letter_counts(words)
    home = dict(zip(*(x.tolist() for x in spelling.visits(tree, counts, 0, 0)), strict=True))
    met = set(zip(*(x.tolist() for x in spelling.visits(tree, counts, 1, 1)), strict=True))
    assert len(home) == len(words) and len(set(home.values())) > 8
    gap = counts[:, None].astype(int) - counts[None]
    for a, b in np.argwhere((np.maximum(gap, 0).sum(2) <= 1) & (np.maximum(-gap, 0).sum(2) <= 1)).tolist():
        assert (a, home[b]) in met


def test_registered_query(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    counts = {w: n for w, n in counted(docs).items() if len(w) >= 5 and n >= 3}
    found = op13_spelling(spark, sf)
    assert [(f.name, f.dataType.simpleString()) for f in found.schema] == [
        ("word", "string"), ("form", "string"), ("root", "string"), ("n", "bigint"), ("n_near", "bigint"), ("form_n", "bigint")]
    assert {tuple(r) for r in found.collect()} == brute(counts)
