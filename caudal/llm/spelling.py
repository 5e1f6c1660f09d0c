"""Spelling variants: words one edit apart, found by k-d trees over letter counts, and the form each word varies from.

One inserted or deleted letter changes the letter counts of a word by one in one place, one replaced letter by one in two:
an L1 distance of 1 or 2. So near words are sought with range searches in k-d trees, for each pair of lengths that can be near
(equal ones, and a length and the next): a part of a tree is pruned if its box of counts needs more letters added or taken
away than one edit does. Words whose counts fit are verified letter by letter.

The upper part of the trees, one for each length, is fitted on a sample of the words and deals all words out to cells; a word also
visits each cell that its search box meets. The sample decides the balance only. Within a cell a tree is built over the cell's words.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caudal.llm.common import dropped, stored

#: Words that a cell should hold, and sampled words for each cell; the sample is fetched, MOST_SAMPLED words at most.
CELL_WORDS = 1 << 15
CELL_SAMPLE = 64
MOST_SAMPLED = 1 << 20
#: Words of a leaf in a cell's tree.
LEAF = 48
#: Words counted in a task before counts are passed on.
HELD_WORDS = 300_000
#: Bytes of the arrays that compare queries with a leaf.
BLOCK_BYTES = 1 << 22

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {c: c + 32 for c in range(65, 91)}

#: Letter dimensions: a-z, and 64 more for other letters. Letters that share one can only bring counts closer together.
PLAIN, OTHER = 26, 64
DIMENSIONS = PLAIN + OTHER
#: Counts are kept up to this; cutting them also only brings them closer together.
MOST_COUNT = 100

HOME, VISITOR, SHORTER = 0, 1, 2


# ---------------------------------------------------------------- words


def word_counts(docs: DataFrame, least_length: int, change: Callable[[object, str], str] | None = None) -> DataFrame:
    """(word, n) for the runs of Latin letters in whole texts, A-Z in lower case, of `least_length` code points or more.

    `change` may turn a document's word into another: it gets doc_id and word. A null text has no words. Counts are summed
    within tasks before the shuffle."""

    def count(batches):
        total: Counter = Counter()

        def flush():
            rows = pa.record_batch([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], names=["word", "n"])
            total.clear()
            return rows

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                for run, n in Counter(RUN.findall(text.as_py() or "")).items():
                    word = run.translate(LOWER)
                    if change:
                        word = change(doc_id, word)
                    if len(word) >= least_length:
                        total[word] += n
                if len(total) >= HELD_WORDS:
                    yield flush()
        yield flush()

    return docs.select("doc_id", "text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _codes(words: list[str]) -> np.ndarray:
    """Code points of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1)


def letter_counts(words: list[str]) -> np.ndarray:
    """A row of letter counts for each word, all of one length."""
    out = np.zeros((len(words), DIMENSIONS), np.int8)
    step = max((1 << 19) // (DIMENSIONS + len(words[0])), 1) if words else 1
    for a in range(0, len(words), step):
        codes = _codes(words[a : a + step]).astype(np.int64)
        place = np.where((codes >= 97) & (codes <= 122), codes - 97, PLAIN + codes % OTHER)
        place += np.arange(len(codes))[:, None] * DIMENSIONS
        counts = np.bincount(place.ravel(), minlength=len(codes) * DIMENSIONS).reshape(-1, DIMENSIONS)
        out[a : a + step] = np.minimum(counts, MOST_COUNT)
    return out


# ---------------------------------------------------------------- trees


def _split(counts: np.ndarray) -> tuple[int, int] | None:
    """The letter that varies most, and the largest count of the lower part; None if all counts are equal."""
    letter = int(counts.var(axis=0).argmax())
    values = counts[:, letter]
    low, high = int(values.min()), int(values.max())
    if low == high:
        return None
    return letter, min(max(int(np.median(values)), low), high - 1)


def fitted(samples: dict[int, tuple[list[str], int]]) -> dict[int, list]:
    """For each length, from a sample of its words and the number of cells they shall have, a tree of (letter, highest
    count below, low part, high part) over numbered cells."""
    number = iter(range(1 << 62))

    def grow(counts, cells):
        cut = _split(counts) if cells > 1 and len(counts) > 1 else None
        if cut is None:
            return next(number)
        below = counts[:, cut[0]] <= cut[1]
        left = min(max(round(cells * below.mean()), 1), cells - 1)
        return [*cut, grow(counts[below], left), grow(counts[~below], cells - left)]

    return {length: grow(letter_counts(words), cells) for length, (words, cells) in sorted(samples.items())}


def visits(tree, counts: np.ndarray, taken: int, added: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, cell) for each cell that holds counts within `taken` letters fewer and `added` letters more; (0, 0) is
    the row's own cell."""
    rows, cells = [], []
    none, wide = np.full(DIMENSIONS, -1, np.int16), np.full(DIMENSIONS, 32_000, np.int16)
    zero = np.zeros(len(counts), np.int16)
    todo = [(tree, np.arange(len(counts)), zero, zero, none, wide)]
    while todo:
        node, at, less, more, low, high = todo.pop()
        if not len(at):
            continue
        if isinstance(node, int):
            rows.append(at)
            cells.append(np.full(len(at), node))
            continue
        letter, cut, left, right = node
        here = counts[at, letter].astype(np.int16)
        # Below the cut: letters above it must go.
        now = less - np.maximum(here - high[letter], 0) + np.maximum(here - cut, 0)
        keep, bound = now <= taken, high.copy()
        bound[letter] = cut
        todo.append((left, at[keep], now[keep], more[keep], low, bound))
        # Above it: letters up to it must come.
        now = more - np.maximum(low[letter] - here, 0) + np.maximum(cut + 1 - here, 0)
        keep, bound = now <= added, low.copy()
        bound[letter] = cut + 1
        todo.append((right, at[keep], less[keep], now[keep], bound, high))
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(rows), np.concatenate(cells)


class Tree:
    """Words of one length and cell."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts
        self.nodes: list[tuple] = []
        if len(counts):
            self._grow(np.arange(len(counts)))

    def _grow(self, at: np.ndarray) -> int:
        here, own = self.counts[at], len(self.nodes)
        cut = _split(here) if len(at) > LEAF else None
        self.nodes.append(None)
        if cut is None:
            self.nodes[own] = (here.min(0), here.max(0), at, None)
        else:
            below = here[:, cut[0]] <= cut[1]
            self.nodes[own] = (here.min(0), here.max(0), None, (self._grow(at[below]), self._grow(at[~below])))
        return own

    def near(self, queries: np.ndarray, taken: int):
        """Blocks of (query rows, word rows) whose counts differ by at most one letter more and `taken` letters fewer; less
        where letters share a dimension or counts are cut."""
        todo = [(0, np.arange(len(queries)))] if self.nodes else []
        while todo:
            number, rows = todo.pop()
            low, high, at, parts = self.nodes[number]
            asked = queries[rows]
            fits = np.maximum(asked - high, 0).sum(1) <= taken
            fits &= np.maximum(low - asked, 0).sum(1) <= 1
            rows = rows[fits]
            if not len(rows):
                continue
            if parts:
                todo += [(part, rows) for part in parts]
                continue
            points = self.counts[at]
            used = np.flatnonzero(high)
            outside = queries[rows].sum(1, dtype=np.int64) - queries[np.ix_(rows, used)].sum(1, dtype=np.int64)
            points = points[:, used]
            step = max(BLOCK_BYTES // max(points.size, 1), 1)
            for a in range(0, len(rows), step):
                some = rows[a : a + step]
                gap = points[None] - queries[np.ix_(some, used)][:, None]
                more = np.maximum(gap, 0).sum(2, dtype=np.int16)
                less = np.maximum(-gap, 0).sum(2, dtype=np.int16) + outside[a : a + step, None]
                q, p = np.nonzero((more <= 1) & (less <= taken))
                if len(q):
                    yield some[q], at[p]


def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rows of code points of equal length that differ in one place."""
    return (a != b).sum(1) == 1


def one_inserted(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rows where b is a with one code point more."""
    ahead = np.logical_and.accumulate(a == b[:, :-1], axis=1).sum(1)
    behind = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(1)
    return ahead + behind >= a.shape[1]


def _search(table: pa.Table) -> pa.Table:
    """Within one cell: for each word with near words how many there are here, and the best one."""
    words, n = table.column("word").to_pylist(), table.column("n").to_numpy()
    kind = table.column("kind").to_numpy()
    order = sorted(range(len(words)), key=lambda i: (-n[i], words[i]))
    place = np.empty(len(words), np.int64)
    place[order] = np.arange(len(words))
    count, best = np.zeros(len(words), np.int64), np.full(len(words), len(words))

    groups = {k: np.flatnonzero(kind == k) for k in (HOME, VISITOR, SHORTER)}
    named = {k: [words[i] for i in at] for k, at in groups.items()}
    home = groups[HOME]
    if len(home):
        tree, codes = Tree(letter_counts(named[HOME])), _codes(named[HOME])
        for k, taken, verify in ((HOME, 1, one_replaced), (VISITOR, 1, one_replaced), (SHORTER, 0, one_inserted)):
            if not len(groups[k]):
                continue
            asked = _codes(named[k])
            for q, p in tree.near(letter_counts(named[k]), taken):
                if k == HOME:  # each pair of the cell's own words comes up twice
                    q, p = q[q < p], p[q < p]
                step = max(BLOCK_BYTES // (4 * codes.shape[1]), 1)
                for a in range(0, len(q), step):
                    some, others = q[a : a + step], p[a : a + step]
                    right = verify(asked[some], codes[others])
                    left, near = groups[k][some[right]], home[others[right]]
                    for x, y in ((left, near), (near, left)):
                        np.add.at(count, x, 1)
                        np.minimum.at(best, x, place[y])
    found = np.flatnonzero(count)
    forms = [order[i] for i in best[found].tolist()]
    return pa.table({
        "word": pa.array([words[i] for i in found.tolist()], pa.string()), "n_near": count[found],
        "near": pa.array([words[i] for i in forms], pa.string()), "near_n": n[forms].astype(np.int64) if forms else np.zeros(0, np.int64),
    })


# ---------------------------------------------------------------- operator


def _cells(words: DataFrame) -> dict[int, list]:
    """The upper trees of all lengths."""
    sizes = {r["length"]: r["n"] for r in words.groupBy("length").agg(F.count("*").alias("n")).collect()}
    cells = {length: -(-n // CELL_WORDS) for length, n in sizes.items()}
    many = [length for length, n in cells.items() if n > 1]
    samples = {length: ([], 1) for length in cells if length not in many}
    if many:
        wanted = min(sum(cells[length] for length in many) * CELL_SAMPLE, MOST_SAMPLED)
        share = wanted / sum(sizes[length] for length in many)
        chosen = words.where(F.col("length").isin(many)).where(
            F.pmod(F.xxhash64("word"), F.lit(1_000_003)) < F.lit(int(share * 1_000_003) + 1)
        ).select("length", "word").collect()
        for length in many:
            samples[length] = (sorted(r["word"] for r in chosen if r["length"] == length), cells[length])
    return fitted(samples)


def _dealt(trees: dict[int, list]):
    """Each word with the cells it has to do with."""

    def deal(batches):
        for batch in batches:
            words, n = np.array(batch.column("word").to_pylist(), object), batch.column("n").to_numpy()
            lengths = np.array([len(w) for w in words])
            for length in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == length)
                counts = letter_counts(words[at].tolist())
                rows, cells = visits(trees[length], counts, 0, 0)
                home = np.empty(len(at), np.int64)
                home[rows] = cells
                out = [(at, home, np.full(len(at), HOME, np.int32))]
                rows, cells = visits(trees[length], counts, 1, 1)
                # Of two cells that pairs lie between, the words of the lower one visit the other.
                up = cells > home[rows]
                out.append((at[rows[up]], cells[up], np.full(int(up.sum()), VISITOR, np.int32)))
                if length + 1 in trees:
                    rows, cells = visits(trees[length + 1], counts, 0, 1)
                    out.append((at[rows], cells, np.full(len(rows), SHORTER, np.int32)))
                where, cells, kinds = (np.concatenate(x) for x in zip(*out, strict=True))
                yield pa.record_batch(
                    [cells.astype(np.int64), kinds, pa.array(words[where], pa.string()), n[where]], names=["cell", "kind", "word", "n"])

    return deal


def near_words(counts: DataFrame) -> DataFrame:
    """(word, n_near, near, near_n) for each word of (word, n), which must be different, with words exactly one inserted,
    deleted or replaced code point away: how many there are, and of these the one of largest n, ties to the smallest in
    code-point order. Words of any letters and length are handled; null and empty words have no near words. No pairs are stored."""
    words = counts.where(F.length("word") > 0).select("word", F.col("n").cast("long"), F.char_length("word").alias("length"))
    trees = _cells(words)
    if not trees:
        return counts.sparkSession.createDataFrame([], "word string, n_near long, near string, near_n long")
    parts = (
        words.select("word", "n").mapInArrow(_dealt(trees), "cell long, kind int, word string, n long")
        .groupBy("cell").applyInArrow(_search, "word string, n_near long, near string, near_n long")
    )
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word")))
    return parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select(
        "word", "n_near", F.col("b.word").alias("near"), (-F.col("b.n")).alias("near_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): the last word that following forms leads to. Forms must not go round in a circle.
    Each round doubles the steps taken."""
    now = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        joined = now.join(ahead, F.col("root") == F.col("_word"), "left")
        moved = stored(joined.select("word", F.coalesce("_root", "root").alias("root"), F.col("_root").isNotNull().alias("moved")), "roots")
        dropped(now)
        now = moved
        if now.where("moved").isEmpty():
            return now.select("word", "root")


def spelling_variants(counts: DataFrame, times: int = 2) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each word of (word, n): the form is the near word of largest n if that is
    at least `times` (2 or more) the word's n, and the root what forms lead to in the end; without a form, the word itself."""
    near = stored(near_words(counts), "near").withColumnRenamed("word", "_near_word")
    is_form = F.col("near_n") >= times * F.col("n")
    all_words = stored(
        counts.join(near, F.col("word") == F.col("_near_word"), "left").select(
            "word", F.when(is_form, F.col("near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(is_form, F.col("near_n")).alias("form_n")), "words")
    last = roots(all_words.where("form is not null")).withColumnRenamed("word", "_rooted")
    return all_words.join(last, F.col("word") == F.col("_rooted"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
