"""Quality classifier by co-training of two views. A good document is of good quality and not toxic.

One classifier sees the content of a text (kinds of characters, words, repetition, single words that tell the classes apart),
the other what is known about
the page without reading it (language, source, declared and real size, layout). Both learn from labelled documents. Over
some rounds each labels the unlabelled documents it is most confident about, for the other to learn from: in every stratum
(source and language) and class a share of its documents, so lessons grow with the table and rare sources have theirs. They are
chosen anew in each round, more in later ones, so an early mistake isn't kept; together they weigh as much as the labelled
documents at most. On a held-out fold each view's score is calibrated, and the calibrated log odds are combined by weights
fitted on that fold too, so that a view that says little weighs little.

Only the labelled documents are a bounded sample (`labelled`, a parameter). The views of all others are computed once and
stored, a few hundred bytes a document; a round is two passes over them, of which counts in bins of the score and then the
lessons go on. The final scoring is a pass over all documents without shuffle, the models being a few hundred numbers.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caudal.llm.common import LOWER, NOT_WORD, dropped, importable, stored, string_bytes, word_hashes
from caudal.llm.repeats import words_of

#: Most labelled documents that training uses unless the caller says otherwise, about (drawn by hash of doc_id).
LABELLED = 20_000
#: In round r a view labels about r times SHARE of the documents of each stratum, of those it is CONFIDENT about.
ROUNDS, SHARE, CONFIDENT = 3, 0.02, 0.95
#: Sources and languages are hashed to so many strata; scores are ordered by bins of 1/FINE of log odds.
STRATA, FINE, BINS = 256, 16, 1024
#: One labelled document in so many is held out for calibration.
FOLD = 5
REGULARISATION, ITERATIONS = 1e-3, 30
#: A training pass has a task for so many rows, and so many tasks at least.
TASK_ROWS, TASKS = 20_000, 6
#: Hashed words, languages and sources.
WORDS, LANGS, SOURCES = 64, 8, 16
#: Most single words for each of toxicity and quality, the fewest labelled documents that must have such a word, and its least
#: chi-squared (about 1e-9 by chance, as very many words are tried).
CHOSEN, SEEN, TELLING = 128, 10, 36.0
NO_WORDS = np.zeros(0, np.uint64)
VIEWS = ("content", "page")
SCORES = ["p_content", "p_page", "p_quality"]


def _kinds() -> np.ndarray:
    """Counts of bytes to counts of kinds: upper case, lower case, digits, white space, line ends, not ASCII, marks of
    sentences, bars, exclamation marks, other symbols."""
    of = np.zeros((256, 10))
    for k, members in enumerate([range(65, 91), range(97, 123), range(48, 58), [32, 9, 11, 12, 13], [10], range(128, 256), b".,;:'\"?-()", b"|", b"!"]):
        of[list(members), k] = 1
    of[of.sum(1) == 0, 9] = 1
    return of


KINDS = _kinds()


def _hashed(values: list, buckets: int) -> np.ndarray:
    """One column a bucket; null has none."""
    out = np.zeros((len(values), buckets))
    for i, v in enumerate(values):
        if v is not None:
            out[i, zlib.crc32(str(v).encode()) % buckets] = 1
    return out


def _plain_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of each word of letters and digits, A-Z as a-z."""
    data = LOWER[data]
    starts, ends = words_of(data, offsets, NOT_WORD) if len(data) else (np.zeros(0, np.int64),) * 2
    if not len(starts):
        return np.zeros(0, np.int64), NO_WORDS
    return np.searchsorted(offsets, starts, "right") - 1, word_hashes(data, starts, ends)


def features(
    data: np.ndarray, offsets: np.ndarray, langs: list, sources: list, declared: list, chosen: np.ndarray = NO_WORDS
) -> tuple[np.ndarray, np.ndarray]:
    """Both views of some documents, a row each; the content view has a column for each of the (sorted) chosen words."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    row = np.repeat(np.arange(n), size)
    counts = np.bincount(row * 256 + data, minlength=256 * n).reshape(n, 256) @ KINDS
    some = np.maximum(size, 1)[:, None]
    starts, ends = words_of(data, offsets) if len(data) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    word_row = row[starts] if len(starts) else np.zeros(0, np.int64)
    words = np.bincount(word_row, minlength=n)
    some_words = np.maximum(words, 1)
    hashes = word_hashes(data, starts, ends) if len(starts) else np.zeros(0, np.uint64)
    table = np.bincount(word_row * WORDS + (hashes % np.uint64(WORDS)).astype(np.int64), minlength=n * WORDS).reshape(n, WORDS)
    again = []
    for step in (1, 2):
        same = (hashes[step:] == hashes[:-step]) & (word_row[step:] == word_row[:-step])
        again.append(np.bincount(word_row[step:][same], minlength=n) / some_words)
    content = np.column_stack([
        counts / some, (counts[:, [9, 8, 7]] > 0).astype(float), np.bincount(word_row, ends - starts, n) / some_words / 10, *again,
        np.log1p(words) / 10, table / some_words[:, None],
    ])
    if len(chosen):
        at_row, plain = _plain_words(data, offsets)
        place = np.minimum(np.searchsorted(chosen, plain), len(chosen) - 1)
        hit = chosen[place] == plain
        has = np.zeros((n, len(chosen)))
        has[at_row[hit], place[hit]] = 1
        content = np.column_stack([content, has])
    said = np.array([0 if d is None else max(d, 0) for d in declared], float)
    lines = counts[:, 4] + (size > 0)
    page = np.column_stack([
        np.log1p(said) / 10, [d is None for d in declared], np.log1p(size) / 10, np.log1p(lines) / 10,
        np.log1p(size / np.maximum(lines, 1)) / 10, np.log1p(said) / np.log1p(np.maximum(size, 1)),
        _hashed(langs, LANGS), _hashed(sources, SOURCES),
    ])
    return content, page


INPUTS = {"text": "string", "lang": "string", "source": "string", "n_chars": "long"}


def _batch_features(batch: pa.RecordBatch, places: list[int | None], chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Views of a batch; places are the numbers of the INPUTS among its columns, null for those it doesn't have."""
    n = batch.num_rows
    text, *rest = [pa.nulls(n, pa.string()) if p is None else batch.column(p) for p in places]
    data, offsets = string_bytes(text)
    rest = [c.to_pylist() for c in rest]
    parts = [
        features(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], *(c[a:b] for c in rest), chosen)
        for a, b in ((a, min(a + 200, n)) for a in range(0, n, 200))
    ]
    return tuple(np.concatenate(v) for v in zip(*parts, strict=True)) if parts else features(data, np.zeros(1, np.int64), [], [], [], chosen)


def _feature_rows(chosen: np.ndarray):
    """(two columns, inputs) to (the two columns, views)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            views = [
                pa.ListArray.from_arrays(np.arange(len(v) + 1, dtype=np.int32) * v.shape[1], v.astype(np.float32).ravel())
                for v in _batch_features(batch, [2, 3, 4, 5], chosen)
            ]
            yield pa.record_batch([*batch.columns[:2], *views], [*batch.schema.names[:2], *VIEWS])

    return run


def _matrix(column: pa.ListArray) -> np.ndarray:
    """A list column of equal lengths, a row each."""
    return column.flatten().to_numpy().reshape(len(column), -1)


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, low, toxic) to (word, documents that have it, of these of low quality, of these toxic)."""
    for batch in batches:
        data, offsets = string_bytes(batch.column(0))
        row, word = _plain_words(data, offsets)
        pairs = np.unique(np.stack([word, row.astype(np.uint64)]), axis=1)
        which, start = np.unique(pairs[0], return_index=True)
        row = pairs[1].astype(np.int64)
        sums = [np.add.reduceat(x, start) if len(start) else np.zeros(0, np.int64) for x in (np.ones(len(row), np.int64), *(c.to_numpy()[row] for c in batch.columns[1:]))]
        yield pa.record_batch([pa.array(which.view(np.int64)), *(pa.array(x, pa.int64()) for x in sums)], ["word", "n", "low", "toxic"])


def telling_words(rows: DataFrame) -> np.ndarray:
    """Sorted hashes of the words that tell low from good quality, and toxic documents from others, best, by chi-squared of their
    document counts in rows (text, low, toxic: long)."""
    total = rows.agg(F.count("*"), F.sum("low"), F.sum("toxic")).first()
    counts = rows.mapInArrow(_word_counts, "word long, n long, low long, toxic long").groupBy("word").agg(
        *[F.sum(c).alias(c) for c in ("n", "low", "toxic")]
    ).filter(F.col("n") >= SEEN)
    counts = stored(counts, "words")
    found = set()
    for kind, marked in (("low", total[1]), ("toxic", total[2])):
        share = (marked or 0) / max(total[0], 1)
        if not 0 < share < 1:
            continue
        left_out = 1 - F.col("n") / total[0]
        value = F.pow(F.col(kind) - F.col("n") * share, 2) / (F.col("n") * share * (1 - share) * left_out)
        best = counts.filter(F.col("n") < total[0]).select("word", value.alias("value")).filter(F.col("value") >= TELLING)
        found |= {r[0] for r in best.orderBy(F.desc("value"), "word").limit(CHOSEN).collect()}
    return np.sort(np.array(sorted(found), np.int64).view(np.uint64))


def _inputs(docs: DataFrame) -> list:
    """INPUTS as columns; those that docs doesn't have are null."""
    return [(F.col(c) if c in docs.columns else F.lit(None)).cast(k).alias(f"_{c}") for c, k in INPUTS.items()]


def _typed(docs: DataFrame) -> DataFrame:
    """docs with the INPUTS it has in their types."""
    return docs.withColumns({c: F.col(c).cast(k) for c, k in INPUTS.items() if c in docs.columns})


# ---------------------------------------------------------------- model


def logistic(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


@dataclass
class View:
    """Linear score of a view, and its calibration to log odds."""

    weights: np.ndarray
    intercept: float
    slope: float = 1.0
    shift: float = 0.0

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        return self.slope * (x @ self.weights + self.intercept) + self.shift


@dataclass
class QualityModel:
    """Both views and how their log odds are combined; without views (labels of one class or none) every document is good."""

    views: dict[str, View] = field(default_factory=dict)
    joint: View | None = None
    chosen: np.ndarray = field(default_factory=lambda: NO_WORDS)

    def scores(self, content: np.ndarray, page: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probability of good quality: by content, by page, combined."""
        if not self.views:
            return (np.ones(len(content)),) * 3
        a, b = self.views["content"].log_odds(content), self.views["page"].log_odds(page)
        return logistic(a), logistic(b), logistic(self.joint.log_odds(np.column_stack([a, b])))

    def scored(self, docs: DataFrame) -> DataFrame:
        """All columns of docs with p_content, p_page and p_quality behind them, which replace columns of these names."""
        importable(docs.sparkSession)
        docs = _typed(docs.drop(*SCORES))
        places = [docs.columns.index(c) if c in docs.columns else None for c in INPUTS]
        columns = docs.columns

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = self.scores(*_batch_features(batch, places, self.chosen))
                yield pa.record_batch([*batch.columns, *(pa.array(p, pa.float64()) for p in found)], [*columns, *SCORES])

        return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *(T.StructField(n, T.DoubleType()) for n in SCORES)]))

    def good(self, docs: DataFrame, least: float) -> DataFrame:
        """The rows of docs whose combined probability is at least `least`, with their columns."""
        importable(docs.sparkSession)
        docs = _typed(docs)
        places = [docs.columns.index(c) if c in docs.columns else None for c in INPUTS]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array(self.scores(*_batch_features(batch, places, self.chosen))[2] >= least))

        return docs.mapInArrow(run, docs.schema)


def _fit(rows: DataFrame, view: str, n: int = 0) -> View:
    """Logistic regression of label on an array column of about n rows, weighted by weight, by Spark."""
    model = LogisticRegression(
        maxIter=ITERATIONS, regParam=REGULARISATION, featuresCol="features", labelCol="label", weightCol="weight"
    ).fit(
        rows.select(array_to_vector(F.col(view).cast("array<double>")).alias("features"), F.col("label").cast("double"), "weight")
        .coalesce(max(TASKS, n // TASK_ROWS))
    )
    return View(np.array(model.coefficients.toArray()), float(model.intercept))


def _raw_scores(views: dict[str, View]):
    """(label, views) to (label, weight, the views' scores, each as an array of one)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                scores = [view.log_odds(_matrix(batch.column(v))) for v, view in views.items()]
                ones = np.arange(batch.num_rows + 1, dtype=np.int32)
                yield pa.record_batch(
                    [batch.column("label"), pa.array(np.ones(batch.num_rows)), *(pa.ListArray.from_arrays(ones, x) for x in scores)],
                    ["label", "weight", *VIEWS],
                )

    return run


def _raw(views: dict[str, View], rows: DataFrame) -> DataFrame:
    return stored(
        rows.select("label", *VIEWS).mapInArrow(_raw_scores(views), "label int, weight double, content array<double>, page array<double>"), "scores"
    )


# ---------------------------------------------------------------- lessons


def _placed(view: View, column: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Label that the view gives to each row, bin of its confidence, and whether it is confident."""
    score = view.log_odds(_matrix(column))
    sure = np.abs(score)
    return (score > 0).astype(np.int64), np.minimum(sure * FINE, BINS - 1).astype(np.int64), sure >= np.log(CONFIDENT / (1 - CONFIDENT))


def _bin_counts(views: dict[str, View]):
    """(stratum, views) to (teacher, stratum, label, bin, rows) of confident rows, summed up within a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            stratum = batch.column("stratum").to_numpy().astype(np.int64)
            for teacher, name in enumerate(VIEWS):
                label, at, sure = _placed(views[name], batch.column(name))
                keys, n = np.unique(((stratum * 2 + label) * BINS + at)[sure], return_counts=True)
                columns = [np.full(len(keys), teacher), keys // BINS // 2, keys // BINS % 2, keys % BINS, n]
                yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], ["teacher", "stratum", "label", "bin", "n"])

    return run


def _least_bins(pool: DataFrame, views: dict[str, View], share: float, good: float) -> tuple[np.ndarray, list[int]]:
    """The least bin whose rows become lessons, by teacher, stratum and label (BINS: none), and the number of each teacher's
    lessons. Rows of a bin stay together, so ties are all taken."""
    counts = pool.select("stratum", *VIEWS).mapInArrow(_bin_counts(views), "teacher long, stratum long, label long, bin long, n long")
    counts = counts.groupBy("teacher", "stratum", "label", "bin").agg(F.sum("n").alias("n"))
    sizes = pool.groupBy(F.col("stratum").cast("long").alias("stratum")).agg(F.count("*").alias("size"))
    # At most 2 * STRATA * 2 groups of BINS rows, whatever the table.
    better = Window.partitionBy("teacher", "stratum", "label").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, -1)
    quota = F.col("size") * share * F.when(F.col("label") == 1, good).otherwise(1 - good)
    taken = counts.join(F.broadcast(sizes), "stratum").withColumn("before", F.coalesce(F.sum("n").over(better), F.lit(0))).filter(F.col("before") < quota)
    least, lessons = np.full((len(VIEWS), STRATA, 2), BINS), [0] * len(VIEWS)
    for r in taken.groupBy("teacher", "stratum", "label").agg(F.min("bin").alias("bin"), F.sum("n").alias("n")).collect():
        least[r["teacher"], r["stratum"], r["label"]] = r["bin"]
        lessons[r["teacher"]] += r["n"]
    return least, lessons


def _lesson_rows(views: dict[str, View], least: np.ndarray, weights: list[float]):
    """(stratum, views) to (teacher, label, weight, features for the pupil)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            stratum = batch.column("stratum").to_numpy()
            for teacher, (name, pupil) in enumerate((VIEWS, VIEWS[::-1])):
                label, at, sure = _placed(views[name], batch.column(name))
                rows = np.flatnonzero(sure & (at >= least[teacher, stratum, label]))
                n = len(rows)
                columns = [np.full(n, teacher, np.int32), label[rows].astype(np.int32), np.full(n, weights[teacher])]
                yield pa.record_batch([*map(pa.array, columns), batch.column(pupil).take(pa.array(rows))], ["teacher", "label", "weight", "features"])

    return run


def lessons(pool: DataFrame, views: dict[str, View], share: float, good: float, known: int) -> tuple[DataFrame, list[int]]:
    """(teacher, label, weight, features) of the rows of pool (stratum, content, page) that a view teaches the other: in each
    stratum and class the most confident ones, `share` of its rows divided by the share of good ones; and their number by teacher.
    Those of a teacher weigh as much as `known` rows at most."""
    least, counts = _least_bins(pool, views, share, good)
    weights = [min(1.0, known / max(n, 1)) for n in counts]
    found = pool.select("stratum", *VIEWS).mapInArrow(_lesson_rows(views, least, weights), "teacher int, label int, weight double, features array<float>")
    return stored(found, "lessons"), counts


def _both_classes(rows: DataFrame) -> bool:
    return rows.select("label").distinct().count() == 2


def _held(doc_id):
    """Whether a labelled document is held out for calibration."""
    return F.pmod(F.xxhash64(doc_id, F.lit(7)), F.lit(FOLD)) == 0


def _truth(labels: DataFrame) -> DataFrame:
    """(doc_id, label, low, toxic) of labels (doc_id, quality, toxic): label is 1 for good quality that isn't toxic. Of several labels
    the majority, at a tie good and toxic. Documents without quality are known only if they are toxic."""
    found = labels.filter("doc_id is not null").groupBy("doc_id").agg(F.avg("quality").alias("quality"), F.avg("toxic").alias("toxic"))
    toxic, good = F.coalesce(F.col("toxic") >= 0.5, F.lit(False)), F.col("quality") >= 0.5
    return found.filter(F.col("quality").isNotNull() | toxic).select(
        "doc_id", F.when(good & ~toxic, 1).otherwise(0).alias("label"),
        F.when(good | F.col("quality").isNull(), 0).otherwise(1).cast("long").alias("low"), toxic.cast("long").alias("toxic"),
    )


VIEW_COLUMNS = "content array<float>, page array<float>"


def known_rows(docs: DataFrame, truth: DataFrame, most: int) -> tuple[DataFrame, np.ndarray]:
    """(doc_id, label, content, page) of at most about `most` labelled documents, and the single words of the content view, which are
    chosen without the documents held out."""
    n_labels = truth.count()
    place = F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(1_000_000)) / 1e6
    chosen = stored(truth.filter(place < min(1.0, most / max(n_labels, 1))), "truth")
    # At most so many rows of four numbers, so their texts are found without a shuffle of texts.
    labelled = docs.filter("doc_id is not null").select("doc_id", *_inputs(docs)).join(F.broadcast(chosen), "doc_id")
    words = telling_words(labelled.filter(~_held("doc_id")).select("_text", "low", "toxic"))
    rows = labelled.select("doc_id", "label", "_text", "_lang", "_source", "_n_chars")
    return stored(rows.mapInArrow(_feature_rows(words), f"doc_id long, label int, {VIEW_COLUMNS}"), "known"), words


def pool_rows(docs: DataFrame, truth: DataFrame, words: np.ndarray) -> DataFrame:
    """(stratum, content, page) of every document without label. Texts become views before the join with the labels, so
    they are not shuffled."""
    stratum = F.pmod(F.xxhash64("_source", "_lang"), F.lit(STRATA)).cast("int").alias("stratum")
    rows = docs.filter("doc_id is not null").select("doc_id", *_inputs(docs)).select("doc_id", stratum, "_text", "_lang", "_source", "_n_chars")
    views = rows.mapInArrow(_feature_rows(words), f"doc_id long, stratum int, {VIEW_COLUMNS}")
    return stored(views.join(truth.select("doc_id"), "doc_id", "left_anti").drop("doc_id"), "pool")


def trained(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> QualityModel:
    """Co-trains on docs (doc_id, text, lang, source, n_chars; missing ones count as null) and labels (doc_id, quality 0 or
    1, toxic 0 or 1 or missing; see `_truth`). At most about `labelled` labelled documents are used, and all others. Rows without
    doc_id are not used. Null texts are empty ones; repeated rows count each. Without labels of both classes, as in
    empty tables, nothing is trained and every document is good."""
    importable(docs.sparkSession)
    docs = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    toxic = F.col("toxic") if "toxic" in labels.columns else F.lit(None)
    truth = _truth(labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("double"), toxic.cast("double").alias("toxic")))
    known, words = known_rows(docs, truth, labelled)
    held = _held("doc_id")
    fold, learn = known.filter(held), known.filter(~held).withColumn("weight", F.lit(1.0))
    if not _both_classes(learn):
        return QualityModel()
    n, share = learn.agg(F.count("*"), F.avg("label")).first()
    pool = pool_rows(docs, truth, words)
    views = {v: _fit(learn, v, n) for v in VIEWS}
    for number in range(1, ROUNDS + 1):
        taught, counts = lessons(pool, views, SHARE * number, share, n)
        views = {
            pupil: _fit(
                learn.select("label", "weight", F.col(pupil).alias("features")).unionByName(taught.filter(F.col("teacher") == teacher).drop("teacher")),
                "features", n + counts[teacher],
            )
            for teacher, pupil in enumerate(VIEWS[::-1])
        }
        dropped(taught)
    dropped(pool)
    if not _both_classes(fold):
        # Nothing to fit on: views count as independent given the class, so log odds add up and the prior counts once.
        return QualityModel(views, View(np.ones(2), -float(np.log(share / (1 - share)))), words)
    # Log odds as a linear function of the score, and then their combination, fitted on rows the views haven't seen.
    raw = _raw(views, fold)
    for name, view in views.items():
        scaled = _fit(raw, name)
        view.slope, view.shift = float(scaled.weights[0]), scaled.intercept
    odds = F.array(*[F.col(v)[0] * view.slope + view.shift for v, view in views.items()])
    return QualityModel(views, _fit(raw.withColumn("odds", odds), "odds"), words)


def good(docs: DataFrame, labels: DataFrame, least: float = 0.5, labelled: int = LABELLED) -> DataFrame:
    """The rows of docs, with all their columns, whose combined probability of good quality is at least `least`. Null and empty texts
    are scored as empty, rows without doc_id and repeated ones like all others; an empty table stays empty."""
    return trained(docs, labels, labelled).good(docs, least)


def scored(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> DataFrame:
    """All columns of docs with p_content, p_page, p_quality (probabilities of good quality by either view and
    combined). Every row gets its score, also those without doc_id; null and empty texts are scored as empty. Without
    labels of both classes all are 1. An empty table gives an empty result."""
    return trained(docs, labels, labelled).scored(docs)
