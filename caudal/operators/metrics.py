"""Evaluation of a binary classifier as table aggregations."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

SCORE_SLICES = 256
INF = float("inf")


def _cells(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row with the four counts of the 2x2 table."""
    y, p = F.col(label).cast("int"), F.col(prediction).cast("int")
    return df.agg(
        *[F.count_if((y == a) & (p == b)).alias(f"c{a}{b}") for a in (0, 1) for b in (0, 1)]
    )


def confusion_matrix(df: DataFrame, label: str = "riesgo", prediction: str = "prediction") -> DataFrame:
    """All four cells, also the empty ones."""
    rows = ", ".join(f"{a}, {b}, c{a}{b}" for a in (0, 1) for b in (0, 1))
    return _cells(df, label, prediction).selectExpr(f"stack(4, {rows}) as (real, predicho, n)")


def accuracy(df: DataFrame, label: str = "riesgo", prediction: str = "prediction") -> DataFrame:
    return df.agg(
        F.avg((F.col(label).cast("int") == F.col(prediction).cast("int")).cast("double")).alias("accuracy")
    )


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(part / F.nullif(whole, F.lit(0)), F.lit(0.0))


def _class_scores(cells: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support of both classes next to the cells."""
    columns = {}
    for k, hit, false_hit, miss in ((0, "c00", "c10", "c01"), (1, "c11", "c01", "c10")):
        columns[f"p{k}"] = _ratio(F.col(hit), F.col(hit) + F.col(false_hit))
        columns[f"r{k}"] = _ratio(F.col(hit), F.col(hit) + F.col(miss))
        columns[f"s{k}"] = F.col(hit) + F.col(miss)
    scores = cells.withColumns(columns)
    return scores.withColumns(
        {f"f{k}": _ratio(2 * F.col(f"p{k}") * F.col(f"r{k}"), F.col(f"p{k}") + F.col(f"r{k}"))
         for k in (0, 1)}
    ).withColumn("s", F.col("s0") + F.col("s1"))


def _averages(m: str) -> tuple[str, str]:
    return f"({m}0 + {m}1) / 2", f"coalesce(({m}0 * s0 + {m}1 * s1) / nullif(s, 0), 0d)"


def classification_report(
    df: DataFrame, label: str = "riesgo", prediction: str = "prediction"
) -> DataFrame:
    """Precision, recall, F1 and support per class, plus macro and weighted averages."""
    macro, weighted = (", ".join(v) for v in zip(*map(_averages, "prf")))
    return _class_scores(_cells(df, label, prediction)).selectExpr(
        f"stack(4, '0', p0, r0, f0, s0, '1', p1, r1, f1, s1, "
        f"'macro avg', {macro}, s, 'weighted avg', {weighted}, s) "
        "as (clase, precision, recall, f1, support)"
    )


def roc_auc(df: DataFrame, label: str = "riesgo", score: str = "probabilidad_alto_riesgo") -> DataFrame:
    """Exact area under the ROC curve, ties counted half.

    Rows are first reduced to one per distinct score. Scores are then cut into slices at
    approximate quantiles; running counts are taken within slices, and a slice's starting count
    comes from the short table of slice totals. Where the cuts fall affects balance only.
    """
    y = F.col(label).cast("int")
    scored = df.where(F.col(label).isNotNull() & F.col(score).isNotNull())
    groups = scored.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg")
    )
    shares = [i / SCORE_SLICES for i in range(1, SCORE_SLICES)]
    cuts = sorted(set(groups.approxQuantile("score", shares, 0.001)))  # a few hundred numbers
    splits = [-INF, *[c for c in cuts if abs(c) != INF], INF]
    sliced = Bucketizer(splits=splits, inputCol="score", outputCol="slice").transform(groups)
    totals = sliced.groupBy("slice").agg(F.sum("neg").alias("in_slice"))
    earlier = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(  # at most SCORE_SLICES rows
        "slice", F.coalesce(F.sum("in_slice").over(earlier), F.lit(0)).alias("start")
    )
    within = Window.partitionBy("slice").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    ranked = (
        sliced.withColumn("below", F.coalesce(F.sum("neg").over(within), F.lit(0)))
        .join(F.broadcast(starts), "slice")
    )
    won = F.col("pos") * (F.col("start") + F.col("below") + F.col("neg") / 2)
    sums = ranked.agg(F.sum(won).alias("won"), F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    pairs = F.col("p").cast("double") * F.col("n").cast("double")
    return sums.select((F.col("won") / F.nullif(pairs, F.lit(0.0))).alias("roc_auc"))


def evaluation(
    df: DataFrame,
    label: str = "riesgo",
    prediction: str = "prediction",
    score: str = "probabilidad_alto_riesgo",
) -> DataFrame:
    """All figures in one long table ``(metrica, clase, valor)``, ready for an audit log.

    Everything but the area under the curve follows from one scan for the four cells.
    """
    rows = ["'accuracy', null, (c00 + c11) / nullif(s, 0)"]
    for name, m in (("precision", "p"), ("recall", "r"), ("f1", "f")):
        macro, weighted = _averages(m)
        rows += [f"'{name}', '0', {m}0", f"'{name}', '1', {m}1",
                 f"'{name}', 'macro avg', {macro}", f"'{name}', 'weighted avg', {weighted}"]
    rows += [f"'support', '{k}', cast(s{k} as double)" for k in (0, 1)]
    rows += [f"'confusion', '{a}->{b}', cast(c{a}{b} as double)" for a in (0, 1) for b in (0, 1)]
    figures = _class_scores(_cells(df, label, prediction)).selectExpr(
        f"stack({len(rows)}, {', '.join(rows)}) as (metrica, clase, valor)"
    )
    auc = roc_auc(df, label, score).selectExpr("'roc_auc' as metrica", "string(null) as clase", "roc_auc as valor")
    return figures.unionByName(auc)
