"""Evaluation of predictions: confusion, precision and recall, ROC curves, thresholds."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tasks import placed, ranged


def confusion(pairs: DataFrame, classes: list[str]) -> DataFrame:
    """(truth, predicted, n, share) for all pairs of ``classes``; share is of the truth's row."""
    names = F.array(*map(F.lit, classes))
    one = pairs.sparkSession.range(1)
    every = one.select(F.explode(names).alias("truth")).withColumn("predicted", F.explode(names))
    counts = pairs.groupBy("truth", "predicted").agg(F.count("*").alias("n"))
    full = every.join(counts, ["truth", "predicted"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return full.withColumn("share", F.coalesce(F.try_divide("n", F.sum("n").over(Window.partitionBy("truth"))), F.lit(0.0)))


def report(pairs: DataFrame, classes: list[str]) -> DataFrame:
    """(class, precision, recall, f1, support) of each class, and of accuracy, macro and weighted means."""
    c = confusion(pairs, classes)
    rows = c.groupBy(F.col("truth").alias("class")).agg(F.sum("n").alias("support"), F.sum(F.when(F.col("truth") == F.col("predicted"), F.col("n")).otherwise(0)).alias("hit"))
    cols = c.groupBy(F.col("predicted").alias("class")).agg(F.sum("n").alias("told"))
    zero = F.lit(0.0)
    own = rows.join(cols, "class").withColumns({"precision": F.coalesce(F.try_divide("hit", "told"), zero), "recall": F.coalesce(F.try_divide("hit", "support"), zero)})
    own = own.withColumn("f1", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), zero))
    each = own.select("class", "precision", "recall", "f1", "support")
    total = F.sum("support")
    accuracy = F.try_divide(F.sum("hit"), total)
    weighted = [F.try_divide(F.sum(F.col(m) * F.col("support")), total).alias(m) for m in ("precision", "recall", "f1")]
    whole = own.agg(F.lit("accuracy").alias("class"), accuracy.alias("precision"), accuracy.alias("recall"), accuracy.alias("f1"), total.alias("support"))
    macro = own.agg(F.lit("macro avg").alias("class"), *(F.avg(m).alias(m) for m in ("precision", "recall", "f1")), total.alias("support"))
    return each.unionByName(whole).unionByName(macro).unionByName(own.agg(F.lit("weighted avg").alias("class"), *weighted, total.alias("support")))


def roc(scored: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(…, threshold, fpr, tpr) from (score, positive), a point for each distinct score, by falling threshold.

    Scores are grouped first. Running sums are taken within ranges of scores and the sums of the ranges
    before are added, so that no task holds all scores, or all of a class. The curve starts at (0, 0) with a threshold of one more than the
    highest score.
    """
    by = by or []
    positive = F.col("positive").cast("int")
    ties = scored.groupBy(*by, "score").agg(F.sum(positive).alias("p"), F.sum(1 - positive).alias("n"))
    parted = ties.withColumn("_part", -ranged(ties, "score"))
    parts = parted.groupBy(*by, "_part").agg(F.sum("p").alias("_p"), F.sum("n").alias("_n"))
    group = Window.partitionBy(*by).orderBy("_part")  # a row for each range
    before, every = group.rowsBetween(Window.unboundedPreceding, -1), group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = parts.select(*by, "_part", *(F.coalesce(F.sum(f"_{c}").over(before), F.lit(0)).alias(f"_{c}") for c in "pn"), *(F.sum(f"_{c}").over(every).alias(f"all_{c}") for c in "pn"))
    upto = Window.partitionBy(*by, "_part").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    own = parted.select(*by, "_part", "score", *(F.sum(c).over(upto).alias(c) for c in "pn")).join(offsets, [*by, "_part"])
    sums = own.select(*by, "score", *((F.col(c) + F.col(f"_{c}")).alias(c) for c in "pn"), "all_p", "all_n")
    points = sums.select(*by, F.col("score").alias("threshold"), F.try_divide("n", "all_n").alias("fpr"), F.try_divide("p", "all_p").alias("tpr"))
    start = scored.groupBy(*by).agg((F.max("score") + 1).alias("threshold")).select(*by, "threshold", F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return points.unionByName(start)


def auc(curve: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Area under ``roc``'s curve, by trapezoids."""
    by = by or []
    rows = placed(curve.withColumn("_order", -F.col("threshold")), "_order", tuple(by)).select(*by, "place", "fpr", "tpr")
    steps = rows.join(rows.select(*by, (F.col("place") + 1).alias("place"), F.col("fpr").alias("f0"), F.col("tpr").alias("t0")), [*by, "place"])
    return steps.withColumn("area", (F.col("fpr") - F.col("f0")) * (F.col("tpr") + F.col("t0")) / 2).groupBy(*by).agg(F.sum("area").alias("auc"))


def micro(scored: DataFrame) -> DataFrame:
    """The ROC curve of all pairs of an object and a class taken together; ``scored`` has a row for each."""
    return roc(scored.select("score", "positive"))


def best_threshold(curve: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The threshold of greatest tpr - fpr; of equals, the highest. A class that never separates keeps one over all scores."""
    by = by or []
    gain = F.struct((F.col("tpr") - F.col("fpr")).alias("gain"), F.col("threshold"))
    return curve.groupBy(*by).agg(F.max(gain).alias("b")).select(*by, F.col("b.threshold").alias("threshold"))


def diagnostics(pairs: DataFrame, scored: DataFrame, classes: list[str], tset: str, classifier: str, level: str) -> DataFrame:
    """One row with the document of all metrics as JSON; ``scored`` has class, score and positive."""
    curve = roc(scored, ["class"])
    parts = {
        "report": report(pairs, classes).select(F.struct("class", "precision", "recall", "f1", "support").alias("r")),
        "confusion_matrix": confusion(pairs, classes).select(F.struct("truth", "predicted", "n").alias("r")),
        "roc_auc": auc(curve, ["class"]).unionByName(auc(micro(scored)).select(F.lit("micro").alias("class"), "auc")).select(F.struct("class", "auc").alias("r")),
        "roc_best_threshold": best_threshold(curve, ["class"]).select(F.struct("class", "threshold").alias("r")),
    }
    out = pairs.sparkSession.range(1).select(F.lit(tset).alias("tset"), F.lit(classifier).alias("classifier"), F.lit(level).alias("level"), F.array(*map(F.lit, classes)).alias("classes"))
    for name, rows in parts.items():
        out = out.crossJoin(rows.agg(F.sort_array(F.collect_list("r")).alias(name)))  # one row each, of a few numbers for each class
    return out.select(F.to_json(F.struct("*")).alias("document"))
