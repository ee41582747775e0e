"""The work queue as joins: candidates, pending work, gating, results, final classes.

Tables are those of ``schemas.TABLES``. Work is anti-joined, never looped over; a chunk of tasks is a
sorted limit, which keeps only the chunk in each task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import CLASSIFIERS, Status

BASE = tuple(c for c in CLASSIFIERS if c != "meta")


def candidates(todolist: DataFrame, diagnostics_corr: DataFrame, validation: DataFrame | None = None) -> DataFrame:
    """Targets whose correction is OK or has a warning, and that are approved where there is a validation table."""
    todo = todolist.where(F.col("corr_status").isin(int(Status.OK), int(Status.WARNING))).select("priority", "starid", "tmag")
    out = todo.join(diagnostics_corr.select("priority", "lightcurve", "variance", "rms_hour", "ptp"), "priority")
    return out.join(validation.where("approved").select("priority"), "priority", "left_semi") if validation is not None else out


def every(targets: DataFrame, classifiers: tuple[str, ...] = CLASSIFIERS) -> DataFrame:
    """(priority, classifier) for each target and classifier."""
    return targets.select("priority", F.explode(F.array(*map(F.lit, classifiers))).alias("classifier"))


def pending(targets: DataFrame, diagnostics: DataFrame, classifiers: tuple[str, ...] = CLASSIFIERS) -> DataFrame:
    """(priority, classifier) without a row of diagnostics, started ones included."""
    return every(targets, classifiers).join(diagnostics.select("priority", "classifier"), ["priority", "classifier"], "left_anti")


def count_tasks(targets: DataFrame, diagnostics: DataFrame, classifier: str | None = None) -> DataFrame:
    return pending(targets, diagnostics, (classifier,) if classifier else CLASSIFIERS).agg(F.count("*").alias("tasks"))


def meta_ready(targets: DataFrame, diagnostics: DataFrame) -> DataFrame:
    """Targets without a row of the stacking classifier that all others have ended, whatever their status."""
    ended = diagnostics.where(F.col("classifier").isin(*BASE) & (F.col("status") != int(Status.STARTED))).groupBy("priority").agg(F.countDistinct("classifier").alias("ended")).where(F.col("ended") == len(BASE))
    done = diagnostics.where(F.col("classifier") == "meta").select("priority")
    return targets.join(ended.select("priority"), "priority", "left_semi").join(done, "priority", "left_anti")


def next_chunk(targets: DataFrame, diagnostics: DataFrame, classifier: str | None = None, priority: int | None = None, chunk: int = 10) -> DataFrame:
    """The tasks of least priority of a classifier, or one target's."""
    if classifier is None and priority is None:
        raise ValueError("a classifier or a priority is needed")
    wanted: list[Column] = [] if priority is None else [F.col("priority") == priority]
    own = targets.where(reduce(lambda a, b: a & b, wanted)) if wanted else targets
    if classifier == "meta":
        own = meta_ready(own, diagnostics)
    elif classifier:
        own = own.join(diagnostics.where(F.col("classifier") == classifier).select("priority"), "priority", "left_anti")
    return own.orderBy("priority").limit(chunk)


def lowest(targets: DataFrame, diagnostics: DataFrame, classifiers: tuple[str, ...] = BASE) -> DataFrame:
    """The classifier whose next task has the least priority; of equals, the first by name."""
    each = pending(targets, diagnostics, classifiers).groupBy("classifier").agg(F.min("priority").alias("priority"))
    return each.orderBy("priority", "classifier").limit(1)


def ok_results(results: DataFrame, diagnostics: DataFrame) -> DataFrame:
    """Probabilities of base classifiers that ended well."""
    ok = diagnostics.where((F.col("status") == int(Status.OK)) & (F.col("classifier") != "meta")).select("priority", "classifier")
    return results.join(ok, ["priority", "classifier"]).select("priority", "classifier", "class", "prob")


def with_outcome(targets: DataFrame, diagnostics: DataFrame, classifier: str) -> DataFrame:
    """All targets with the status that a classifier gave them, null where there is none."""
    own = diagnostics.where(F.col("classifier") == classifier).select("priority", "status")
    return targets.select("priority").join(own, "priority", "left")


def nested(results: DataFrame) -> DataFrame:
    """One row for each target: its probabilities as an array by classifier and class."""
    row = F.struct("classifier", "class", "prob")
    return results.groupBy("priority").agg(F.sort_array(F.collect_list(row)).alias("other_classifiers"))


def wide(results: DataFrame, classifiers: list[str], classes: list[str], by: str = "priority") -> DataFrame:
    """A column for each classifier and class, in product order; missing ones are null."""
    columns = [F.max(F.when((F.col("classifier") == c) & (F.col("class") == k), F.col("prob"))).alias(f"{c}_{k}") for c in classifiers for k in classes]
    return results.groupBy(by).agg(*columns)


def without_empty_columns(df: DataFrame, keep: list[str]) -> DataFrame:
    """Less the columns that are null or NaN throughout."""
    others = [c for c in df.columns if c not in keep]
    counts = df.agg(*(F.count(F.when(F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")), 1)).alias(c) for c in others)).first()
    return df.select(*keep, *(c for c in others if counts[c]))


def upserted(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """All of ``new``, and what ``existing`` has under other keys."""
    return existing.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def coalesced(base: DataFrame, *layers: DataFrame, key: str = "priority") -> DataFrame:
    """Features of several tables: a later table's value wins where it is known."""
    out = base
    for n, layer in enumerate(layers):
        names = [c for c in layer.columns if c != key]
        out = out.join(layer.select(key, *(F.col(c).alias(f"_{n}_{c}") for c in names)), key, "left")
        for c in names:
            new = F.when(~F.isnan(F.col(f"_{n}_{c}")), F.col(f"_{n}_{c}"))
            out = out.withColumn(c, F.coalesce(new, F.col(c)) if c in out.columns else new)
        out = out.drop(*(f"_{n}_{c}" for c in names))
    return out


def zipped(left: DataFrame, right: DataFrame, left_order: str, right_order: str) -> DataFrame:
    """Rows side by side by their place in order. Places come from counts of the rows of each range, not from one task."""
    return placed(left, left_order).join(placed(right, right_order), "place").drop("place")


def ranged(df: DataFrame, order: str, wanted: int = 128) -> Column:
    """The number of a range of ``order`` that a row's value lies in, from 0 up: a function of the value alone.

    Borders come from about 4096 values, those whose hash a number divides, so reruns agree.
    """
    step = max(1, df.count() // 4096)
    some = df.select(order).where(F.col(order).isNotNull() & (F.pmod(F.xxhash64(order), F.lit(step)) == 0)).distinct()
    values = sorted(r[0] for r in some.limit(100_000).collect())
    borders = values[:: max(1, len(values) // wanted)][1:]
    return F.size(F.filter(F.array(*map(F.lit, borders)), lambda b: b <= F.col(order))) if borders else F.lit(0)


def placed(df: DataFrame, order: str, by: tuple[str, ...] = ()) -> DataFrame:
    """``place`` of each row by ``order``, from 0, among the rows of equal ``by``. Rows are numbered within ranges of ``order``; only
    counts of ranges are brought together, so a group that holds most rows is spread as well."""
    parted = df.withColumn("_part", ranged(df, order))
    counts = parted.groupBy(*by, "_part").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    before = counts.select(*by, "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy(*by, "_part").orderBy(order)) - 1
    on = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in (*by, "_part")]
    both = parted.withColumn("_own", own).alias("l").join(F.broadcast(before).alias("r"), on)
    return both.select("l.*", (F.col("r._before") + F.col("l._own")).alias("place")).drop("_own", "_part")


def best_class(results: DataFrame) -> DataFrame:
    """The most probable class of each target; of equals, the first by name."""
    top = F.struct((-F.col("prob")).alias("p"), F.col("class"))
    return results.groupBy("priority").agg(F.min(top).alias("b")).select("priority", F.col("b.class").alias("class"), (-F.col("b.p")).alias("prob"))


def final_class(results: DataFrame, thresholds: DataFrame) -> DataFrame:
    """The best class where it reaches its threshold (class, threshold), else UNKNOWN."""
    best = best_class(results).join(F.broadcast(thresholds), "class", "left")
    return best.select("priority", F.when(F.col("prob") >= F.col("threshold"), F.col("class")).otherwise("UNKNOWN").alias("final_class"), "prob")
