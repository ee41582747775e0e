"""Training sets and runs: build a store of labelled targets, fit with folds, classify, stack, judge."""

from __future__ import annotations

import json
import os
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import labels as lb
from .operators import evaluation, learning, series, tasks
from .schemas import CLASSIFIERS, RESULT, TRAINING_SETS, Status
from .sources import lightcurves
from .sources import targets as target_files
from .store import Store

FOLDS = 5
#: Where training sets lie, unless told.
FOLDER = "LIGHTFOLD_TSETS"


def folder_of(key: str, folder: str | None = None) -> str:
    """The folder of a training set; an unknown key is an error."""
    if folder:
        return folder
    if key not in TRAINING_SETS:
        raise ValueError(f"unknown training set: {key}")
    return os.path.join(os.environ.get(FOLDER, os.path.join(os.path.dirname(__file__), "training_sets")), key)


def targets_of(spark: SparkSession, key: str, folder: str, level: str = "L1") -> DataFrame:
    """Targets with labels (starname, known_class, lightcurve, ...)."""
    base = key.split("-linfit")[0]
    if base.startswith("tdasim"):
        return target_files.read_simulations(spark, f"{folder}/Data_Batch_TDA4_r1.txt", f"{folder}/diagnostics.txt", level, base.partition("-")[2] or "corr")
    listed = target_files.read_ecsv(spark, f"{folder}/targets.ecsv")
    return listed if base.endswith("-instr") else target_files.without_class(listed)


def build_store(spark: SparkSession, path: str, targets: DataFrame, classes: list[str], folder: str | None = None) -> Store:
    """A store of labelled targets: ids are decoded from names, paths made up where there is none, labels checked.

    With the ``folder`` of the light curves, those that cannot be read are an error, and variance, rms_hour and ptp are computed where they are not told.
    """
    labels = lb.split(F.col("known_class"))
    known = F.array(*map(F.lit, classes))
    odd = F.array_except(labels, known)
    name = F.col("starname")
    made = targets.withColumns({
        "known_class": F.when(F.size(odd) == 0, F.array_join(labels, ";")).otherwise(F.raise_error(F.concat(F.lit("unknown class "), F.array_join(odd, ";")))),
        "starid": F.coalesce("starid", lb.star_id(name)),
        "lightcurve": F.coalesce("lightcurve", lb.star_path(F.element_at(labels, 1), name)),
    })
    numbered = tasks.placed(made.withColumn("_order", name), "_order").withColumn("priority", F.col("place") + 1).drop("place", "_order")
    return Store.create(spark, path, with_statistics(numbered, folder) if folder else numbered, classes=tuple(classes))


def with_statistics(targets: DataFrame, folder: str) -> DataFrame:
    """``targets`` (priority, lightcurve, variance, rms_hour, ptp) with the statistics that were null."""
    known = targets.columns
    targets = targets.select("*", *(F.lit(None).cast("double").alias(c) for c in ("variance", "rms_hour", "ptp") if c not in known))
    loaded = lightcurves.read_targets(targets.select("priority", "lightcurve"), folder)
    failed = loaded.where("error is not null").select("error").limit(3).collect()
    if failed:
        raise FileNotFoundError("; ".join(f["error"].splitlines()[-1] for f in failed))
    lc = loaded.withColumnRenamed("priority", "series_id")
    found = series.variance(lc).join(series.rms_timescale(lc), "series_id", "left").join(series.point_to_point(lc).select("series_id", "ptp"), "series_id", "left")
    found = found.select(F.col("series_id").alias("priority"), *(F.col(c).alias(f"_{c}") for c in ("variance", "rms", "ptp")))
    both = targets.join(found, "priority", "left")
    return both.withColumns({c: F.coalesce(c, f"_{o}") for c, o in (("variance", "variance"), ("rms_hour", "rms"), ("ptp", "ptp"))}).drop("_variance", "_rms", "_ptp")


def messages(predicted: DataFrame, classifier: str, tset: str, features: DataFrame | None = None) -> DataFrame:
    """(priority, class, prob) as result messages."""
    rows = predicted.groupBy("priority").agg(F.map_from_entries(F.collect_list(F.struct("class", "prob"))).alias("class_probs"))  # a class each
    empty = F.create_map().cast("map<string,double>")
    held = empty
    if features is not None:
        names = [c for c, kind in features.dtypes if c != "priority" and not kind.startswith("array")]
        pairs = F.create_map(*(x for c in names for x in (F.lit(c), F.col(c).cast("double"))))
        rows = rows.join(features.select("priority", (pairs if names else empty).alias("_f")), "priority", "left")
        held = F.coalesce(F.map_filter("_f", lambda _, v: v.isNotNull()), empty)
    out = rows.select("priority", F.lit(classifier).alias("classifier"), F.lit(tset).alias("tset"), F.lit(int(Status.OK)).alias("status"), F.lit(None).cast("double").alias("elaptime"), F.lit(None).cast("double").alias("worker_wait_time"), F.array().cast("array<string>").alias("errors"), "class_probs", empty.alias("features_common"), held.alias("features"))
    return out.select(*RESULT.names)


def run_stack(store: Store, bases: dict[str, tuple[DataFrame, Callable[[], learning.Classifier]]], labelled: DataFrame, classes: list[str], tset: str, meta: Callable[[list[str]], learning.Classifier], holdout: float = 0.0, save: Callable[[DataFrame], None] | None = None, folds: int = FOLDS) -> dict:
    """Fits base classifiers and the stack, and stores out-of-fold and stacked results.

    ``bases`` gives features (priority, ...) and a maker of each base classifier, ``labelled`` has priority and label
    (place in ``classes``). Returns the fitted classifiers, and with a ``holdout`` the metrics on it as JSON. ``save`` gets all result
    messages beside the store.
    """
    def keep(rows: DataFrame) -> None:
        store.save(rows)
        if save:
            save(rows)

    dealt = learning.stratified(labelled, "label", "priority", holdout).select("priority", "label", "test")
    fitted: dict = {}
    parts = []
    for name, (features, make) in bases.items():
        data = features.join(dealt, "priority")
        train, test = data.where("not test"), data.where("test")
        predicted = learning.out_of_fold(make, train, "priority", folds=folds)
        fitted[name] = make().fit(train)
        if holdout:
            predicted = predicted.unionByName(fitted[name].predict(test, "priority"))
        keep(messages(predicted, name, tset, features))
        parts.append(store.read("results", name))
    wide = tasks.wide(reduce(DataFrame.unionByName, parts), list(bases), classes)
    wide = tasks.without_empty_columns(wide, ["priority"])
    names = [c for c in wide.columns if c != "priority"]
    missing = [b for b in bases if not any(c.startswith(f"{b}_") for c in names)]
    if missing:
        raise ValueError(f"no probabilities of {missing}")
    data = wide.join(dealt, "priority")
    fitted["meta"] = meta(names).fit(data.where("not test"))
    stacked = fitted["meta"].predict(data, "priority")
    keep(messages(stacked, "meta", tset))
    if holdout:
        truth = dealt.where("test").select("priority", F.element_at(F.array(*map(F.lit, classes)), F.col("label").cast("int") + 1).alias("truth"))
        judged = stacked.join(truth, "priority")
        pairs = tasks.best_class(judged.select("priority", "class", "prob")).join(truth, "priority").select("truth", F.col("class").alias("predicted"))
        scored = judged.select("class", F.col("prob").alias("score"), (F.col("class") == F.col("truth")).alias("positive"))
        fitted["diagnostics"] = json.loads(evaluation.diagnostics(pairs, scored, classes, tset, "meta", "L1").first()[0])
        fitted["meta"].test_complete(fitted["diagnostics"])
    for model in fitted.values():
        if isinstance(model, learning.Forest):
            model.importance_complete(model.importances())
    return fitted


def thresholds_of(diagnostics: dict) -> dict[str, float]:
    return {r["class"]: r["threshold"] for r in diagnostics["roc_best_threshold"]}


def classifiers(names: str | None = None) -> tuple[str, ...]:
    """Known classifiers, or one by name; an unknown name is an error."""
    if names is None:
        return CLASSIFIERS
    if names not in CLASSIFIERS:
        raise ValueError(f"unknown classifier: {names}")
    return (names,)
