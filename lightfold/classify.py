"""Runs from files to classes: light curves, features, base classifiers, the stack, final classes; and their training.

A run is one job for each step over all pending targets, not a loop over targets; a target that fails has an ERROR row with
the reason, and the others go on.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import training
from .functions import labels as lb
from .functions.numbers import finite
from .operators import features as fs
from .operators import learning, network, prewhiten, series, spectrum, tasks
from .schemas import RESULT, Status
from .sources import lightcurves
from .store import DiagnosticsNotAvailableError, Store

PEAKS, HARMONICS = 6, 5
NAMES = {"rfgc": fs.RFGC, "xgb": fs.XGB, "sortinghat": fs.SORTINGHAT}
#: Settings of the classifiers in training, and of the map of shapes (units, sweeps).
SIZES: dict[str, dict] = {
    "rfgc": {"trees": 1000, "depth": 15, "subset": "4"},
    "sortinghat": {"trees": 1000, "depth": 15},
    "xgb": {"rounds": 500, "depth": 6},
    "slosh": {"hidden": 128, "epochs": 50, "bins": 128},
    "meta": {"trees": 100, "depth": 7},
    "map": {"width": 400, "sweeps": 300},
}


class Work:
    """Tables of a run in a folder of the store, deleted at its end."""

    def __init__(self, store: Store):
        self.store, self.path = store, f"{store.path}/_work-{uuid.uuid4().hex}"

    def __enter__(self) -> Work:
        return self

    def __exit__(self, *_) -> None:
        self.store._fs(self.path).delete(self.store._p(self.path), True)

    def keep(self, df: DataFrame) -> DataFrame:
        path = f"{self.path}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)


@dataclass
class Models:
    """Fitted classifiers by name, the map of shapes, and the thresholds of final classes."""

    fitted: dict[str, learning.Classifier] = field(default_factory=dict)
    units: DataFrame | None = None
    diagnostics: dict | None = None
    linfit: bool = False
    bins: int = 16

    def save(self, spark: SparkSession, folder: str) -> None:
        for name, model in self.fitted.items():
            model.save(f"{folder}/{name}")
        if self.units is not None:
            learning.save_map(self.units, f"{folder}/map")
        told = json.dumps({"names": list(self.fitted), "linfit": self.linfit, "bins": self.bins, "diagnostics": self.diagnostics})
        spark.createDataFrame([(told,)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/run")

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> Models:
        told = json.loads(spark.read.text(f"{folder}/run").first()[0])
        out = cls({n: learning.load(f"{folder}/{n}") for n in told["names"]}, None, told["diagnostics"], told["linfit"], told["bins"])
        if "rfgc" in told["names"]:
            out.units = learning.load_map(spark, f"{folder}/map")
        return out


@dataclass
class Extracted:
    """What all feature sets of a run share, as written tables."""

    lc: DataFrame
    flat: DataFrame
    line: DataFrame | None
    power: DataFrame
    frequencies: DataFrame
    common: DataFrame

    def of(self, name: str, units: DataFrame | None = None, bins: int = 16) -> DataFrame:
        """(priority, ...) of a classifier's features."""
        if name == "rfgc":
            out = fs.rfgc(self.flat, self.power, self.frequencies, units, line=self.line)
        elif name == "xgb":
            out = fs.xgb(self.flat, self.frequencies)
        elif name == "sortinghat":
            out = fs.sortinghat(self.flat, self.power, self.frequencies)
        elif name == "slosh":
            out = fs.pooled_image(self.power, bins)
        else:
            raise ValueError(f"no features are known for {name}")
        return out.withColumnRenamed("series_id", "priority")


def extracted(points: DataFrame, targets: DataFrame, work: Work, linfit: bool = False) -> Extracted:
    """Spectra, frequencies and common features of ``points`` (series_id, t, flux, flux_err, quality).

    With ``linfit`` a straight line weighted by errors is taken off first. variance, rms_hour and ptp of ``targets`` (by
    priority) are taken where they are known, else computed from the series as it was.
    """
    line = work.keep(series.trend(points)) if linfit else None
    flat = work.keep(series.detrended(series.clean(points))) if linfit else points
    power = work.keep(spectrum.periodogram(flat, None))
    found = work.keep(prewhiten.prewhitened(flat, peaks=PEAKS, harmonics=HARMONICS, refit=5, deviation=None))
    computed = fs.common(points, power).withColumnRenamed("series_id", "priority")
    given = targets.select("priority", "tmag", *(F.col(c).cast("double").alias(f"_{c}") for c in ("variance", "rms_hour", "ptp")))
    both = computed.join(given, "priority", "left")
    own = {c: F.when(finite(F.col(f"_{c}")), F.col(f"_{c}")).otherwise(F.col(c)) for c in ("variance", "rms_hour", "ptp")}
    table = spectrum.table_to_columns(found, PEAKS, HARMONICS).withColumnRenamed("series_id", "priority")
    common = both.select("priority", *(own.get(c, F.col(c)).alias(c) for c in fs.COMMON)).join(table, "priority", "left")
    return Extracted(points, flat, line, power, found, work.keep(common))


def _map(names: list[str]) -> Column:
    """The known values of the columns ``names``."""
    return F.map_filter(F.create_map(*(x for c in names for x in (F.lit(c), F.col(c).cast("double")))), lambda _, v: v.isNotNull())


def outcomes(keys: DataFrame, predicted: DataFrame, failures: DataFrame, classifier: str, tset: str, common: DataFrame | None = None, features: DataFrame | None = None, seconds: float = 0.0) -> DataFrame:
    """A result message for each of ``keys`` (priority): OK with probabilities, or ERROR with what ``failures`` (priority, error) tells."""
    rows = predicted.groupBy("priority").agg(F.map_from_entries(F.collect_list(F.struct("class", "prob"))).alias("class_probs"))  # a class each
    out = keys.select("priority").join(rows, "priority", "left").join(failures.groupBy("priority").agg(F.first("error").alias("error")), "priority", "left")
    for name, held in (("features_common", common), ("features", features)):
        names = [c for c, kind in held.dtypes if c != "priority" and not kind.startswith("array")] if held is not None else []
        if common is not None and name == "features":
            names = [c for c in names if c not in common.columns]
        out = out.join(held.select("priority", _map(names).alias(name)), "priority", "left") if names else out.withColumn(name, F.create_map().cast("map<string,double>"))
    good = F.col("class_probs").isNotNull()
    return out.select(
        "priority", F.lit(classifier).alias("classifier"), F.lit(tset).alias("tset"), F.when(good, int(Status.OK)).otherwise(int(Status.ERROR)).alias("status"), F.lit(float(seconds)).alias("elaptime"), F.lit(None).cast("double").alias("worker_wait_time"),
        F.when(good, F.array().cast("array<string>")).otherwise(F.array(F.coalesce("error", F.lit("no features")))).alias("errors"), F.coalesce("class_probs", F.create_map().cast("map<string,double>")).alias("class_probs"),
        *(F.coalesce(c, F.create_map().cast("map<string,double>")).alias(c) for c in ("features_common", "features")),
    ).select(*RESULT.names)


def _complete(store: Store, name: str, wanted: list[str]) -> DataFrame | None:
    """Cached features of a classifier, of targets that have all that are wanted."""
    if not wanted or not store.has("features", name) or not store.has("features", "common"):
        return None
    held = tasks.coalesced(store.read("features", name).select("priority"), store.read("features", "common"), store.read("features", name))
    if any(c not in held.columns for c in wanted):
        return None
    known = held.select("priority", *wanted)
    return known.where(" and ".join(f"`{c}` is not null and not isnan(`{c}`)" for c in wanted))


def _base(store: Store, models: Models, names: list[str], folder: str, tset: str, chunk: int | None, truncate: bool) -> bool:
    """Classifies pending targets, the first ``chunk`` or all; false if there are none."""
    todo = store.candidates()
    with Work(store) as work:
        open_ = tasks.pending(todo, store.read("diagnostics"), tuple(names))
        if chunk:
            open_ = open_.join(open_.select("priority").distinct().orderBy("priority").limit(chunk), "priority", "left_semi")
        keys = work.keep(open_)
        if keys.isEmpty():
            return False
        began = time.time()
        store.start(keys)
        cached = {n: work.keep(c.join(keys.where(F.col("classifier") == n), "priority", "left_semi")) for n in names if (c := _complete(store, n, models.fitted[n].features)) is not None}
        needed = keys
        for n, held in cached.items():
            needed = needed.join(held.select("priority", F.lit(n).alias("classifier")), ["priority", "classifier"], "left_anti")
        targets = work.keep(todo.join(needed.select("priority").distinct(), "priority", "left_semi"))
        loaded = work.keep(lightcurves.read_targets(targets.select("priority", "lightcurve"), folder, truncate))
        failures = loaded.where("error is not null").select("priority", "error")
        points = loaded.where("error is null").select(F.col("priority").alias("series_id"), "t", "flux", "flux_err", "quality")
        shared = extracted(points, targets, work, models.linfit)
        for n in names:
            own = keys.where(F.col("classifier") == n).select("priority")
            features = shared.of(n, models.units, models.bins)
            if n in cached:
                features = features.join(cached[n].select("priority"), "priority", "left_anti").select(*cached[n].columns).unionByName(cached[n])
            features = work.keep(features.join(own, "priority", "left_semi"))
            predicted = work.keep(models.fitted[n].predict(features, "priority"))
            seconds = (time.time() - began) / max(1, own.count())
            store.save(work.keep(outcomes(own, predicted, failures, n, tset, shared.common, features, seconds)))
        return True


def _stack(store: Store, models: Models, tset: str) -> None:
    """Classifies targets that all base classifiers have ended; one whose probabilities are not all known is an ERROR."""
    todo, done = store.candidates(), store.read("diagnostics")
    with Work(store) as work:
        ready = work.keep(tasks.meta_ready(todo, done).select("priority", F.lit("meta").alias("classifier")))
        if ready.isEmpty():
            return
        store.start(ready)
        model = models.fitted["meta"]
        good = tasks.ok_results(store.read("results"), done).join(ready, "priority", "left_semi")
        bases = [n for n in models.fitted if n != "meta"]
        wide = ready.select("priority").join(tasks.wide(good, bases, list(store.classes)), "priority", "left")
        wide = work.keep(wide.select("priority", *model.features, model.unknown().alias("_unknown")))
        predicted = work.keep(model.predict(wide.where("not _unknown").drop("_unknown"), "priority"))
        failures = wide.where("_unknown").select("priority", F.lit("features contain NaN").alias("error"))
        store.save(work.keep(outcomes(ready, predicted, failures, "meta", tset)))


def classify(store: Store, models: Models, folder: str, tset: str, classifier: str | None = None, chunk: int | None = None, truncate: bool = False) -> None:
    """All pending targets of ``store`` by all classifiers or one, the stack last, then final classes.

    ``folder`` holds the light curves that the store names. With ``chunk`` so many targets are taken at a time, and saved before the next.
    """
    names = [n for n in training.classifiers(classifier) if n != "meta"]
    missing = [n for n in training.classifiers(classifier) if n not in models.fitted]
    if missing:
        raise learning.UntrainedClassifierError(", ".join(missing))
    store.reset_started()  # of a run that was cut off; there is one writer at a time
    while names and _base(store, models, names, folder, tset, chunk, truncate):
        if not chunk:
            break
    if classifier in (None, "meta"):
        _stack(store, models, tset)
        if models.diagnostics is None:
            raise DiagnosticsNotAvailableError("no thresholds")
        store.assign_final_class(training.thresholds_of(models.diagnostics))


def train(store: Store, folder: str, tset: str, holdout: float = 0.2, linfit: bool = False, truncate: bool = False, sizes: dict[str, dict] | None = None, save: Callable[[DataFrame], None] | None = None, folds: int = training.FOLDS) -> Models:
    """Fits all classifiers on the labelled targets of ``store``: bases with out-of-fold results for the stack, the stack, and
    metrics on a share of ``holdout``. ``sizes`` replaces ``SIZES``; ``save`` gets all result messages in place of the store."""
    if not 0 <= holdout < 1:
        raise ValueError("the holdout must be at least 0 and under 1")
    sizes = {**SIZES, **(sizes or {})}
    classes = list(store.classes)
    bins = sizes["slosh"].get("bins", 128)
    with Work(store) as work:
        names = F.array(*map(F.lit, classes))
        own = store.read("todolist").select("priority", lb.single(lb.split(F.col("known_class"))).alias("name"))
        labelled = work.keep(own.where(F.array_contains(names, F.col("name"))).select("priority", (F.array_position(names, F.col("name")) - 1).cast("int").alias("label")))
        targets = work.keep(store.candidates().join(labelled, "priority", "left_semi"))
        loaded = work.keep(lightcurves.read_targets(targets.select("priority", "lightcurve"), folder, truncate))
        failed = loaded.where("error is not null").select("priority", "error").limit(3).collect()
        if failed:
            raise ValueError(f"light curves cannot be read: {[tuple(f) for f in failed]}")
        points = loaded.select(F.col("priority").alias("series_id"), "t", "flux", "flux_err", "quality")
        shared = extracted(points, targets, work, linfit)
        shapes = work.keep(fs.shapes(shared.flat, shared.frequencies))
        units = learning.train_grid(shapes, (1, sizes["map"]["width"]), 64, sweeps=sizes["map"]["sweeps"])
        columns = {**NAMES, "rfgc": (*fs.RFGC, "detrend_coeff_norm") if linfit else fs.RFGC}
        makers = {
            "rfgc": lambda: learning.Forest(list(columns["rfgc"]), classes, **sizes["rfgc"]),
            "slosh": lambda: network.ImageNetwork("vector", bins, classes, **{k: v for k, v in sizes["slosh"].items() if k != "bins"}),
            "xgb": lambda: learning.Boosted(list(columns["xgb"]), classes, **sizes["xgb"]),
            "sortinghat": lambda: learning.Forest(list(columns["sortinghat"]), classes, **sizes["sortinghat"]),
        }
        bases = {n: (work.keep(shared.of(n, units, bins)), make) for n, make in makers.items()}
        fitted = training.run_stack(store, bases, labelled, classes, tset, lambda f: learning.Forest(f, classes, **sizes["meta"], missing=None), holdout, save, folds)
    diagnostics = fitted.pop("diagnostics", None)
    return Models(fitted, units, diagnostics, linfit, bins)
