"""Splits, self-organising maps, forests, boosted trees, stacking."""

from __future__ import annotations

import json
import math
from functools import reduce

from pyspark.ml.classification import GBTClassifier, MultilayerPerceptronClassifier, OneVsRest, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tasks import placed


class UntrainedClassifierError(Exception):
    """Prediction was asked of a classifier that has no model."""


def stratified(df: DataFrame, label: str, order: str, fraction: float) -> DataFrame:
    """``test`` is true for the first ``fraction`` of each label, by ``order`` (use a hash of the key for a shuffle)."""
    if not 0 <= fraction < 1:
        raise ValueError("the fraction must be at least 0 and under 1")
    counts = df.groupBy(label).agg(F.round(F.count("*") * fraction).alias("_most"))
    rows = placed(df, order, (label,)).join(F.broadcast(counts), label)  # a row for each label
    return rows.select(*df.columns, (F.col("place") < F.col("_most")).alias("test"))


def subsampled(df: DataFrame, label: str, order: str, size: int = 200) -> DataFrame:
    """About ``size`` rows, each label with its share of them (rounded), the first by ``order`` (use a hash of the key for a draw)."""
    whole = df.count()
    return stratified(df, label, order, min(size / whole, 1 - 1e-9)).where("test").drop("test") if whole > size else df


def folded(df: DataFrame, label: str, order: str, folds: int = 5) -> DataFrame:
    """``fold`` 0 to ``folds`` - 1, each with its share of every label."""
    return placed(df, order, (label,)).withColumn("fold", F.pmod("place", F.lit(folds)).cast("int")).drop("place")


def balanced(df: DataFrame, label: str) -> DataFrame:
    """``weight`` by which all labels weigh the same."""
    counts = df.groupBy(label).agg(F.count("*").alias("_n"))
    total = counts.agg(F.sum("_n").alias("_all"), F.count("*").alias("_k"))
    weighed = counts.crossJoin(F.broadcast(total)).select(label, (F.col("_all") / (F.col("_k") * F.col("_n"))).alias("weight"))  # one row
    return df.join(F.broadcast(weighed), label)  # a row for each label


def distance(a: Column, b: Column) -> Column:
    """Squared Euclidean distance of two arrays."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0).cast("double"), lambda s, x: s + x)


def best_units(points: DataFrame, units: DataFrame, vector: str = "vector", limit: int = 100_000) -> DataFrame:
    """Each row of ``points`` with the nearest unit (unit, weights) and its squared distance; of equals, the lowest unit.

    The map is sent as one row (at most ``limit`` numbers), and each point is compared in place.
    """
    rows = sorted(units.select("unit", "weights").collect())
    if sum(len(r[1]) for r in rows) > limit:
        raise ValueError("the map is too large to send to every task")
    table = points.sparkSession.createDataFrame([([(int(u), [float(x) for x in w]) for u, w in rows],)], "units array<struct<unit:int,weights:array<double>>>")
    joined = points.crossJoin(F.broadcast(table))  # one row
    best = F.array_min(F.transform("units", lambda u: F.struct(distance(F.col(vector).cast("array<double>"), u["weights"]).alias("distance"), u["unit"].alias("unit"))))
    return joined.withColumn("_best", best).select(*points.columns, F.col("_best.unit").alias("unit"), F.col("_best.distance").alias("distance"))


def train_map(points: DataFrame, width: int, size: int, vector: str = "vector", sweeps: int = 10, seed: int = 2187) -> DataFrame:
    """A line of ``width`` units trained by batch sweeps: (unit, weights).

    Each sweep assigns all points in parallel and moves every unit to the mean of the points near it on the map, by a
    Gaussian whose radius falls as R exp(-i ln R / sweeps). Sums of each unit are all that reach the driver.
    """
    import numpy as np

    spark = points.sparkSession
    rng = np.random.default_rng(seed)
    weights = rng.uniform(0, 1, (width, size))
    radius = float(width)
    grid = np.arange(width)
    for i in range(sweeps):
        units = spark.createDataFrame([(int(u), w.tolist()) for u, w in enumerate(weights)], "unit int, weights array<double>")
        hits = best_units(points, units, vector).withColumn("v", F.col(vector).cast("array<double>"))
        sums = hits.groupBy("unit").agg(F.count("*").alias("n"), F.array(*(F.sum(F.col("v")[k]) for k in range(size))).alias("s")).collect()  # a row for each unit
        r = max(radius * math.exp(-i * math.log(max(radius, 1.0001)) / sweeps), 0.5)
        near = np.exp(-((grid[:, None] - grid) ** 2) / (2 * r * r))
        top, below = np.zeros((width, size)), np.zeros(width)
        for u, n, s in sums:
            top += near[:, u : u + 1] * np.array(s)
            below += near[:, u] * n
        moved = below > 1e-12
        weights[moved] = top[moved] / below[moved, None]
    return spark.createDataFrame([(int(u), w.tolist()) for u, w in enumerate(weights)], "unit int, weights array<double>")


def train_grid(points: DataFrame, shape: tuple[int, int], size: int, vector: str = "vector", sweeps: int = 300, rate: float = 0.1, sample: int = 4000, seed: int = 2187) -> DataFrame:
    """A grid of units trained sample by sample: (unit, row, column, weights), unit being row * columns + column.

    In every sweep each point moves the units by rate * influence, where the influence is a Gaussian of the distance on the grid from its
    nearest unit, under one thousandth 0; radius and rate fall as exp(-sweep ln R / sweeps), R being the longer side. Steps depend
    on those before, so it works on the driver, on the ``sample`` points of the least hashes.
    """
    import numpy as np

    values = F.col(vector).cast("array<double>")
    rows = points.select(values.alias("v")).orderBy(F.xxhash64("v"), "v").limit(sample).collect()  # bounded
    data = np.array([r[0] for r in rows], float).reshape(-1, size)
    rng = np.random.default_rng(seed)
    weights = rng.uniform(0, 1, (shape[0] * shape[1], size))
    grid = np.stack(np.divmod(np.arange(len(weights)), shape[1]), 1)
    apart = ((grid[:, None] - grid) ** 2).sum(2)
    longest = max(*shape, 1.0001)
    for i in range(1, sweeps + 1):
        fall = math.exp(-i * math.log(longest) / sweeps)
        near = np.exp(-apart / (2 * max(longest * fall, 1e-3) ** 2)) * (rate * fall)
        near[near < rate * fall * 1e-3] = 0
        for x in data:
            best = int(((weights - x) ** 2).sum(1).argmin())
            weights += near[best][:, None] * (x - weights)
    return points.sparkSession.createDataFrame([(u, int(r), int(c), w.tolist()) for u, ((r, c), w) in enumerate(zip(grid, weights, strict=True))], "unit int, row int, column int, weights array<double>")


def save_map(units: DataFrame, path: str) -> None:
    """A text table: "rows,columns,numbers", and a line of each unit's weights, row by row. A map has one row if it has no grid."""
    if "row" not in units.columns:
        units = units.withColumns({"row": F.lit(0), "column": F.col("unit")})
    rows = units.orderBy("row", "column").select("row", "column", "weights").collect()  # a map is small
    shape = (max(r[0] for r in rows) + 1, max(r[1] for r in rows) + 1)
    lines = [f"{shape[0]},{shape[1]},{len(rows[0][2])}", *(",".join(repr(x) for x in r[2]) for r in rows)]
    spark = units.sparkSession
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def load_map(spark: SparkSession, path: str) -> DataFrame:
    """A text table of ``save_map``, or one file of that form: (unit, row, column, weights)."""
    text = spark.read.text(path, wholetext=True).first()[0]
    head, *lines = [line for line in text.split("\n") if line.strip()]
    rows, columns, size = (int(float(x)) for x in head.split(","))
    weights = [[float(x) for x in line.split(",")] for line in lines]
    if len(weights) != rows * columns or any(len(w) != size for w in weights):
        raise ValueError("the map's size is not what its first line says")
    return spark.createDataFrame([(u, u // columns, u % columns, w) for u, w in enumerate(weights)], "unit int, row int, column int, weights array<double>")


class Classifier:
    """A probabilistic classifier of feature columns; subclasses choose the estimator.

    Null and NaN features are set to ``missing``; where that is None they are refused. Labels are whole numbers from 0.
    ``settings`` names what the constructor takes beside features and classes, which is saved with the model.
    """

    missing: float | None = -1.0
    settings: tuple[str, ...] = ("seed", "missing")

    def __init__(self, features: list[str], classes: list[str], seed: int = 2187):
        self.features, self.classes, self.seed = features, classes, seed
        self.model = None

    def estimator(self):
        raise NotImplementedError

    def unknown(self) -> Column:
        """Whether a feature of the row is null or NaN."""
        return reduce(lambda a, b: a | b, (F.col(c).isNull() | F.isnan(F.col(c).cast("double")) for c in self.features), F.lit(False))

    def assembled(self, df: DataFrame) -> DataFrame:
        if self.missing is None and not df.where(self.unknown()).isEmpty():
            raise ValueError("features contain NaN")
        known = [F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(self.missing or 0.0)), F.lit(self.missing or 0.0)).alias(f"_f_{c}") for c in self.features]
        return VectorAssembler(inputCols=[f"_f_{c}" for c in self.features], outputCol="features").transform(df.select("*", *known)).drop(*(f"_f_{c}" for c in self.features))

    def fit(self, df: DataFrame, label: str = "label") -> Classifier:
        if self.model is None:
            data = balanced(self.assembled(df), label).withColumn("label", F.col(label).cast("double"))
            self.model = self.estimator().fit(data)
        return self

    def predict(self, df: DataFrame, key: str) -> DataFrame:
        """(key, class, prob): a row for each class, probabilities sum to 1."""
        if self.model is None:
            raise UntrainedClassifierError(type(self).__name__)
        out = self.model.transform(self.assembled(df))
        p = self.probabilities(out)
        names = F.array(*map(F.lit, self.classes))
        pairs = F.explode(F.arrays_zip(names.alias("class"), p.alias("prob"))).alias("r")
        return out.select(key, pairs).select(key, F.col("r.class").alias("class"), F.coalesce("r.prob", F.lit(0.0)).alias("prob"))

    def probabilities(self, out: DataFrame) -> Column:
        return F.slice(vector_to_array(F.col("probability")), 1, len(self.classes))

    def save(self, path: str) -> None:
        """The model and what it was made with, in a folder that every executor can read."""
        if self.model is None:
            raise UntrainedClassifierError(type(self).__name__)
        told = {"kind": type(self).__name__, "features": self.features, "classes": self.classes} | {k: getattr(self, k) for k in self.settings}
        spark = SparkSession.getActiveSession()
        spark.createDataFrame([(json.dumps(told),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/settings")
        self.write(f"{path}/model")

    def write(self, path: str) -> None:
        self.model.write().overwrite().save(path)

    def restore(self, path: str) -> None:
        self.model = DefaultParamsReader.loadParamsInstance(path, SparkSession.getActiveSession().sparkContext)

    # hooks of runs that subclasses may fill

    def test_complete(self, diagnostics: dict) -> None:
        """Called with the metrics of a test."""

    def importance_complete(self, importances: dict[str, float]) -> None:
        """Called with the importances of features."""


class Forest(Classifier):
    settings = ("trees", "depth", "subset", "seed", "missing")

    def __init__(self, features: list[str], classes: list[str], trees: int = 1000, depth: int = 15, subset: str = "sqrt", seed: int = 2187, missing: float | None = -1.0):
        super().__init__(features, classes, seed)
        self.trees, self.depth, self.subset, self.missing = trees, depth, subset, missing

    def estimator(self):
        return RandomForestClassifier(numTrees=self.trees, maxDepth=self.depth, featureSubsetStrategy=self.subset, weightCol="weight", seed=self.seed)

    def importances(self) -> dict[str, float]:
        if self.model is None:
            raise UntrainedClassifierError(type(self).__name__)
        return dict(zip(self.features, self.model.featureImportances.toArray().tolist(), strict=True))


class Boosted(Classifier):
    """One-vs-rest boosted trees; the raw margins pass a logistic and are scaled to sum to 1. ``gain`` is the least fall of impurity
    of a split, ``columns`` the share of features that a tree's splits are chosen from."""

    settings = ("rounds", "depth", "rate", "subsample", "gain", "columns", "seed", "missing")

    def __init__(self, features: list[str], classes: list[str], rounds: int = 500, depth: int = 6, rate: float = 0.1, subsample: float = 0.8, gain: float = 0.0, columns: float = 0.7, seed: int = 2187, missing: float | None = -1.0):
        super().__init__(features, classes, seed)
        self.rounds, self.depth, self.rate, self.subsample, self.gain, self.columns, self.missing = rounds, depth, rate, subsample, gain, columns, missing

    def estimator(self):
        tree = GBTClassifier(maxIter=self.rounds, maxDepth=self.depth, stepSize=self.rate, subsamplingRate=self.subsample, minInfoGain=self.gain, featureSubsetStrategy=str(float(self.columns)) if self.columns < 1 else "all", seed=self.seed)
        return OneVsRest(classifier=tree, weightCol="weight")

    def probabilities(self, out: DataFrame) -> Column:
        p = F.transform(vector_to_array(F.col("rawPrediction")), lambda x: 1 / (1 + F.exp(-x)))
        total = F.aggregate(p, F.lit(0.0), lambda a, x: a + x)
        return F.transform(p, lambda x: x / total)


class Perceptron(Classifier):
    """Layers over an array column."""

    settings = ("vector", "size", "hidden", "rounds", "seed", "missing")

    def __init__(self, vector: str, size: int, classes: list[str], hidden: int = 128, rounds: int = 50, seed: int = 2187):
        super().__init__([], classes, seed)
        self.vector, self.size, self.hidden, self.rounds = vector, size, hidden, rounds

    def assembled(self, df: DataFrame) -> DataFrame:
        return df.withColumn("features", array_to_vector(F.col(self.vector).cast("array<double>")))

    def estimator(self):
        return MultilayerPerceptronClassifier(layers=[self.size, self.hidden, len(self.classes)], maxIter=self.rounds, seed=self.seed)


def out_of_fold(make, df: DataFrame, key: str, label: str = "label", order: str | None = None, folds: int = 5) -> DataFrame:
    """Predictions of each row by a classifier of ``make()`` that was fitted without the row's fold: what a stack learns from."""
    dealt = folded(df, label, order or key, folds)
    parts = [make().fit(dealt.where(F.col("fold") != k), label).predict(dealt.where(F.col("fold") == k), key) for k in range(folds)]
    return reduce(DataFrame.unionByName, parts)


def load(path: str) -> Classifier:
    """A classifier that was saved: its kind is that of the class of this name among ``Classifier`` and what derives from it."""
    spark = SparkSession.getActiveSession()
    told = json.loads(spark.read.text(f"{path}/settings").first()[0])
    kinds = {}
    left = [Classifier]
    while left:
        kind = left.pop()
        kinds[kind.__name__] = kind
        left += kind.__subclasses__()
    if told["kind"] not in kinds:
        raise ValueError(f"unknown kind of classifier: {told['kind']}")
    kind = kinds[told.pop("kind")]
    out = kind.__new__(kind)
    out.__dict__.update(told)
    out.restore(f"{path}/model")
    return out
