"""The store: work queue, results and cached features as Parquet tables in a folder.

Each table is a folder of versions; the newest that was written to its end (its _SUCCESS file exists) counts, so
readers see a table before or after a change, never between. Diagnostics, results and features are kept by
classifier; a change of them writes the rows that changed alone, as a step on the version before, and of several steps with rows of a target
the last counts. ``STEPS`` steps are made one version, so a row is written again once in so many changes. One writer at a time.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import tasks
from .schemas import CLASSIFIERS, TABLES, Level1, Status

PARTED = ("diagnostics", "results", "features")
#: Steps after which a part is written anew.
STEPS = 20


class DiagnosticsNotAvailableError(Exception):
    """Thresholds of a classifier are not known."""


class Store:
    def __init__(self, spark: SparkSession, path: str, classes: tuple[str, ...] = tuple(c.name for c in Level1), overwrite: bool = False, cached: bool = False, backup: str | None = None, backup_interval: int = 10_000):
        """``cached`` tables stay in memory until they change or ``close``. With ``backup`` the store is copied there after every ``backup_interval`` results, and at ``close``."""
        self.spark, self.path, self.classes, self.cached = spark, path.rstrip("/"), classes, cached
        self.backup_path, self.backup_interval, self._since, self._kept = backup, backup_interval, 0, {}
        if not self.has("todolist") and not self._fs(self.path).exists(self._p(self.path)):
            raise FileNotFoundError(path)
        if overwrite:  # features stay
            for name in ("settings", "diagnostics", "results"):
                self.drop(name)

    # files

    def _p(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self, path: str):
        return self._p(path).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _versions(self, where: str) -> list[str]:
        """Finished folders that make up a table, in order: the last version (v) and the steps (d) after it."""
        fs = self._fs(where)
        if not fs.exists(self._p(where)):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(self._p(where))]
        done = sorted((n for n in names if re.fullmatch(r"[vd]\d+", n) and fs.exists(self._p(f"{where}/{n}/_SUCCESS"))), key=lambda n: int(n[1:]))
        whole = [i for i, n in enumerate(done) if n[0] == "v"]
        return done[whole[-1] :] if whole else done

    def _where(self, name: str, part: str | None) -> str:
        return f"{self.path}/{name}/{part}" if part else f"{self.path}/{name}"

    def has(self, name: str, part: str | None = None) -> bool:
        return bool(self._versions(self._where(name, part)))

    def parts(self, name: str) -> list[str]:
        fs, where = self._fs(self.path), f"{self.path}/{name}"
        if not fs.exists(self._p(where)):
            return []
        return sorted(n for n in (s.getPath().getName() for s in fs.listStatus(self._p(where))) if self.has(name, n))

    def read(self, name: str, part: str | None = None) -> DataFrame:
        """A table, or an empty one of its type."""
        if name in PARTED and part is None:
            found = [self.read(name, c) for c in self.parts(name)]
            return reduce(DataFrame.unionByName, found) if found else self.spark.createDataFrame([], TABLES[name])
        versions = self._versions(self._where(name, part))
        if not versions:
            return self.spark.createDataFrame([], TABLES[name])
        if (name, part) in self._kept:
            return self._kept[name, part]
        steps = [self.spark.read.parquet(f"{self._where(name, part)}/{v}").withColumn("_step", F.lit(i)) for i, v in enumerate(versions)]
        df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), steps)
        if len(steps) > 1:
            last = df.groupBy("priority").agg(F.max("_step").alias("_step"))
            df = df.join(last, ["priority", "_step"]).select("priority", *(c for c in df.columns if c not in ("priority", "_step")))
        else:
            df = df.drop("_step")
        if name in TABLES:
            df = df.select(*TABLES[name].names)
        if self.cached:
            self._kept[name, part] = df.cache()
        return df

    def _forget(self, name: str, part: str | None = None) -> None:
        for key in [k for k in self._kept if k[0] == name and part in (None, k[1])]:
            self._kept.pop(key).unpersist()

    def write(self, name: str, df: DataFrame, part: str | None = None) -> None:
        """A new version of a table, or of a part."""
        where = self._where(name, part)
        versions = self._versions(where)
        df.write.mode("overwrite").parquet(f"{where}/v{int(versions[-1][1:]) + 1 if versions else 1}")
        for old in versions:
            self._fs(where).delete(self._p(f"{where}/{old}"), True)
        self._forget(name, part)

    def upsert(self, name: str, df: DataFrame, part: str) -> None:
        """Rows that replace those of the same targets in a part."""
        where = self._where(name, part)
        versions = self._versions(where)
        df.write.mode("overwrite").parquet(f"{where}/d{int(versions[-1][1:]) + 1 if versions else 1}")
        self._forget(name, part)
        if len(versions) >= STEPS:
            self.write(name, self.read(name, part), part)

    def drop(self, name: str, part: str | None = None) -> None:
        self._fs(self.path).delete(self._p(self._where(name, part)), True)
        self._forget(name, part)

    def backup(self, path: str) -> None:
        """A copy of the store at ``path``, in place of what was there once it is whole."""
        fs, jvm = self._fs(path), self.spark._jvm
        new, old = self._p(path + ".new"), self._p(path)
        fs.delete(new, True)
        conf = self.spark._jsc.hadoopConfiguration()
        if not jvm.org.apache.hadoop.fs.FileUtil.copy(self._fs(self.path), self._p(self.path), fs, new, False, conf):
            raise OSError(f"the store could not be copied to {path}")
        fs.delete(old, True)
        if not fs.rename(new, old):
            raise OSError(f"the copy could not be moved to {path}")
        self._since = 0

    def close(self) -> None:
        """Frees cached tables; makes the last backup."""
        for name in {k[0] for k in self._kept}:
            self._forget(name)
        if self.backup_path:
            self.backup(self.backup_path)

    # targets

    @classmethod
    def create(cls, spark: SparkSession, path: str, targets: DataFrame, **options) -> Store:
        """A store of ``targets`` (priority, lightcurve and optionally starid, datasource, tmag, variance, rms_hour, ptp, known_class)."""
        for needed in ("priority", "lightcurve"):
            if needed not in targets.columns:
                raise ValueError(f"targets need {needed}")
        spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(spark._jvm.org.apache.hadoop.fs.Path(path))
        store = cls(spark, path, **options)

        def own(name: str, kind: str):
            return F.col(name).cast(kind) if name in targets.columns else F.lit(None).cast(kind)

        source = F.coalesce(own("datasource", "string"), F.lit("ffi"))
        checked = targets.withColumns({"priority": F.col("priority").cast("long"), "datasource": F.when(source.isin("ffi", "tpf"), source).otherwise(F.raise_error(F.concat(F.lit("unknown datasource "), source)))})
        one = F.lit(1)
        todo = checked.select("priority", F.coalesce(own("starid", "long"), F.col("priority")).alias("starid"), "datasource", one.alias("camera"), one.alias("ccd"), F.lit(None).cast("string").alias("method"), F.coalesce(own("tmag", "double"), F.lit(-99.0)).alias("tmag"), one.alias("status"), one.alias("corr_status"), F.lit(111).alias("cbv_area"), own("known_class", "string").alias("known_class"), F.lit(None).cast("string").alias("final_class"))
        store.write("todolist", todo)
        nothing = F.lit(None)
        corr = checked.select("priority", F.replace("lightcurve", F.lit("\\"), F.lit("/")).alias("lightcurve"), nothing.cast("double").alias("elaptime"), nothing.cast("double").alias("worker_wait_time"), *(own(c, "double").alias(c) for c in ("variance", "rms_hour", "ptp")), nothing.cast("string").alias("errors"))
        store.write("diagnostics_corr", corr)
        store.write("datavalidation_corr", checked.select("priority", F.lit(True).alias("approved"), F.lit(0).alias("dataval")))
        return store

    def candidates(self) -> DataFrame:
        valid = self.read("datavalidation_corr") if self.has("datavalidation_corr") else None
        return tasks.candidates(self.read("todolist"), self.read("diagnostics_corr"), valid)

    # work

    def number_of_tasks(self, classifier: str | None = None) -> int:
        return tasks.count_tasks(self.candidates(), self.read("diagnostics"), classifier).first()[0]

    def next_tasks(self, classifier: str | None = None, priority: int | None = None, chunk: int = 10, change: bool = True) -> DataFrame | None:
        """The next tasks of a classifier with its cached features; if it has none, those of the classifier whose next
        target comes first, at last those of the stacking one. None when all is done."""
        todo, done = self.candidates(), self.read("diagnostics")
        found = tasks.next_chunk(todo, done, classifier, priority, chunk) if classifier or priority is not None else None
        if (found is None or found.isEmpty()) and change and priority is None:
            best = tasks.lowest(todo, done, tuple(c for c in CLASSIFIERS if c not in ("meta", classifier))).first()
            classifier = best["classifier"] if best else "meta"
            found = tasks.next_chunk(todo, done, classifier, chunk=chunk)
        if found is None or found.isEmpty():
            return None
        found = found.withColumn("classifier", F.lit(classifier))
        if classifier == "meta":
            return found.join(tasks.nested(tasks.ok_results(self.read("results"), done)), "priority", "left").orderBy("priority")
        layers = [self.read("features", part) for part in ("common", classifier) if part and self.has("features", part)]
        return tasks.coalesced(found, *layers).orderBy("priority")

    def start(self, keys: DataFrame) -> None:
        """Marks (priority, classifier) as started; one that has a row already is an error."""
        for (c,) in keys.select("classifier").distinct().collect():
            own, old = keys.where(F.col("classifier") == c).select("priority", "classifier"), self.read("diagnostics", c)
            if not own.join(old, "priority", "left_semi").isEmpty():
                raise ValueError(f"tasks of {c} have been started before")
            nothing = F.lit(None)
            row = own.withColumns({"status": F.lit(int(Status.STARTED)), "elaptime": nothing.cast("double"), "worker_wait_time": nothing.cast("double"), "errors": nothing.cast("string")})
            self.upsert("diagnostics", row, c)

    def reset_started(self) -> None:
        """Forgets tasks that were started and never ended."""
        for c in self.parts("diagnostics"):
            self.write("diagnostics", self.read("diagnostics", c).where(F.col("status") != int(Status.STARTED)), c)

    def save_settings(self, tset: str, version: str) -> None:
        self.write("settings", self.spark.createDataFrame([(tset, version)], TABLES["settings"]).coalesce(1))

    def save(self, results: DataFrame, version: str = "") -> None:
        """Results (``schemas.RESULT``) replace earlier ones of the same target and classifier, probabilities and all.

        All must be of one training set, that of the store; classes must be known and probabilities within 0 and 1.
        """
        results = results.cache()
        try:
            sets = {r[0] for r in results.select("tset").distinct().collect()} | {r["tset"] for r in self.read("settings").collect()}
            if len(sets) > 1:
                raise ValueError(f"results of several training sets: {sorted(sets)}")
            rows = results.select("priority", "classifier", F.explode("class_probs").alias("class", "prob"))
            if not rows.where(~F.col("class").isin(*self.classes) | ~F.col("prob").between(0, 1) | F.isnan("prob")).isEmpty():
                raise ValueError("a class is unknown, or a probability not within 0 and 1")
            if sets and not self.has("settings"):
                self.save_settings(next(iter(sets)), version)
            for (c,) in results.select("classifier").distinct().collect():  # a few classifiers
                own = results.where(F.col("classifier") == c)
                row = own.select("priority", "classifier", "status", "elaptime", "worker_wait_time", F.when(F.size("errors") > 0, F.array_join("errors", "\n")).alias("errors"))
                self.upsert("results", own.select("priority", "classifier", F.explode("class_probs").alias("class", "prob")), c)
                self.upsert("diagnostics", row, c)
                self.save_features("common", own.select("priority", F.col("features_common").alias("features")))
                if c != "meta":
                    self.save_features(c, own.select("priority", "features"))
            self._since += results.count()
        finally:
            results.unpersist()
        if self.backup_path and self._since >= self.backup_interval:
            self.backup(self.backup_path)

    def save_features(self, part: str, features: DataFrame, frozen: bool = False) -> None:
        """Features (priority, features: map) replace earlier ones; new names add columns. If they are ``frozen``, names beyond those
        of the first features are ignored, and a row without all of them is an error."""
        if part != "common" and (part not in CLASSIFIERS or part == "meta"):
            raise ValueError(f"no features are kept for {part}")
        known = features.where("features is not null and size(features) > 0")
        names = [r[0] for r in known.select(F.explode(F.map_keys("features")).alias("k")).distinct().orderBy("k").collect()]
        if not names:
            return
        if frozen and self.has("features", part):
            names = [c for c in self.read("features", part).columns if c != "priority"]
            without = F.size(F.array_except(F.array(*map(F.lit, names)), F.map_keys("features"))) > 0
            if not known.where(without).isEmpty():
                raise ValueError(f"features of {part} are missing")
        self.upsert("features", known.select("priority", *(F.col("features")[n].alias(n) for n in names)), part)

    def features(self, part: str) -> DataFrame:
        """Cached features, unknown ones NaN."""
        own = self.read("features", part)
        return own.select("priority", *(F.coalesce(c, F.lit(float("nan"))).alias(c) for c in sorted(own.columns) if c != "priority"))

    def clear_features(self) -> None:
        self.drop("features")

    def assign_final_class(self, thresholds: dict[str, float] | None) -> None:
        """Writes each target's best class of the stacking classifier, if its row is OK or has a warning; else none. Can be repeated."""
        if not thresholds:
            raise DiagnosticsNotAvailableError("no thresholds")
        good = self.read("diagnostics", "meta").where(F.col("status").isin(int(Status.OK), int(Status.WARNING))) if self.has("diagnostics", "meta") else self.read("diagnostics")
        own = (self.read("results", "meta") if self.has("results", "meta") else self.read("results")).join(good.select("priority"), "priority", "left_semi")
        limits = self.spark.createDataFrame(sorted(thresholds.items()), "class string, threshold double")
        final = tasks.final_class(own, limits).select("priority", "final_class")
        todo = self.read("todolist")
        self.write("todolist", todo.drop("final_class").join(final, "priority", "left").select(*TABLES["todolist"].names))

    def compact(self) -> None:
        """Rewrites all tables in fewer files."""
        for name in TABLES:
            for part in self.parts(name) if name in PARTED else [None] if self.has(name) else []:
                self.write(name, self.read(name, part).coalesce(max(1, self.spark.sparkContext.defaultParallelism)), part)
