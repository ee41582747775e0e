"""Queries of labels, learning and evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import labels as lb
from ..operators import evaluation as ev
from ..operators import learning as ml
from ..operators import prewhiten as pw
from ..operators import tasks as k
from .registry import lightcurve, query, rounded, table, tidy

NAMES = {"click": "Transit", "error": "dSct+gDor hybrid", "purchase": "Spots", "signup": "unknown", "view": " RRab "}
#: Labels of users: those of their events, in order of time, joined by ";".
_LABELS = (
    "WITH e AS (SELECT user_id, ts, event_id, CASE event_type " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in NAMES.items()) + " END AS label FROM events),"
    " t AS (SELECT user_id, string_agg(label, ';' ORDER BY ts, event_id) AS labels FROM e GROUP BY 1),"
    " w AS (SELECT user_id, list_filter(list_transform(string_split(labels, ';'), lambda x: trim(x)), lambda x: x <> '') AS parts FROM t),"
    " d AS (SELECT user_id, list_filter(parts, lambda x, i: list_position(parts, x) = i) AS labels FROM w),"
    " m AS (SELECT user_id, labels, list_transform(list_filter(labels, lambda x: x IN ('Transit', 'dSct+gDor hybrid', 'Spots', 'RRab')),"
    " lambda x: CASE x WHEN 'Transit' THEN ['ECLIPSE'] WHEN 'Spots' THEN ['CONTACT_ROT'] WHEN 'RRab' THEN ['RRLYR_CEPHEID'] ELSE ['DSCT_BCEP', 'GDOR_SPB'] END) AS nested FROM d),"
    " c AS (SELECT user_id, labels, flatten(nested) AS classes FROM m)"
)


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    meaning = F.create_map(*(F.lit(x) for pair in NAMES.items() for x in pair))
    rows = F.sort_array(F.collect_list(F.struct("ts", "event_id", meaning[F.col("event_type")].alias("label"))))
    text = e.groupBy("user_id").agg(F.array_join(F.transform(rows, lambda r: r["label"]), ";").alias("text"))
    return text.withColumn("labels", lb.split(F.col("text"))).withColumn("classes", lb.translated(F.col("labels"), lb.LEVEL1))


@query(_LABELS + " SELECT user_id, array_to_string(labels, ';') AS labels, array_to_string(classes, ';') AS classes FROM c")
def label_split_translate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _labelled(spark, sf_dir).select("user_id", F.array_join("labels", ";").alias("labels"), F.array_join("classes", ";").alias("classes"))


@query(_LABELS + " SELECT user_id, CASE WHEN len(classes) <= 1 THEN classes[1] " + " ".join(f"WHEN list_contains(classes, '{c}') THEN '{c}'" for c in lb.PRIORITY) + " ELSE classes[1] END AS label FROM c")
def label_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _labelled(spark, sf_dir).select("user_id", lb.single(F.col("classes")).alias("label"))


@query("""WITH n AS (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'constant_' || (c_custkey // 3) WHEN 1 THEN 'fakerrlyr_' || (c_custkey // 3) ELSE CAST(c_custkey AS VARCHAR) END AS name FROM customer)
SELECT c_custkey, CASE WHEN name LIKE 'constant_%' THEN -10000 - CAST(substr(name, 10) AS BIGINT) WHEN name LIKE 'fakerrlyr_%' THEN -20000 - CAST(substr(name, 11) AS BIGINT) ELSE CAST(name AS BIGINT) END AS starid,
'star/' || (CASE WHEN regexp_matches(name, '^[0-9]+$') THEN lpad(name, 9, '0') ELSE name END) || '.txt' AS path FROM n""")
def starid_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    third = F.floor(key / 3).cast("string")
    name = F.when(key % 3 == 0, F.concat(F.lit("constant_"), third)).when(key % 3 == 1, F.concat(F.lit("fakerrlyr_"), third)).otherwise(key.cast("string"))
    named = table(spark, sf_dir, "customer").select("c_custkey", name.alias("name"))
    return named.select("c_custkey", lb.star_id(F.col("name")).alias("starid"), lb.star_path(F.lit("star"), F.col("name")).alias("path"))


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", F.col("embedding").alias("vector"))


@query("""WITH p AS (SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS n, count(*) OVER (PARTITION BY label) AS c FROM embeddings)
SELECT vec_id, label, n <= round(c * 0.2e0) AS test FROM p""")
def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ml.stratified(_vectors(spark, sf_dir), "label", "vec_id", 0.2).select("vec_id", "label", "test")


@query("SELECT vec_id, label, CAST((row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1) % 5 AS INTEGER) AS fold FROM embeddings")
def stratified_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ml.folded(_vectors(spark, sf_dir), "label", "vec_id").select("vec_id", "label", "fold")


@query("WITH c AS (SELECT label, count(*) AS n FROM embeddings GROUP BY 1) SELECT label, round((SELECT sum(n) FROM c) / ((SELECT count(*) FROM c) * n), 6) + 0.0 AS weight FROM c")
def balanced_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ml.balanced(_vectors(spark, sf_dir), "label").groupBy("label").agg(rounded(F.first("weight")).alias("weight"))


@query("""WITH u AS (SELECT vec_id AS unit, embedding AS w FROM embeddings WHERE vec_id < 16),
d AS (SELECT e.vec_id, u.unit, list_sum(list_transform(range(1, len(w) + 1), lambda i: pow(CAST(embedding[i] AS DOUBLE) - CAST(w[i] AS DOUBLE), 2))) AS d FROM embeddings e CROSS JOIN u),
b AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, unit) AS n FROM d)
SELECT vec_id, CAST(unit AS INTEGER) AS unit, round(d, 5) + 0.0 AS distance FROM b WHERE n = 1""")
def bmu_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = _vectors(spark, sf_dir)
    units = v.where("vec_id < 16").select(F.col("vec_id").cast("int").alias("unit"), F.col("vector").alias("weights"))
    return tidy(ml.best_units(v, units).select("vec_id", "unit", "distance"), 5)


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of documents by length, and whether their quality is good."""
    score = (F.col("n_chars") % 997) / 997.0
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id").select("doc_id", score.alias("score"), F.col("quality").alias("positive"))


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _judged(spark, sf_dir).select(F.when(F.col("positive") == 1, "good").otherwise("bad").alias("truth"), F.when(F.col("score") >= 0.4, "good").otherwise("bad").alias("predicted"))


_JUDGED = "WITH j AS (SELECT doc_id, (n_chars % 997) / 997e0 AS score, quality AS positive FROM documents JOIN labels USING (doc_id)), pr AS (SELECT CASE positive WHEN 1 THEN 'good' ELSE 'bad' END AS truth, CASE WHEN score >= 0.4e0 THEN 'good' ELSE 'bad' END AS predicted FROM j), k AS (SELECT unnest(['good', 'bad', 'none']) AS c)"
_CONF = ", cm AS (SELECT a.c AS truth, b.c AS predicted, (SELECT count(*) FROM pr WHERE pr.truth = a.c AND pr.predicted = b.c) AS n FROM k a CROSS JOIN k b)"
_ROC = """, ti AS (SELECT score, sum(positive) AS p, count(*) - sum(positive) AS n FROM j GROUP BY 1),
ro AS (SELECT score AS threshold, sum(n) OVER w / CAST((SELECT sum(n) FROM ti) AS DOUBLE) AS fpr, sum(p) OVER w / CAST((SELECT sum(p) FROM ti) AS DOUBLE) AS tpr FROM ti WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING)
UNION ALL SELECT max(score) + 1, 0, 0 FROM j)"""
CLASSES = ["good", "bad", "none"]


@query(_JUDGED + _CONF + " SELECT truth, predicted, n, round(coalesce(n / nullif(sum(n) OVER (PARTITION BY truth), 0), 0), 6) + 0.0 AS share FROM cm")
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(ev.confusion(_pairs(spark, sf_dir), CLASSES))


@query(_JUDGED + _CONF + """, r AS (SELECT truth AS class, CAST(sum(n) AS BIGINT) AS support, sum(n) FILTER (truth = predicted) AS hit FROM cm GROUP BY 1), t AS (SELECT predicted AS class, sum(n) AS told FROM cm GROUP BY 1),
q AS (SELECT class, support, hit, coalesce(hit / nullif(told, 0), 0) AS precision, coalesce(hit / nullif(support, 0), 0) AS recall FROM r JOIN t USING (class)),
f AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM q),
a AS (SELECT class, precision, recall, f1, support FROM f UNION ALL SELECT 'accuracy', sum(hit) / sum(support), sum(hit) / sum(support), sum(hit) / sum(support), sum(support) FROM f
UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM f
UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support) FROM f)
SELECT class, round(precision, 6) + 0.0 AS precision, round(recall, 6) + 0.0 AS recall, round(f1, 6) + 0.0 AS f1, CAST(support AS BIGINT) AS support FROM a""")
def classification_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(ev.report(_pairs(spark, sf_dir), CLASSES))


@query(_JUDGED + """, j2 AS (SELECT score, positive FROM j UNION ALL SELECT 1 - score, 1 - positive FROM j),
ti AS (SELECT score, sum(positive) AS p, count(*) - sum(positive) AS n FROM j2 GROUP BY 1),
ro AS (SELECT score AS threshold, sum(n) OVER w / CAST((SELECT sum(n) FROM ti) AS DOUBLE) AS fpr, sum(p) OVER w / CAST((SELECT sum(p) FROM ti) AS DOUBLE) AS tpr FROM ti WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING)
UNION ALL SELECT max(score) + 1, 0, 0 FROM j2),
ar AS (SELECT (fpr - lag(fpr) OVER w) * (tpr + lag(tpr) OVER w) / 2 AS area FROM ro WINDOW w AS (ORDER BY threshold DESC)) SELECT round(sum(area), 6) + 0.0 AS auc FROM ar""")
def roc_auc_micro(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of two classes taken together, good by the score and bad by the rest."""
    good = _judged(spark, sf_dir).select("score", "positive")
    both = good.unionByName(good.select((1 - F.col("score")).alias("score"), (1 - F.col("positive")).alias("positive")))
    return tidy(ev.auc(ev.micro(both)))


@query("""WITH a AS (SELECT CASE WHEN doc_id % 3 = 0 THEN 'x' ELSE 'y' END AS class, (n_chars % 997) / 997e0 AS score, quality AS positive FROM documents JOIN labels USING (doc_id)),
ti AS (SELECT class, score, sum(positive) AS p, count(*) - sum(positive) AS n FROM a GROUP BY 1, 2),
ro AS (SELECT class, score AS threshold, sum(n) OVER w / CAST(sum(n) OVER v AS DOUBLE) AS fpr, sum(p) OVER w / CAST(sum(p) OVER v AS DOUBLE) AS tpr FROM ti WINDOW w AS (PARTITION BY class ORDER BY score DESC ROWS UNBOUNDED PRECEDING), v AS (PARTITION BY class)
UNION ALL SELECT class, max(score) + 1, 0, 0 FROM a GROUP BY 1),
ar AS (SELECT class, (fpr - lag(fpr) OVER w) * (tpr + lag(tpr) OVER w) / 2 AS area FROM ro WINDOW w AS (PARTITION BY class ORDER BY threshold DESC)) SELECT class, round(sum(area), 6) + 0.0 AS auc FROM ar GROUP BY 1""")
def roc_auc_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _judged(spark, sf_dir).withColumn("class", F.when(F.col("doc_id") % 3 == 0, "x").otherwise("y"))
    return tidy(ev.auc(ev.roc(scored, ["class"]), ["class"]))


@query("""WITH t AS (SELECT count(*) AS whole FROM embeddings), p AS (SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS n, count(*) OVER (PARTITION BY label) AS c FROM embeddings)
SELECT vec_id, label FROM p CROSS JOIN t WHERE whole <= 200 OR n <= round(c * (200 / CAST(whole AS DOUBLE)))""")
def stratified_subsample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ml.subsampled(_vectors(spark, sf_dir), "label", "vec_id", 200).select("vec_id", "label")


@query(_JUDGED + _ROC + " SELECT round(threshold, 6) + 0.0 AS threshold, round(fpr, 6) + 0.0 AS fpr, round(tpr, 6) + 0.0 AS tpr FROM ro")
def roc_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(ev.roc(_judged(spark, sf_dir)))


@query(_JUDGED + _ROC + ", ar AS (SELECT (fpr - lag(fpr) OVER w) * (tpr + lag(tpr) OVER w) / 2 AS area FROM ro WINDOW w AS (ORDER BY threshold DESC)) SELECT round(sum(area), 6) + 0.0 AS auc FROM ar")
def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(ev.auc(ev.roc(_judged(spark, sf_dir))))


@query(_JUDGED + _ROC + " SELECT round(threshold, 6) + 0.0 AS threshold FROM ro ORDER BY tpr - fpr DESC, threshold DESC LIMIT 1")
def roc_best_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(ev.best_threshold(ev.roc(_judged(spark, sf_dir))))


@query()  # one text of numbers: see tests for the same from plain loops
def diagnostics_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _judged(spark, sf_dir).withColumn("class", F.lit("good"))
    return ev.diagnostics(_pairs(spark, sf_dir), scored, CLASSES, "testing", "meta", "L1")


@query()
def shapiro_and_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pw.shape_statistics(lightcurve(spark, sf_dir))


@query()
def prewhiten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pw.prewhitened(lightcurve(spark, sf_dir), peaks=3, harmonics=1, oversampling=2, alarm=None, deviation=None, refit=2)


CLASS_NAMES = [f"class{n}" for n in range(10)]
SIZE = 64


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _vectors(spark, sf_dir).select("vec_id", "label", *(F.col("vector")[n].alias(f"f{n}") for n in range(SIZE)))


def _names() -> list[str]:
    return [f"f{n}" for n in range(SIZE)]


@query()
def forest_train_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = ml.stratified(_features(spark, sf_dir), "label", "vec_id", 0.2)
    return ml.Forest(_names(), CLASS_NAMES, trees=20, depth=7).fit(data.where("not test")).predict(data.where("test"), "vec_id")


@query()
def ovr_gbt_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = ml.stratified(_features(spark, sf_dir), "label", "vec_id", 0.2)
    return ml.Boosted(_names(), CLASS_NAMES, rounds=1, depth=3).fit(data.where("not test")).predict(data.where("test"), "vec_id")


@query()
def som_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ml.train_map(_vectors(spark, sf_dir), 10, SIZE, sweeps=3)


@query()
def stack_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Out-of-fold probabilities of two forests, and the classes by a third that learned from them."""
    data = _features(spark, sf_dir)
    base = {"rfgc": _names()[:32], "sortinghat": _names()[32:]}
    parts = [ml.out_of_fold(lambda own=own: ml.Forest(own, CLASS_NAMES, trees=5, depth=4), data, "vec_id", folds=2).select("vec_id", F.lit(name).alias("classifier"), "class", "prob") for name, own in base.items()]
    wide = k.wide(parts[0].unionByName(parts[1]), list(base), CLASS_NAMES, by="vec_id")
    stacked = wide.join(data.select("vec_id", "label"), "vec_id")
    meta = ml.Forest([c for c in wide.columns if c != "vec_id"], CLASS_NAMES, trees=10, depth=5).fit(stacked)
    return k.best_class(meta.predict(stacked, "vec_id").withColumnRenamed("vec_id", "priority"))
