"""Queries of the work queue; orders, lineitem, customer and events stand for its tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import tasks as k
from ..schemas import CLASSIFIERS, Level1, Status
from .registry import query, rounded, table

CLASSES = [c.name for c in Level1]
THRESHOLDS = {"click": 0.2, "error": 0.25, "purchase": 0.3, "signup": 0.25, "view": 0.2}


def todolist(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "O", 1).when(F.col("o_orderstatus") == "F", 2).otherwise(3)
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("priority"), F.col("o_custkey").alias("starid"), F.col("o_totalprice").alias("tmag"), status.alias("corr_status"))


def diagnostics_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("l_extendedprice")
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("priority"))
    return lines.agg(F.var_samp(price).alias("variance"), F.avg(price).alias("rms_hour"), (F.max(price) - F.min(price)).alias("ptp")).withColumn("lightcurve", F.concat(F.lit("lc/"), F.col("priority").cast("string")))


def validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    approved = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("starid"), (F.col("c_acctbal") > 0).alias("approved"))
    return todolist(spark, sf_dir).join(approved, "starid").select("priority", "approved")


def _classifier():
    out = F.lit(None).cast("string")
    for n, c in enumerate(CLASSIFIERS, 1):
        out = F.when(F.col("l_linenumber") == n, c).otherwise(out)
    return out


def diagnostics(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("l_returnflag") == "R", int(Status.ERROR)).when((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O"), int(Status.STARTED)).otherwise(int(Status.OK))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("priority"), _classifier().alias("classifier"), status.alias("status"))
    return lines.where("classifier is not null").groupBy("priority", "classifier").agg(F.max("status").alias("status"))


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.array(*map(F.lit, CLASSES))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("priority"), _classifier().alias("classifier"), F.element_at(names, (F.col("l_partkey") % 8 + 1).cast("int")).alias("class"), (F.col("l_discount") * 10).alias("prob"))
    return lines.where("classifier is not null").groupBy("priority", "classifier", "class").agg(F.max("prob").alias("prob"))


def shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class probabilities of users: shares of event types within events of the same remainder."""
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("priority"), F.concat(F.lit("c"), (F.col("event_id") % 4).cast("string")).alias("classifier"), F.col("event_type").alias("class"))
    counts = e.groupBy("priority", "classifier").agg(F.count("*").alias("n"), *(F.count(F.when(F.col("class") == c, 1)).alias(c) for c in THRESHOLDS))
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("class"), F.col(c).alias("m")) for c in THRESHOLDS))).alias("p")
    return counts.select("priority", "classifier", "n", pairs).where("p.m > 0").select("priority", "classifier", F.col("p.class").alias("class"), (F.col("p.m") / F.col("n")).alias("prob"))


_CASE = "CASE l_linenumber " + " ".join(f"WHEN {n} THEN '{c}'" for n, c in enumerate(CLASSIFIERS, 1)) + " END"
_WITH = f"""WITH todo AS (SELECT o_orderkey AS priority, o_custkey AS starid, o_totalprice AS tmag, CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN 2 ELSE 3 END AS corr_status FROM orders),
dc AS (SELECT l_orderkey AS priority, var_samp(l_extendedprice) AS variance, avg(l_extendedprice) AS rms_hour, max(l_extendedprice) - min(l_extendedprice) AS ptp, 'lc/' || l_orderkey AS lightcurve FROM lineitem GROUP BY 1),
dg AS (SELECT l_orderkey AS priority, {_CASE} AS classifier, max(CASE WHEN l_returnflag = 'R' THEN 2 WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 6 ELSE 1 END) AS status FROM lineitem WHERE l_linenumber <= 5 GROUP BY 1, 2),
cls AS (SELECT unnest({list(CLASSIFIERS)!r}) AS classifier),
cand AS (SELECT t.priority, starid, tmag, lightcurve, variance, rms_hour, ptp FROM todo t JOIN dc USING (priority) WHERE corr_status IN (1, 3)),
pend AS (SELECT c.priority, k.classifier FROM cand c CROSS JOIN cls k WHERE NOT EXISTS (SELECT 1 FROM dg WHERE dg.priority = c.priority AND dg.classifier = k.classifier)),
rs AS (SELECT l_orderkey AS priority, {_CASE} AS classifier, list_extract({CLASSES!r}, CAST(l_partkey % 8 + 1 AS INTEGER)) AS class, max(l_discount * 10) AS prob FROM lineitem WHERE l_linenumber <= 5 GROUP BY 1, 2, 3)"""
_SHARES = """WITH g AS (SELECT user_id AS priority, 'c' || (event_id % 4) AS classifier, event_type AS class, count(*) AS m FROM events GROUP BY 1, 2, 3),
sh AS (SELECT priority, classifier, class, m / sum(m) OVER (PARTITION BY priority, classifier) AS prob FROM g)"""
_CAND = "priority, starid, round(tmag, 2) + 0.0 AS tmag, lightcurve, round(sqrt(variance), 4) + 0.0 AS scatter, round(rms_hour, 7) + 0.0 AS rms_hour, round(ptp, 4) + 0.0 AS ptp"


def _candidates(df: DataFrame) -> DataFrame:
    return df.select("priority", "starid", rounded(F.col("tmag"), 2).alias("tmag"), "lightcurve", rounded(F.sqrt("variance"), 4).alias("scatter"), rounded(F.col("rms_hour"), 7).alias("rms_hour"), rounded(F.col("ptp"), 4).alias("ptp"))


def _targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return k.candidates(todolist(spark, sf_dir), diagnostics_corr(spark, sf_dir))


@query(_WITH + f" SELECT {_CAND} FROM cand WHERE starid IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)")
def candidates_validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _candidates(k.candidates(todolist(spark, sf_dir), diagnostics_corr(spark, sf_dir), validation(spark, sf_dir)))


@query(_WITH + f" SELECT {_CAND} FROM cand")
def candidates_no_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _candidates(_targets(spark, sf_dir))


@query(_WITH + " SELECT priority, classifier FROM pend")
def pending_by_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return k.pending(_targets(spark, sf_dir), diagnostics(spark, sf_dir))


@query(_WITH + " SELECT count(*) AS tasks FROM pend")
def count_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return k.count_tasks(_targets(spark, sf_dir), diagnostics(spark, sf_dir))


@query(_WITH + """ SELECT priority FROM cand c WHERE (SELECT count(*) FROM dg WHERE dg.priority = c.priority AND classifier <> 'meta' AND status <> 6) = 4
AND NOT EXISTS (SELECT 1 FROM dg WHERE dg.priority = c.priority AND classifier = 'meta')""")
def meta_ready(spark: SparkSession, sf_dir: str) -> DataFrame:
    return k.meta_ready(_targets(spark, sf_dir), diagnostics(spark, sf_dir)).select("priority")


@query(_WITH + " SELECT p.priority, c.starid FROM pend p JOIN cand c USING (priority) WHERE classifier = 'slosh' ORDER BY priority LIMIT 10")
def next_chunk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return k.next_chunk(_targets(spark, sf_dir), diagnostics(spark, sf_dir), "slosh").select("priority", "starid")


@query(_WITH + " SELECT classifier, min(priority) AS priority FROM pend WHERE classifier <> 'meta' GROUP BY 1 ORDER BY 2, 1 LIMIT 1")
def lowest_priority_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return k.lowest(_targets(spark, sf_dir), diagnostics(spark, sf_dir))


@query(_WITH + " SELECT rs.priority, rs.classifier, class, round(prob, 6) + 0.0 AS prob FROM rs JOIN dg USING (priority, classifier) WHERE status = 1 AND rs.classifier <> 'meta'")
def results_ok_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return k.ok_results(results(spark, sf_dir), diagnostics(spark, sf_dir)).withColumn("prob", rounded(F.col("prob")))


@query(_WITH + """, nw AS (SELECT priority, classifier, class, 1 - prob AS prob FROM rs WHERE priority % 3 = 0)
SELECT priority, classifier, class, round(prob, 6) + 0.0 AS prob FROM nw UNION ALL
SELECT priority, classifier, class, round(prob, 6) + 0.0 FROM rs WHERE NOT EXISTS (SELECT 1 FROM nw WHERE nw.priority = rs.priority AND nw.classifier = rs.classifier)""")
def results_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = results(spark, sf_dir)
    new = old.where("priority % 3 = 0").withColumn("prob", 1 - F.col("prob"))
    return k.upserted(old, new, ["priority", "classifier"]).select("priority", "classifier", "class", rounded(F.col("prob")).alias("prob"))


@query(_SHARES + " SELECT priority, string_agg(classifier || ':' || class || ':' || CAST(CAST(round(prob * 1000000) AS BIGINT) AS VARCHAR), ' ' ORDER BY classifier, class) AS other_classifiers FROM sh GROUP BY 1")
def nested_other_classifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.transform("other_classifiers", lambda x: F.concat_ws(":", x["classifier"], x["class"], F.round(x["prob"] * 1000000).cast("long").cast("string")))
    return k.nested(shares(spark, sf_dir)).select("priority", F.array_join(text, " ").alias("other_classifiers"))


_PAIRS = [(f"c{n}", c) for n in range(4) for c in THRESHOLDS]


@query(_SHARES + " SELECT priority, " + ", ".join(f"round(max(prob) FILTER (classifier = '{c}' AND class = '{x}'), 6) + 0.0 AS {c}_{x}" for c, x in _PAIRS) + " FROM sh GROUP BY 1")
def meta_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    pivoted = k.wide(shares(spark, sf_dir), [f"c{n}" for n in range(4)], list(THRESHOLDS))
    return pivoted.select("priority", *(rounded(F.col(c)).alias(c) for c in pivoted.columns[1:]))


@query("""WITH b AS (SELECT user_id AS priority, avg(value) AS f1, CAST(NULL AS DOUBLE) AS f2 FROM events GROUP BY 1),
m AS (SELECT user_id AS priority, max(value) AS f1, min(value) AS f2 FROM events WHERE event_type = 'click' GROUP BY 1 HAVING count(*) > 12)
SELECT priority, round(coalesce(m.f1, b.f1), 6) + 0.0 AS f1, round(m.f2, 6) + 0.0 AS f2 FROM b LEFT JOIN m USING (priority)""")
def moat_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumnRenamed("user_id", "priority")
    base = e.groupBy("priority").agg(F.avg("value").alias("f1"))
    layer = e.where("event_type = 'click'").groupBy("priority").agg(F.max("value").alias("f1"), F.min("value").alias("f2"), F.count("*").alias("n")).where("n > 12").drop("n")
    return k.coalesced(base, layer).select("priority", rounded(F.col("f1")).alias("f1"), rounded(F.col("f2")).alias("f2"))


@query("""WITH a AS (SELECT p_partkey, row_number() OVER (ORDER BY p_partkey) AS n FROM part), b AS (SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) AS n FROM supplier)
SELECT p_partkey, s_suppkey FROM a JOIN b USING (n)""")
def positional_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return k.zipped(table(spark, sf_dir, "part").select("p_partkey"), table(spark, sf_dir, "supplier").select("s_suppkey"), "p_partkey", "s_suppkey")


@query("""WITH s AS (SELECT user_id AS priority, event_type AS class, count(*) / sum(count(*)) OVER (PARTITION BY user_id) AS prob FROM events GROUP BY 1, 2),
b AS (SELECT *, row_number() OVER (PARTITION BY priority ORDER BY prob DESC, class) AS n FROM s)
SELECT priority, CASE WHEN prob >= CASE class """ + " ".join(f"WHEN '{c}' THEN {t}e0" for c, t in THRESHOLDS.items()) + " END THEN class ELSE 'UNKNOWN' END AS final_class, round(prob, 6) + 0.0 AS prob FROM b WHERE n = 1")
def final_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("priority"), F.col("event_type").alias("class")).agg(F.count("*").alias("n"))
    total = e.groupBy("priority").agg(F.sum("n").alias("total"))
    probs = e.join(total, "priority").select("priority", "class", (F.col("n") / F.col("total")).alias("prob"))
    thresholds = spark.createDataFrame(list(THRESHOLDS.items()), "class string, threshold double")
    return k.final_class(probs, thresholds).withColumn("prob", rounded(F.col("prob")))


@query(_WITH + " SELECT todo.priority, status FROM todo LEFT JOIN dg ON dg.priority = todo.priority AND dg.classifier = 'xgb'")
def outcome_of_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return k.with_outcome(todolist(spark, sf_dir), diagnostics(spark, sf_dir), "xgb")
