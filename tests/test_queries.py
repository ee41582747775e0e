"""Every query with SQL gives DuckDB's rows; the others run."""

import math

import duckdb
import pytest

from lightfold import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def _text(v):
    return "nan" if isinstance(v, float) and math.isnan(v) else repr(v + 0.0 if isinstance(v, float) else v)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_against_sql(spark, duck, name):
    df = catalogue.QUERIES[name](spark, SF)
    told = duck.sql(catalogue.ORACLES[name])
    assert sorted(df.columns) == sorted(told.columns)
    order = sorted(df.columns)
    got = sorted(tuple(_text(r[c]) for c in order) for r in df.collect())
    want = sorted(tuple(_text(r[told.columns.index(c)]) for c in order) for r in told.fetchall())
    assert got == want


@pytest.mark.parametrize("name", ["features_xgb", "features_sortinghat", "features_image", "som_train", "diagnostics_document"])
def test_runs(spark, name):
    assert catalogue.QUERIES[name](spark, SF).count() > 0


def test_diagnostics_document_against_plain_loops(spark):
    """All numbers of the document from the joined rows."""
    import json

    from lightfold.plans import learning_plans as plans

    told = json.loads(catalogue.QUERIES["diagnostics_document"](spark, SF).first()[0])
    rows = [(r["score"], int(r["positive"])) for r in plans._judged(spark, SF).collect()]
    pairs = [(("bad", "good")[p], "good" if s >= 0.4 else "bad") for s, p in rows]
    for cell in told["confusion_matrix"]:
        assert cell["n"] == sum(t == cell["truth"] and p == cell["predicted"] for t, p in pairs)
    for line in told["report"]:
        if line["class"] in plans.CLASSES:
            c = line["class"]
            hit, told_, own = sum(t == p == c for t, p in pairs), sum(p == c for _, p in pairs), sum(t == c for t, _ in pairs)
            want = (hit / told_ if told_ else 0, hit / own if own else 0)
            assert (line["precision"], line["recall"]) == pytest.approx(want) and line["support"] == own
    below = sum((s > t) + 0.5 * (s == t) for s, p in rows if p for t, q in rows if not q)
    area = below / (sum(p for _, p in rows) * sum(1 - p for _, p in rows))
    assert {r["class"]: r["auc"] for r in told["roc_auc"]} == pytest.approx({"good": area, "micro": area})
    best = max(((sum(s >= x for s, p in rows if p) / sum(p for _, p in rows) - sum(s >= x for s, p in rows if not p) / sum(1 - p for _, p in rows)), x) for x in {s for s, _ in rows})
    assert told["roc_best_threshold"] == [{"class": "good", "threshold": pytest.approx(best[1])}]


def test_probabilities(spark):
    rows = catalogue.QUERIES["forest_train_predict"](spark, SF).groupBy("vec_id").sum("prob").collect()
    assert rows and all(abs(r[1] - 1) < 1e-9 for r in rows)


def test_boosted_trees_get_all_features(spark, monkeypatch):
    from lightfold.plans import learning_plans as plans

    given = []

    class Told(plans.ml.Boosted):
        def fit(self, df):
            given.extend(self.features)
            return self

        def predict(self, df, key):
            return df

    monkeypatch.setattr(plans.ml, "Boosted", Told)
    plans.ovr_gbt_predict(spark, SF)
    assert given == plans._names() and len(given) == 64
