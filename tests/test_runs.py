"""From files to final classes, by the functions and by the command line."""

import json
import math
import random

import pytest

from lightfold import classify as runs
from lightfold.__main__ import main
from lightfold.operators import learning
from lightfold.schemas import Status
from lightfold.store import DiagnosticsNotAvailableError, Store

CLASSES = ("SOLARLIKE", "RRLYR_CEPHEID", "CONSTANT")
SIZES = {"rfgc": {"trees": 8, "depth": 3, "subset": "4"}, "sortinghat": {"trees": 8, "depth": 3}, "xgb": {"rounds": 1, "depth": 2}, "slosh": {"hidden": 8, "epochs": 4, "bins": 16, "filters": [2, 3]}, "meta": {"trees": 10, "depth": 3}, "map": {"width": 6, "sweeps": 5}}


def _curve(kind, seed):
    rng = random.Random(seed)
    a, f = {"SOLARLIKE": (300.0, 3.0), "RRLYR_CEPHEID": (50_000.0, 0.9), "CONSTANT": (0.0, 1.0)}[kind]
    f *= rng.uniform(0.95, 1.05)
    return "# t flux error\n" + "\n".join(f"{t / 12:.6f} {a * math.sin(2 * math.pi * f * t / 12) + 40 * t / 240 + rng.gauss(0, 60):.4f} 60.0 0" for t in range(120))


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """Labelled light curves and a target list, and others to classify."""
    where = tmp_path_factory.mktemp("curves")
    lines = ["# comment", "starname,label,tmag"]
    for n in range(21):
        kind = CLASSES[n % 3]
        (where / kind).mkdir(exist_ok=True)
        (where / kind / f"{n + 1:09d}.txt").write_text(_curve(kind, n))
        lines.append(f"{n + 1},{kind},9.5")
    (where / "targets.ecsv").write_text("\n".join(lines) + "\n")
    (where / "new").mkdir()
    for n in range(6):
        (where / "new" / f"star{n}.txt").write_text(_curve(CLASSES[n % 3], 100 + n))
    (where / "new" / "odd.txt").write_text("no numbers here\n")
    return where


@pytest.fixture(scope="module")
def trained(spark, folder, tmp_path_factory):
    where = tmp_path_factory.mktemp("trained")
    listed = runs.training.target_files.read_ecsv(spark, str(folder / "targets.ecsv"))
    store = runs.training.build_store(spark, str(where / "store"), listed, list(CLASSES), str(folder))
    models = runs.train(store, str(folder), "testing", holdout=0.2, linfit=True, sizes=SIZES, folds=2)
    models.save(spark, str(where / "models"))
    return store, models, str(where / "models")


def test_statistics_are_computed(trained):
    rows = trained[0].read("diagnostics_corr").collect()
    assert len(rows) == 21 and all(r["variance"] > 0 and r["rms_hour"] > 0 and r["ptp"] > 0 for r in rows)


def test_training_saves_results_and_models(spark, trained):
    store, models, where = trained
    for c in ("rfgc", "slosh", "xgb", "sortinghat", "meta"):
        assert store.read("results", c).count() == 21 * len(CLASSES)
    assert {r["class"] for r in models.diagnostics["roc_auc"]} == {*CLASSES, "micro"}
    again = runs.Models.load(spark, where)
    assert again.linfit and list(again.fitted) == list(models.fitted) and again.units.count() == 6
    assert again.fitted["rfgc"].features == models.fitted["rfgc"].features and "detrend_coeff_norm" in again.fitted["rfgc"].features
    assert again.fitted["meta"].missing is None


def test_missing_files_stop_the_building_of_a_store(spark, folder, tmp_path):
    listed = spark.createDataFrame([("77", "CONSTANT")], "starname string, known_class string").selectExpr("*", "cast(null as long) starid", "cast(null as string) lightcurve", "cast(null as double) tmag")
    with pytest.raises(FileNotFoundError):
        runs.training.build_store(spark, str(tmp_path / "store"), listed, list(CLASSES), str(folder))


def test_from_files_to_final_classes(spark, folder, trained, tmp_path):
    where = trained[2]
    files = [(n + 1, f"new/star{n}.txt") for n in range(6)] + [(7, "new/odd.txt"), (8, "new/none.txt")]
    store = Store.create(spark, str(tmp_path / "store"), spark.createDataFrame(files, "priority long, lightcurve string"), classes=CLASSES)
    runs.classify(store, runs.Models.load(spark, where), str(folder), "testing")
    told = {(r["priority"], r["classifier"]): r for r in store.read("diagnostics").collect()}
    assert len(told) == 8 * 5
    for (p, c), r in told.items():
        assert r["status"] == (int(Status.OK) if p <= 6 else int(Status.ERROR)), (p, c, r["errors"])
    assert "FileNotFoundError" in told[8, "rfgc"]["errors"] and "ValueError" in told[7, "xgb"]["errors"] and told[7, "meta"]["errors"] == "features contain NaN"
    final = {r["priority"]: r["final_class"] for r in store.read("todolist").collect()}
    assert final[7] is None and final[8] is None and all(final[p] in (*CLASSES, "UNKNOWN") for p in range(1, 7))
    assert sum(final[n + 1] == CLASSES[n % 3] for n in range(6)) >= 3
    sums = store.read("results").groupBy("priority", "classifier").sum("prob").collect()
    assert len(sums) == 6 * 5 and all(abs(r[2] - 1) < 1e-6 for r in sums)
    assert store.number_of_tasks() == 0 and store.features("common").where("priority <= 6").count() == 6
    # cached features give the same probabilities
    before = sorted(tuple(r) for r in store.read("results", "rfgc").collect())
    again = Store(spark, store.path, CLASSES, overwrite=True)
    runs.classify(again, runs.Models.load(spark, where), str(folder), "testing", classifier="rfgc")
    after = sorted(tuple(r) for r in again.read("results", "rfgc").collect())
    assert [r[:3] for r in before] == [r[:3] for r in after] and [r[3] for r in before] == pytest.approx([r[3] for r in after], abs=1e-6)


def test_command_line(spark, folder, trained, tmp_path, capsys):
    main(["todolist", str(folder / "new"), str(tmp_path / "store"), "--pattern", "star*.txt"])
    main(["tasks", str(tmp_path / "store")])
    assert capsys.readouterr().out.strip() == "30"
    main(["classify", str(tmp_path / "store"), str(folder / "new"), "--datadir", trained[2], "-t", "testing", "-c", "sortinghat", "--chunks", "6"])
    main(["tasks", str(tmp_path / "store")])
    assert capsys.readouterr().out.strip() == "24"
    for wrong in (["classify", "a", "b", "--datadir", "c", "--clear-cache"], ["train", "a", "b", "--datadir", "c", "-tf", "1"], ["classify", "a", "b", "--datadir", "c", "--chunks", "0"]):
        with pytest.raises(SystemExit):
            main(wrong)
    (tmp_path / "limits.json").write_text(json.dumps({"CONSTANT": 0.5}))
    main(["final", str(tmp_path / "store"), str(tmp_path / "limits.json")])


def test_stack_refuses_missing_features(spark):
    data = spark.createDataFrame([(1, 0, 0.5), (2, 1, None)], "priority long, label int, f double")
    model = learning.Forest(["f"], ["a", "b"], trees=2, depth=2, missing=None)
    with pytest.raises(ValueError, match="NaN"):
        model.fit(data)
    with pytest.raises(learning.UntrainedClassifierError):
        model.predict(data, "priority")


def test_unfitted_classifiers_and_no_thresholds(spark, folder, trained, tmp_path):
    store = Store.create(spark, str(tmp_path / "store"), spark.createDataFrame([(1, "new/star0.txt")], "priority long, lightcurve string"), classes=CLASSES)
    with pytest.raises(learning.UntrainedClassifierError):
        runs.classify(store, runs.Models(), str(folder), "testing")
    models = runs.Models.load(spark, trained[2])
    models.diagnostics = None
    with pytest.raises(DiagnosticsNotAvailableError):
        runs.classify(store, models, str(folder), "testing", classifier="meta")


def test_maps_as_text(spark, tmp_path):
    points = spark.createDataFrame([([math.sin(i + k) for k in range(4)],) for i in range(40)], "vector array<double>")
    units = learning.train_grid(points, (2, 3), 4, sweeps=6)
    learning.save_map(units, str(tmp_path / "map"))
    again = learning.load_map(spark, str(tmp_path / "map"))
    assert sorted(tuple(r) for r in again.collect()) == sorted(tuple(r) for r in units.collect())
    near = learning.best_units(points, units).agg({"distance": "avg"}).first()[0]
    other = learning.best_units(points, learning.train_grid(points, (2, 3), 4, sweeps=0)).agg({"distance": "avg"}).first()[0]
    assert near < other
    (tmp_path / "wrong.txt").write_text("2,2,1\n0.5\n")
    with pytest.raises(ValueError):
        learning.load_map(spark, str(tmp_path / "wrong.txt"))


def test_image_network(spark, tmp_path):
    """Gradients against differences; bars that lie and bars that stand; a round trip."""
    import numpy as np

    from lightfold.operators import network

    rng = np.random.default_rng(1)
    weights = [w.astype(float) for w in network.started(8, (2, 3), 4, 2, rng)]
    x, y = rng.random((3, 8, 8, 1)), np.array([0, 1, 1])

    def loss():
        p = network.forward(weights, x)[0]
        return -np.log(p[np.arange(3), y]).mean() + network.DECAY * sum(float((w * w).sum()) for w in (weights[0], weights[2], weights[-4]))

    p, kept = network.forward(weights, x)
    p[np.arange(3), y] -= 1
    for w, g in zip(weights, network.backward(weights, kept, p / 3), strict=True):
        for _ in range(3):
            i = tuple(rng.integers(0, n) for n in w.shape)
            w[i] += 1e-5
            up = loss()
            w[i] -= 2e-5
            assert (up - loss()) / 2e-5 == pytest.approx(g[i], abs=1e-4)
            w[i] += 1e-5

    rows = []
    for n in range(120):
        picture = (rng.random((12, 12)) < 0.1).astype(float)
        at = rng.integers(1, 11)
        picture[(at, slice(None)) if n % 2 else (slice(None), at)] = 1
        rows.append((n, n % 2, picture.ravel().tolist()))
    data = spark.createDataFrame(rows, "priority long, label int, vector array<double>")
    model = network.ImageNetwork("vector", 12, ["stands", "lies"], filters=(4, 8), hidden=16, epochs=25, rate=5e-3).fit(data.where("priority < 90"))
    told = model.predict(data.where("priority >= 90"), "priority").where("prob > 0.5").collect()
    assert np.mean([(r["class"] == "lies") == (r["priority"] % 2 == 1) for r in told]) > 0.8
    model.save(str(tmp_path / "model"))
    again = learning.load(str(tmp_path / "model"))
    assert [tuple(r) for r in again.predict(data, "priority").orderBy("priority", "class").collect()] == [tuple(r) for r in model.predict(data, "priority").orderBy("priority", "class").collect()]
    again.dropped = True
    sums = again.predict(data.limit(5), "priority").groupBy("priority").sum("prob").collect()
    assert len(sums) == 5 and all(abs(r[1] - 1) < 1e-5 for r in sums)
