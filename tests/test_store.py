import json

import pytest

from lightfold.schemas import RESULT
from lightfold.sources import lightcurves, targets
from lightfold.store import DiagnosticsNotAvailableError, Store
from lightfold.streaming.results import follow

PROBS = {"SOLARLIKE": 0.2, "DSCT_BCEP": 0.1, "ECLIPSE": 0.7}


def _message(priority, classifier, status=1, tset="keplerq9v3", probs=PROBS):
    return (priority, classifier, tset, status, 3.14, 1.0, ["one", "two"] if status == 2 else [], probs, {"v": 1.5}, {"f1": 2.0})


@pytest.fixture
def store(spark, tmp_path):
    rows = spark.createDataFrame([(17, "a\\b.txt", 1.0), (26, "c.txt", None)], "priority long, lightcurve string, tmag double")
    return Store.create(spark, str(tmp_path / "store"), rows)


def _save(store, *rows):
    store.save(store.spark.createDataFrame(list(rows), RESULT))


def test_defaults(store):
    a, b = store.read("todolist").orderBy("priority").collect()
    assert (a["starid"], a["datasource"], a["camera"], a["cbv_area"], b["tmag"]) == (17, "ffi", 1, 111, -99.0)
    assert {r["lightcurve"] for r in store.read("diagnostics_corr").collect()} == {"a/b.txt", "c.txt"}
    with pytest.raises(FileNotFoundError):
        Store(store.spark, store.path + "-none")
    with pytest.raises(ValueError):
        Store.create(store.spark, store.path + "-2", store.read("todolist").select("priority"))


def test_life_of_tasks(store):
    assert (store.number_of_tasks(), store.number_of_tasks("rfgc")) == (10, 2)
    first = store.next_tasks("rfgc", chunk=1)
    assert first.first()["priority"] == 17
    store.start(first)
    with pytest.raises(ValueError):
        store.start(first)
    assert store.next_tasks("rfgc").first()["priority"] == 26 and store.number_of_tasks() == 9
    store.reset_started()
    assert store.number_of_tasks() == 10
    _save(store, *(_message(17, c, 2 if c == "xgb" else 1) for c in ("rfgc", "slosh", "xgb", "sortinghat")))
    meta = store.next_tasks("meta").collect()
    assert [r["priority"] for r in meta] == [17] and {x["classifier"] for x in meta[0]["other_classifiers"]} == {"rfgc", "slosh", "sortinghat"}
    assert store.read("diagnostics", "xgb").first()["errors"] == "one\ntwo"
    _save(store, _message(17, "rfgc", probs={"ECLIPSE": 1.0}))
    assert [tuple(r) for r in store.read("results", "rfgc").select("class", "prob").collect()] == [("ECLIPSE", 1.0)]


def test_bad_results(store):
    _save(store, _message(17, "rfgc"))
    for row in (_message(26, "rfgc", tset="tdasim"), _message(26, "rfgc", probs={"NONE": 0.5}), _message(26, "rfgc", probs={"ECLIPSE": 1.5})):
        with pytest.raises(ValueError):
            _save(store, row)
    assert store.read("results").count() == 3


def test_final_class(store):
    with pytest.raises(DiagnosticsNotAvailableError):
        store.assign_final_class(None)
    _save(store, _message(17, "meta"), _message(26, "meta", 2))
    for limit, name in ((0.6, "ECLIPSE"), (0.8, "UNKNOWN"), (0.6, "ECLIPSE")):
        store.assign_final_class({"ECLIPSE": limit})
        assert {r["priority"]: r["final_class"] for r in store.read("todolist").collect()} == {17: name, 26: None}


def test_features(store):
    _save(store, _message(17, "rfgc"))
    assert store.features("rfgc").columns == ["priority", "f1"] and store.features("common").first()["v"] == 1.5
    store.save_features("rfgc", store.spark.createDataFrame([(26, {"f2": 3.0})], "priority long, features map<string,double>"))
    rows = {r["priority"]: r for r in store.features("rfgc").collect()}
    assert rows[26]["f2"] == 3.0 and rows[26]["f1"] != rows[26]["f1"]
    with pytest.raises(ValueError):
        store.save_features("meta", store.read("features", "rfgc"))
    store.clear_features()
    assert not store.has("features", "rfgc")


def test_overwrite_keeps_features(store):
    _save(store, _message(17, "rfgc"))
    again = Store(store.spark, store.path, overwrite=True)
    assert again.read("results").isEmpty() and again.has("features", "rfgc") and again.number_of_tasks() == 10


def test_changes_write_their_rows_alone(store, monkeypatch):
    from lightfold import store as module

    monkeypatch.setattr(module, "STEPS", 3)
    where = f"{store.path}/results/rfgc"
    for n in range(6):
        _save(store, _message(17 if n % 2 else 26, "rfgc", probs={"ECLIPSE": n / 10}))
        assert len(store._versions(where)) <= 4
        rows = {r["priority"]: r["prob"] for r in store.read("results", "rfgc").collect()}
        assert rows[17 if n % 2 else 26] == n / 10 and len(rows) == min(n + 1, 2)
    assert sum(v[0] == "v" for v in store._versions(where)) == 1


def test_frozen_features(store):
    first = store.spark.createDataFrame([(17, {"f1": 1.0, "f2": 2.0})], "priority long, features map<string,double>")
    store.save_features("rfgc", first, frozen=True)
    store.save_features("rfgc", store.spark.createDataFrame([(26, {"f1": 1.0, "f2": 3.0, "f3": 4.0})], first.schema), frozen=True)
    assert store.features("rfgc").columns == ["priority", "f1", "f2"]
    with pytest.raises(ValueError):
        store.save_features("rfgc", store.spark.createDataFrame([(30, {"f1": 1.0})], first.schema), frozen=True)


def test_backup(store, tmp_path):
    copy = str(tmp_path / "copy")
    kept = Store(store.spark, store.path, cached=True, backup=copy, backup_interval=2)
    _save(kept, _message(17, "rfgc"))
    with pytest.raises(FileNotFoundError):
        Store(store.spark, copy)
    assert kept.read("results", "rfgc").count() == 3 and kept._kept
    _save(kept, _message(26, "rfgc"))
    assert Store(store.spark, copy).read("results").count() == 6
    _save(kept, _message(26, "xgb"))
    assert kept.read("results").count() == 9
    kept.close()
    assert not kept._kept and Store(store.spark, copy).read("results").count() == 9


def test_json_documents(tmp_path):
    import numpy as np

    from lightfold.schemas import Status
    from lightfold.sources.documents import load_json, save_json

    value = {"a": np.arange(2), "b": np.float64(0.5), "c": Status.OK, "é": [None, True]}
    for name in ("d.json", "d.json.gz"):
        save_json(str(tmp_path / name), value)
        assert load_json(str(tmp_path / name)) == {"a": [0, 1], "b": 0.5, "c": 1, "é": [None, True]}
    with pytest.raises(TypeError):
        save_json(str(tmp_path / "x.json"), object())


def test_newest_message_counts(store, tmp_path):
    import os

    folder = tmp_path / "in"
    folder.mkdir()
    for name, at, prob in (("b.json", 100, 0.1), ("a.json", 200, 0.9)):
        rows = [_message(17, "rfgc", probs={"ECLIPSE": prob - 0.05}), _message(17, "rfgc", probs={"ECLIPSE": prob})]
        (folder / name).write_text("\n".join(json.dumps(dict(zip(RESULT.names, r, strict=True))) for r in rows))
        os.utime(folder / name, (at, at))
    follow(store, str(folder), str(tmp_path / "check")).awaitTermination(60)
    assert [r["prob"] for r in store.read("results", "rfgc").collect()] == [0.9]


def test_scaled_fits_columns():
    import numpy as np

    header = {"TSCAL1": 0.5, "TZERO1": 10, "TNULL1": 7, "TZERO2": 32768, "TZERO3": 2**63}
    assert lightcurves._scaled(np.array([2, 7], np.int16), header, 1).tolist()[0] == 11.0 and np.isnan(lightcurves._scaled(np.array([2, 7], np.int16), header, 1)[1])
    assert lightcurves._scaled(np.array([-32768, 32767], np.int16), header, 2).tolist() == [0, 65535]
    assert lightcurves._scaled(np.array([-(2**63), 0], np.int64), header, 3).tolist() == [0, 2**63]
    assert lightcurves._scaled(np.array([1.5]), header, 4).tolist() == [1.5]


def test_stream(store, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.json").write_text("\n".join(json.dumps(dict(zip(RESULT.names, _message(17, c), strict=True))) for c in ("rfgc", "xgb")))
    follow(store, str(folder), str(tmp_path / "check")).awaitTermination(60)
    assert store.read("results").count() == 6


def test_text_curves(spark, tmp_path):
    (tmp_path / "a.noisy").write_text("# head\n 1.0  2.0 0.1 4\n1.5 nan 0.1 0\n")
    (tmp_path / "b.noisy").write_text("1.0 2.0 0.1\n")
    rows = lightcurves.read_text(spark, str(tmp_path)).orderBy("path", "time").collect()
    assert [r["quality"] for r in rows] == [4, 0, 0] and rows[0]["flux"] == 2.0
    found = lightcurves.files(spark, str(tmp_path), pattern=r".*\.noisy$").collect()
    assert [(r["priority"], r["name"]) for r in found] == [(1, "a.noisy"), (2, "b.noisy")]


def _fits(telescope="TESS", corrected=True):
    import numpy as np

    def header(cards):
        text = "".join(f"{k:<8}= {v:<70}" for k, v in cards) + f"{'END':<80}"
        return (text + " " * (-len(text) % 2880)).encode()

    names = ["TIME", "FLUX_CORR" if corrected else "OTHER", "FLUX_CORR_ERR", "QUALITY", "PDCSAP_FLUX"]
    rows = np.zeros(3, [("TIME", ">f8"), ("FLUX_CORR", ">f4"), ("FLUX_CORR_ERR", ">f4"), ("QUALITY", ">i4"), ("PDCSAP_FLUX", ">f4")])
    rows["TIME"], rows["FLUX_CORR"], rows["PDCSAP_FLUX"] = [1, 2, 3], [10, 20, 30], [100, 200, 300]
    forms = ["D", "E", "E", "J", "E"]
    table = [("XTENSION", "'BINTABLE'"), ("BITPIX", 8), ("NAXIS", 2), ("NAXIS1", rows.itemsize), ("NAXIS2", 3), ("PCOUNT", 0), ("GCOUNT", 1), ("TFIELDS", 5)]
    for n, (name, form) in enumerate(zip(names, forms, strict=True), 1):
        table += [(f"TTYPE{n}", f"'{name}'"), (f"TFORM{n}", f"'{form}'")]
    body = rows.tobytes()
    return header([("SIMPLE", "T"), ("BITPIX", 8), ("NAXIS", 0), ("TELESCOP", f"'{telescope}'"), ("TICID", 29281992)]) + header(table) + body + b"\0" * (-len(body) % 2880)


def test_fits_curves(spark, tmp_path):
    import gzip

    (tmp_path / "x.fits.gz").write_bytes(gzip.compress(_fits()))
    rows = lightcurves.read_fits_curves(spark, str(tmp_path)).orderBy("time").collect()
    assert [(r["targetid"], r["time"], r["flux"]) for r in rows] == [(29281992, 1.0, 10.0), (29281992, 2.0, 20.0), (29281992, 3.0, 30.0)]
    assert lightcurves.curve(_fits(corrected=False))["flux"].tolist() == [-500000.0, 0.0, 500000.0]
    with pytest.raises(ValueError):
        lightcurves.curve(_fits(telescope="OTHER"))


def test_target_lists(spark, tmp_path):
    (tmp_path / "t.ecsv").write_text("# comment\nstarname label tmag\n123 SOLARLIKE;ECLIPSE 7.5\nconstant_4 INSTRUMENT 1\n")
    rows = targets.without_class(targets.read_ecsv(spark, str(tmp_path / "t.ecsv"))).collect()
    assert [(r["starname"], r["tmag"], r["starid"]) for r in rows] == [("123", 7.5, None)]
    (tmp_path / "s.csv").write_text("# c\nStar1,5.0,120,27,1,2,6000,10,4,0.1,RRab; multi\nStar2,5.0,120,27,1,2,6000,10,4,0.1,roAp\n")
    (tmp_path / "d.csv").write_text("1.0,2.0,3.0\n4.0,5.0,6.0\n")
    rows = targets.read_simulations(spark, str(tmp_path / "s.csv"), str(tmp_path / "d.csv")).collect()
    assert [(r["starid"], r["known_class"], r["ptp"], r["lightcurve"]) for r in rows] == [(1, "RRLYR_CEPHEID;ECLIPSE", 3.0, "Star1.sysnoise")]
