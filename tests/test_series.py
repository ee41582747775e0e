import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lightfold.functions import quality
from lightfold.operators import prewhiten, series, spectrum

SCHEMA = "series_id long, t double, flux double, flux_err double, quality long"


def _frame(spark, *curves):
    rows = [(i, float(t), None if f is None else float(f), 1.0, 0) for i, c in enumerate(curves) for t, f in c]
    return spark.createDataFrame(rows, SCHEMA)


def test_quality(spark):
    q = spark.createDataFrame([(66,), (2051,), (0,), (259,)], "q long")
    rows = q.select(quality.binary(F.col("q")), quality.decode(F.col("q")), quality.passes(F.col("q"))).collect()
    assert rows[0][0] == "0" * 24 + "01000010" and rows[1][0] == "00000000000000000000100000000011"
    assert rows[0][1] == ["Manual exclude", "Jump corrected using multiplicative linear trend"]
    assert [r[2] for r in rows] == [False, False, True, False]


def test_constant_and_missing(spark):
    flat = [(k / 48, 5.0) for k in range(100)]
    lc = _frame(spark, flat, [(k / 48, float("nan")) for k in range(10)])
    assert [r["rms"] for r in series.rms_timescale(lc).orderBy("series_id").collect()] == [0.0, None]
    assert [r["ptp"] for r in series.point_to_point(lc).collect()] == [0.0]


def test_one_bin(spark):
    rng = np.random.default_rng(0)
    lc = _frame(spark, [(t, rng.normal()) for t in np.sort(rng.uniform(0, 27, 200))])
    assert series.rms_timescale(lc, width=30).first()["rms"] == 0.0


def test_trend_is_found(spark):
    lc = _frame(spark, [(k / 10, 1234 + 500 * k / 10) for k in range(100)])
    row = series.trend(lc).first()
    assert row["slope"] == pytest.approx(500) and row["level"] == pytest.approx(1234)
    assert series.detrended(lc).agg(F.max(F.abs("flux"))).first()[0] < 1e-6


def test_flux_at_the_mean_is_above_it_in_any_order(spark):
    rng = np.random.default_rng(2)
    cents = []
    while len(cents) < 40:  # series of 13 with one flux at the exact mean
        c = rng.integers(1, 30000, 11).tolist()
        total = sum(c)
        last = -total % 12 + 12 * int(rng.integers(1, 1500))
        cents.append([*c, last, (total + last) // 12])
    want = []
    for c in cents:
        d = [13 * x - sum(c) for x in c]
        assert 0 in d
        low, high = [x * x for x in d if x < 0], [x * x for x in d if x >= 0]
        want.append(math.log(math.sqrt(sum(low) / len(low) / (sum(high) / len(high)))))
    for order in (1, -1):
        lc = _frame(spark, *([(t, x / 100) for t, x in enumerate(c[::order])] for c in cents))
        got = [r["flux_ratio"] for r in series.flux_ratio(lc).orderBy("series_id").collect()]
        assert got == pytest.approx(want, rel=1e-9)


def test_entropy_against_brute_force(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=40)
    d = np.sort(np.abs(x[:, None] - x), 1)[:, 3]
    digamma = lambda n: sum(1 / k for k in range(1, n)) - 0.5772156649015329
    want = (digamma(40) - digamma(3) + math.log(2) + np.log(d).mean()) / math.log(2)
    lc = _frame(spark, list(enumerate(x)))
    assert series.neighbour_entropy(lc).first()["entropy"] == pytest.approx(want)


T = np.arange(0, 27, 1800 / 86400)


def _sine(f, a, phi=0.0):
    return a * np.sin(2 * np.pi * f * 0.0864 * T + phi)


def test_two_sines():
    y = _sine(50, 10) + _sine(100, 2) + np.random.RandomState(42).normal(0, 2, len(T))
    tab = prewhiten.extract(T, y, peaks=5, deviation=None)
    assert len(tab) == 5 and tab["frequency"][:2].tolist() == pytest.approx([50, 100], abs=0.01, rel=1e-3)
    assert tab["amplitude"][:2].tolist() == pytest.approx([10, 2], abs=0.1, rel=0.1) and tab["amplitude"][2:].isna().all()
    np.testing.assert_allclose(np.hypot(tab["alpha"], tab["beta"])[:2], tab["amplitude"][:2])


def test_noise_has_no_sines():
    tab = prewhiten.extract(T, np.random.RandomState(42).normal(0, 2, len(T)), peaks=3)
    assert tab[["frequency", "amplitude", "phase"]].isna().all().all()


def test_strongest_first():
    y = _sine(50, 5) + _sine(100, 3) + _sine(89, 2) + _sine(91.3, 12, 0.32) + _sine(182.6, 4)
    tab = prewhiten.extract(T, y, peaks=4, harmonics=2, refit=5, deviation=None)
    first = tab.iloc[0]
    assert (first["num"], first["harmonic"]) == (1, 0) and len(tab) == 12
    assert first["frequency"] == pytest.approx(91.3, rel=1e-3) and first["amplitude"] == pytest.approx(12, abs=0.1, rel=0.1) and first["phase"] == pytest.approx(0.32, abs=0.05)


def test_empty_and_flat():
    assert prewhiten.extract(np.zeros(0), np.zeros(0), peaks=2)["frequency"].isna().all()
    assert prewhiten.extract(T, np.ones(len(T)), peaks=2)["frequency"].isna().all()


def test_spectrum_matches_fit(spark):
    y = _sine(20, 3) + 1
    lc = _frame(spark, list(zip(T[:300], y[:300], strict=True)))
    rows = spectrum.periodogram(lc, 20).orderBy("k").collect()
    own = prewhiten.Spectrum(T[:300], y[:300])
    _, _, raw = own.fit(np.array([r["frequency"] for r in rows]))
    got = np.array([r["power"] for r in rows])
    np.testing.assert_allclose(got / got.sum(), raw / raw.sum(), rtol=1e-6, atol=1e-9)


def test_feature_sets_reach_nyquist(spark, monkeypatch):
    from lightfold.plans import feature_plans

    t = np.arange(480) / 48
    y = 3 * np.sin(2 * np.pi * 0.0864 * 200 * t) + np.sin(2 * np.pi * 0.0864 * 90 * t) + 0.1 * np.random.default_rng(2).normal(size=480)
    monkeypatch.setattr(feature_plans, "lightcurve", lambda *_: _frame(spark, list(zip(t, y, strict=True)), [(0, 1), (1, 2)]))
    _, power, found = feature_plans._parts(spark, "")
    rows = power.collect()
    df, nyquist = 1e6 / 86400 / t[-1], 24e6 / 86400
    assert {r["series_id"] for r in rows} == {0}
    assert nyquist - df <= max(r["frequency"] for r in rows) <= nyquist
    best = {r["num"]: r["frequency"] for r in found.where("series_id = 0 AND harmonic = 0").collect()}
    assert [best[1], best[2]] == pytest.approx([200, 90], abs=0.5)
    wide = feature_plans.features_common(spark, "").where("series_id = 0").first()
    assert all(wide[c] is not None for c in ("Fp07", "Fp7", "Fp20", "Fp50", "Fplo"))


def test_columns_round_trip(spark):
    lc = _frame(spark, list(zip(T[:200], _sine(20, 3)[:200], strict=True)))
    table = spectrum.frequency_table(spectrum.periodogram(lc, 12), peaks=2, harmonics=1)
    back = spectrum.columns_to_table(spectrum.table_to_columns(table, 2, 1))
    a = {(r["num"], r["harmonic"]): r["alpha"] for r in table.collect()}
    b = {(r["num"], r["harmonic"]): r["alpha"] for r in back.collect()}
    assert a.keys() == b.keys() and all((a[k] is None) == (b[k] is None) and (a[k] is None or a[k] == pytest.approx(b[k])) for k in a)


def test_shape_statistics():
    x = np.random.RandomState(3).normal(size=50)
    assert 0.9 < prewhiten.shapiro_w(x) <= 1 and prewhiten.shapiro_w(np.exp(2 * x)) < 0.7
    assert math.isnan(prewhiten.shapiro_w(np.ones(9)))
    assert prewhiten.sample_entropy(np.tile([1.0, 2.0], 50)) < 0.1


def test_period_column_and_negative_periods(spark):
    """Unlike minima double the period, each series by its own; a negative period stays."""
    rows = []
    for t in range(400):
        x = t / 10
        eclipse = lambda p, d: d if abs((x / 4 - p + 0.5) % 1 - 0.5) < 0.03 else 0.0  # noqa: B023, E731
        rows += [(1, x, 1 - eclipse(0, 0.5) - eclipse(0.5, 0.2), 0.1), (2, x, 1 - eclipse(0, 0.5) - eclipse(0.5, 0.5), 0.1), (3, x, 1.0 + t % 2, 0.1)]
    lc = spark.createDataFrame(rows, "series_id long, t double, flux double, flux_err double").withColumn("p", F.when(F.col("series_id") == 3, -1.0).otherwise(2.0))
    got = {r["series_id"]: r["period"] for r in series.corrected_period(lc, F.col("p")).collect()}
    assert got == {1: 4.0, 2: 2.0, 3: -1.0}
    assert {r["period"] for r in series.corrected_period(lc.where("series_id = 1"), 2.0).collect()} == {4.0}


def test_multiples_and_noise_width():
    import numpy as np

    from lightfold.operators.prewhiten import ANGLE, extract

    t = np.arange(0, 27, 1 / 48)
    f = 50.0
    y = 100 * np.sin(ANGLE * f * t) + 30 * np.sin(ANGLE * 1.5 * f * t) + np.random.default_rng(1).normal(0, 1, len(t))
    found = extract(t, y, peaks=1, harmonics=1, multiples=[1.5], refit=0)
    assert found["frequency"].tolist() == pytest.approx([f, 1.5 * f], abs=0.05) and found["amplitude"].tolist() == pytest.approx([100, 30], abs=2)
    with pytest.raises(ValueError):
        extract(t, y, harmonics=2, multiples=[2])
    assert extract(t, y, peaks=1, snr=1e6, snr_width=100.0, alarm=None)["frequency"].isna().all()


def test_entropies():
    import numpy as np

    from lightfold.operators.prewhiten import joint_entropy, mean_digamma, neighbours_within

    rng = np.random.default_rng(2)
    x = rng.normal(0, 1, (3000, 2))
    assert joint_entropy(x[:, :1]) == pytest.approx(0.5 * np.log2(2 * np.pi * np.e), abs=0.08)
    assert joint_entropy(x) - joint_entropy(x[:, 1:]) == pytest.approx(0.5 * np.log2(2 * np.pi * np.e), abs=0.12)
    few = np.array([[0.0], [1.0], [3.0]])
    assert neighbours_within(few, np.array([1.0, 1.0, 5.0])).tolist() == [2, 2, 3]
    assert mean_digamma(few, np.full(3, 10.0)) == pytest.approx(1.5 - 0.5772156649)


def test_false_alarm_against_the_series_form(spark):
    import numpy as np

    from lightfold.operators import spectrum as sp
    from lightfold.operators.prewhiten import Spectrum

    rng = np.random.default_rng(3)
    t = np.sort(rng.uniform(0, 20, 300))
    y = np.sin(t) + rng.normal(0, 2, 300)
    own = Spectrum(t, y)
    for f in (1.8, 5.0, 9.0):
        z = own.fit(f)[2][0] / own.total
        top = 5 * 0.5 * len(t) / (t.max() - t.min())
        got = spark.range(1).select(sp.false_alarm(F.lit(float(z)), F.lit(len(t)), F.lit(float(t.std())), F.lit(float(top)))).first()[0]
        assert got == pytest.approx(own.false_alarm(f), abs=1e-6)
