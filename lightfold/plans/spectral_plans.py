"""Queries of the spectral operators over ``events``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import series as s
from ..operators import spectrum as p
from .registry import LC, lightcurve, query, rounded, tidy

COUNT = 50
_FIT = """, c0 AS (SELECT series_id, t - min(t) OVER w AS x, max(t) OVER w - min(t) OVER w AS span, flux - avg(flux) OVER w AS y FROM lc WINDOW w AS (PARTITION BY series_id))"""


def _sums_sql(grid: str, by: str) -> str:
    return f""", sc AS (SELECT *, sin(2 * pi() * 0.0864e0 * frequency * x) AS s, cos(2 * pi() * 0.0864e0 * frequency * x) AS c FROM {grid}),
su AS (SELECT {by}, frequency, sum(y * s) AS ys, sum(y * c) AS yc, sum(s * s) AS ss, sum(c * c) AS cc, sum(s * c) AS cs, avg(y * y) AS var FROM sc GROUP BY {by}, frequency),
ab AS (SELECT *, (ys * cc - yc * cs) / (ss * cc - cs * cs) AS alpha, (yc * ss - ys * cs) / (ss * cc - cs * cs) AS beta FROM su)"""


SPECTRUM = LC + _FIT + f""", gr AS (SELECT series_id, x, y, 1e6 / 86400 / span AS step, CAST(k.range AS INTEGER) AS k, 1e6 / 86400 / span * k.range AS frequency FROM c0 CROSS JOIN range(1, {COUNT + 1}) k WHERE span > 0)""" + _sums_sql("gr", "series_id, k, step") + """,
rw AS (SELECT *, greatest(alpha * ys + beta * yc, 0) AS raw FROM ab), nm AS (SELECT *, var / sum(raw) OVER (PARTITION BY series_id) AS norm FROM rw),
ps AS MATERIALIZED (SELECT series_id, k, frequency, alpha, beta, 2 * norm * raw AS power, norm * raw / step AS density, sqrt(2 * norm * raw) AS amplitude FROM nm)"""  # fmt: skip
_TABLE = """, rk AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY amplitude DESC, k) AS num FROM ps),
wa AS (SELECT series_id, CAST(num AS INTEGER) AS num, CAST(h.range AS INTEGER) AS harmonic, k * (h.range + 1) AS kk FROM rk CROSS JOIN range(2) h WHERE num <= 3),
ft AS (SELECT wa.series_id, num, harmonic, frequency, sqrt(alpha * alpha + beta * beta) AS amplitude, atan2(beta, alpha) AS phase FROM wa LEFT JOIN ps ON ps.series_id = wa.series_id AND ps.k = wa.kk)"""


def spectrum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.periodogram(lightcurve(spark, sf_dir), COUNT)


def frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.frequency_table(spectrum(spark, sf_dir))


@query(SPECTRUM + " SELECT series_id, k, round(frequency, 6) + 0.0 AS frequency, round(power, 4) + 0.0 AS power, round(density, 4) + 0.0 AS density, round(amplitude, 4) + 0.0 AS amplitude FROM ps")
def periodogram_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spectrum(spark, sf_dir).select("series_id", "k", rounded(F.col("frequency")).alias("frequency"), *(rounded(F.col(c), 4).alias(c) for c in ("power", "density", "amplitude")))


@query(LC + """, st AS (SELECT series_id, t, t - lag(t) OVER (PARTITION BY series_id ORDER BY t) AS step FROM lc)
SELECT series_id, round(1e6 / 86400 / (max(t) - min(t)), 6) + 0.0 AS df, round(0.5e6 / 86400 / median(step), 6) + 0.0 AS nyquist FROM st GROUP BY 1""")
def frequency_spacing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(p.spacing(lightcurve(spark, sf_dir)))


@query(SPECTRUM + """, bk AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY frequency DESC) AS back FROM ps),
fl AS (SELECT series_id, median(density) FILTER (back <= 20) / pow(1 - 2e0 / 18, 3) AS w, avg(density) FILTER (frequency BETWEEN 0.7 AND 15) AS f07, avg(density) FILTER (frequency BETWEEN 7 AND 15) AS f7, avg(density) FILTER (frequency BETWEEN 0 AND 28) AS fhi FROM bk GROUP BY 1)
SELECT series_id, round(w, 4) + 0.0 AS FpWhite, round(f07 - w, 4) + 0.0 AS Fp07, round(f7 - w, 4) + 0.0 AS Fp7, round(fhi - w, 4) + 0.0 AS Fphi FROM fl""")
def fliper_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(p.fliper(spectrum(spark, sf_dir), top=15.0, tail=20).select("series_id", "FpWhite", "Fp07", "Fp7", "Fphi"), 4)


@query(LC + _FIT + ", gr AS (SELECT *, 2e0 AS frequency FROM c0)" + _sums_sql("gr", "series_id") + " SELECT series_id, round(alpha, 6) + 0.0 AS alpha, round(beta, 6) + 0.0 AS beta, round(sqrt(alpha * alpha + beta * beta), 6) + 0.0 AS amplitude, round(atan2(beta, alpha), 6) + 0.0 AS phase FROM ab")
def sine_fit_alpha_beta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(p.alpha_beta(lightcurve(spark, sf_dir), 2.0))


@query(SPECTRUM + _TABLE + """, tk AS (SELECT series_id, frequency, row_number() OVER (PARTITION BY series_id ORDER BY amplitude DESC, num, harmonic) AS place FROM ft WHERE amplitude IS NOT NULL),
sp AS (SELECT series_id, max(t) - min(t) AS span FROM lc GROUP BY 1)
SELECT sp.series_id, CAST(g.range AS INTEGER) AS place, round(CASE WHEN frequency IS NULL THEN span ELSE 1e6 / 86400 / frequency END, 6) + 0.0 AS value
FROM sp CROSS JOIN range(1, 9) g LEFT JOIN tk ON tk.series_id = sp.series_id AND tk.place = g.range""")
def top_k_frequencies_padded(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = s.clean(lightcurve(spark, sf_dir)).groupBy("series_id").agg((F.max("t") - F.min("t")).alias("span"))
    return tidy(p.top_frequencies(frequencies(spark, sf_dir), spans, count=8))


def _main(n: int, c: str) -> str:
    return f"max({c}) FILTER (num = {n} AND harmonic = 0)"


@query(SPECTRUM + _TABLE + " SELECT series_id, " + ", ".join(f"round({_main(n, 'amplitude')} / {_main(1, 'amplitude')}, 6) + 0.0 AS ampratio{n}1, round({_main(n, 'phase')} - {n} * {_main(1, 'phase')}, 5) + 0.0 AS phasediff{n}1" for n in (2, 3)) + " FROM ft GROUP BY 1")
def amplitude_phase_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = p.ratios(frequencies(spark, sf_dir))
    return r.select("series_id", *(rounded(F.col(c), 6 if c[0] == "a" else 5).alias(c) for c in r.columns[1:]))


_SHORT = (("frequency", "freq"), ("amplitude", "amp"), ("phase", "phase"))


@query(SPECTRUM + _TABLE + " SELECT series_id, " + ", ".join(f"round(max({c}) FILTER (num = {n} AND harmonic = {h}), 5) + 0.0 AS {short}{n}{f'_harmonic{h}' if h else ''}" for n in (1, 2, 3) for h in (0, 1) for c, short in _SHORT) + " FROM ft GROUP BY 1")
def freq_table_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(p.table_to_columns(frequencies(spark, sf_dir), 3, 1), 5)


@query(SPECTRUM + _TABLE + " SELECT series_id, num, harmonic, " + ", ".join(f"round({c}, 5) + 0.0 AS {c}" for c, _ in _SHORT) + ", round(amplitude * cos(phase), 5) + 0.0 AS alpha, round(amplitude * sin(phase), 5) + 0.0 AS beta FROM ft")
def freq_table_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(p.columns_to_table(p.table_to_columns(frequencies(spark, sf_dir), 3, 1)).drop("deviation"), 5)


@query(SPECTRUM + _TABLE + """, vr AS (SELECT series_id, var_samp(flux) AS variance FROM lc GROUP BY 1)
SELECT series_id, round((any_value(variance) - sum(amplitude * amplitude / 2)) / any_value(variance), 6) + 0.0 AS varrat, count(*) FILTER (harmonic > 0 AND amplitude IS NOT NULL) AS number_significantharmonic FROM ft JOIN vr USING (series_id) WHERE num = 1 GROUP BY 1""")
def variance_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = frequencies(spark, sf_dir).join(s.variance(lightcurve(spark, sf_dir)), "series_id")
    return tidy(p.harmonic_power(joined).select("series_id", "varrat", "number_significantharmonic"))


_BINS, _LOW, _HIGH = 16, 0.5, 20.0


@query(SPECTRUM + f""", z0 AS (SELECT series_id, log10(frequency) AS lx, log10(density) AS v FROM ps WHERE density > 0),
z1 AS (SELECT series_id, lx, (v - avg(v) OVER w) / stddev_pop(v) OVER w AS v FROM z0 WINDOW w AS (PARTITION BY series_id)),
kx AS (SELECT log10({_LOW}e0) AS a, (log10({_HIGH}e0) - log10({_LOW}e0)) / {_BINS} AS w),
ed AS (SELECT DISTINCT series_id, CAST(e.range AS INTEGER) AS e, a + e.range * w AS lx, CAST(NULL AS DOUBLE) AS v FROM z1 CROSS JOIN range({_BINS + 1}) e CROSS JOIN kx),
bo AS (SELECT series_id, CAST(NULL AS INTEGER) AS e, lx, v FROM z1 UNION ALL SELECT * FROM ed),
lr AS (SELECT *, last_value(CASE WHEN v IS NOT NULL THEN lx END IGNORE NULLS) OVER b AS l, last_value(v IGNORE NULLS) OVER b AS lv, first_value(CASE WHEN v IS NOT NULL THEN lx END IGNORE NULLS) OVER f AS r, first_value(v IGNORE NULLS) OVER f AS rv
  FROM bo WINDOW b AS (PARTITION BY series_id ORDER BY lx, e NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), f AS (PARTITION BY series_id ORDER BY lx, e NULLS FIRST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
fi AS (SELECT series_id, e, lx, CASE WHEN v IS NOT NULL THEN v WHEN l IS NULL OR r IS NULL THEN 0 ELSE lv + (rv - lv) * (CASE WHEN r > l THEN (lx - l) / (r - l) ELSE 0 END) END AS v FROM lr),
sa AS (SELECT series_id, v, e AS x FROM fi WHERE e IS NOT NULL UNION ALL SELECT series_id, v, e - 1 FROM fi WHERE e IS NOT NULL UNION ALL SELECT series_id, v, CAST(floor((lx - a) / w) AS INTEGER) FROM fi CROSS JOIN kx WHERE e IS NULL),
li AS (SELECT series_id, x, least(greatest(CAST(floor((min(v) + 5) / (10e0 / {_BINS})) AS INTEGER), 0), {_BINS}) AS i, least(greatest(CAST(ceil((max(v) + 5) / (10e0 / {_BINS})) AS INTEGER), 0), {_BINS}) AS j FROM sa WHERE x BETWEEN 0 AND {_BINS - 1} GROUP BY 1, 2)
SELECT series_id, x, CAST({_BINS - 1} - y.range AS INTEGER) AS y FROM li JOIN range({_BINS}) y ON y.range >= i AND y.range < j""")
def spectrum_image_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.image(spectrum(spark, sf_dir), bins=_BINS, low=_LOW, high=_HIGH)
