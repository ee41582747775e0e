"""Queries of the series operators over ``events``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import quality as q
from ..operators import series as s
from .registry import LC, lightcurve, query, rounded, tidy

PERIOD = 2.5


@query(LC + " SELECT event_id, series_id, quality FROM lc WHERE quality & 259 = 0")
def quality_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lightcurve(spark, sf_dir).where(q.passes(F.col("quality"))).select("event_id", "series_id", "quality")


@query(LC + " SELECT event_id, concat_ws('; ', " + ", ".join(f"CASE WHEN quality & {b} <> 0 THEN '{t}' END" for b, t in q.CORRECTOR.items()) + ") AS meaning FROM lc")
def quality_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lightcurve(spark, sf_dir).select("event_id", F.array_join(q.decode(F.col("quality")), "; ").alias("meaning"))


@query(LC + " SELECT event_id, lpad(bin(quality), 32, '0') AS digits FROM lc")
def quality_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lightcurve(spark, sf_dir).select("event_id", q.binary(F.col("quality")).alias("digits"))


@query(LC + ", m AS (SELECT *, min(t) OVER (PARTITION BY series_id) AS t0 FROM lc) SELECT event_id, series_id, flux FROM m WHERE t - t0 <= 27.4e0")
def truncate_27d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return s.truncated(lightcurve(spark, sf_dir)).select("event_id", "series_id", "flux")


@query(LC + ", m AS (SELECT *, median(flux) OVER (PARTITION BY series_id) AS med FROM lc) SELECT event_id, round((flux / med - 1) * 1e6, 3) + 0.0 AS flux FROM m")
def relative_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(s.relative_ppm(lightcurve(spark, sf_dir)).select("event_id", "flux"), 3)


@query(LC + " SELECT series_id, round(var_samp(flux), 6) + 0.0 AS variance FROM lc GROUP BY 1")
def variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(s.variance(lightcurve(spark, sf_dir)))


_STEPS = ", d AS (SELECT series_id, abs(flux - lag(flux) OVER (PARTITION BY series_id ORDER BY t)) AS step FROM lc)"


@query(LC + _STEPS + " SELECT series_id, round(median(step), 6) + 0.0 AS ptp FROM d GROUP BY 1")
def ptp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(s.point_to_point(lightcurve(spark, sf_dir)).select("series_id", "ptp"))


@query(LC + _STEPS + " SELECT series_id, round(quantile_cont(step, 0.98), 6) + 0.0 AS p2p_98, round(avg(step), 6) + 0.0 AS p2p_mean FROM d GROUP BY 1")
def p2p_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(s.point_to_point(lightcurve(spark, sf_dir)).select("series_id", "p2p_98", "p2p_mean"))


_PHASE = f"(t - floor(t / {PERIOD}e0) * {PERIOD}e0) / {PERIOD}e0"


@query(LC + f", f AS (SELECT series_id, t, flux, {_PHASE} AS phase FROM lc), d AS (SELECT series_id, abs(flux - lag(flux) OVER (PARTITION BY series_id ORDER BY phase, t)) AS step FROM f) SELECT series_id, round(quantile_cont(step, 0.98), 6) + 0.0 AS p2p_98_phasefold, round(avg(step), 6) + 0.0 AS p2p_mean_phasefold FROM d GROUP BY 1")
def phasefold_p2p(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(s.folded_point_to_point(lightcurve(spark, sf_dir), F.lit(PERIOD)))


@query(LC + """, m AS (SELECT *, min(t) OVER w AS t0, max(t) OVER w AS t1 FROM lc WINDOW w AS (PARTITION BY series_id)),
b AS (SELECT series_id, least(floor(t - t0), greatest(ceil(t1 - t0), 1) - 1) AS bin, avg(flux) AS m FROM m GROUP BY 1, 2),
d AS (SELECT series_id, abs(m - median(m) OVER (PARTITION BY series_id)) AS dev FROM b)
SELECT series_id, round(1.482602218505602e0 * median(dev), 6) + 0.0 AS rms FROM d GROUP BY 1""")
def rms_timescale(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(s.rms_timescale(lightcurve(spark, sf_dir), width=1.0))


@query(LC + """, m AS (SELECT *, median(flux) OVER (PARTITION BY series_id) AS med FROM lc)
SELECT series_id, round(any_value(med), 6) + 0.0 AS median, round(1.482602218505602e0 * median(abs(flux - med)), 6) + 0.0 AS sigma FROM m GROUP BY 1""")
def median_mad(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(s.median_mad(lightcurve(spark, sf_dir)))


@query(LC + """, m AS (SELECT series_id, flux - avg(flux) OVER (PARTITION BY series_id) AS d FROM lc)
SELECT series_id, round(avg(d * d * d) / pow(avg(d * d), 1.5e0), 6) + 0.0 AS skewness, round(avg(d * d * d * d) / pow(avg(d * d), 2) - 3, 6) + 0.0 AS kurtosis FROM m GROUP BY 1""")
def moments_skew_kurt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(s.moments(lightcurve(spark, sf_dir)))


@query(LC + """, d AS (SELECT series_id, flux, 1 / flux_err AS w, flux - lag(flux) OVER (PARTITION BY series_id ORDER BY t) AS step FROM lc)
SELECT series_id, round(sum(step * step) / (count(*) - 1) / (sum(w * flux * flux) / sum(w) - pow(sum(w * flux) / sum(w), 2)), 6) + 0.0 AS eta FROM d GROUP BY 1""")
def eta_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(s.eta(lightcurve(spark, sf_dir)))


_LINE = """, x AS (SELECT *, t - min(t) OVER (PARTITION BY series_id) AS x, {w} AS w FROM lc),
k AS (SELECT series_id, (sum(w) * sum(w * x * flux) - sum(w * x) * sum(w * flux)) / (sum(w) * sum(w * x * x) - pow(sum(w * x), 2)) AS slope,
  sum(w) AS s, sum(w * x) AS sx, sum(w * flux) AS sy FROM x GROUP BY 1),
l AS (SELECT series_id, slope, (sy - slope * sx) / s AS level FROM k)"""


@query(LC + _LINE.format(w="1 / (flux_err * flux_err)") + " SELECT series_id, round(slope, 6) + 0.0 AS slope, round(level, 6) + 0.0 AS level FROM l")
def weighted_detrend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(s.trend(lightcurve(spark, sf_dir)))


@query(LC + _LINE.format(w="1e0") + " SELECT event_id, round(flux - level - slope * x, 6) + 0.0 AS flux FROM x JOIN l USING (series_id)")
def unweighted_detrend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(s.detrended(lightcurve(spark, sf_dir), weighted=False).select("event_id", "flux"))


@query(LC + """, m AS (SELECT series_id, t, flux - avg(flux) OVER w AS d, stddev_pop(flux) OVER w AS sd, count(*) OVER w AS n FROM lc WINDOW w AS (PARTITION BY series_id)),
c AS (SELECT series_id, sum(d) OVER (PARTITION BY series_id ORDER BY t ROWS UNBOUNDED PRECEDING) / (n * sd) AS s FROM m)
SELECT series_id, round(max(s) - min(s), 6) + 0.0 AS rcs FROM c GROUP BY 1""")
def rcs_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(s.cumulative_range(lightcurve(spark, sf_dir)))


@query(LC + f""", m AS (SELECT series_id, t, {_PHASE} AS phase, flux - avg(flux) OVER w AS d, stddev_pop(flux) OVER w AS sd, count(*) OVER w AS n FROM lc WINDOW w AS (PARTITION BY series_id)),
c AS (SELECT series_id, sum(d) OVER (PARTITION BY series_id ORDER BY phase, t ROWS UNBOUNDED PRECEDING) / (n * sd) AS s FROM m)
SELECT series_id, round(max(s) - min(s), 6) + 0.0 AS rcs FROM c GROUP BY 1""")
def psi_rcs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(s.cumulative_range(lightcurve(spark, sf_dir), order=s.phase(F.col("t"), F.lit(PERIOD))))


_FILL = """, st AS (SELECT series_id, t, t - lag(t) OVER (PARTITION BY series_id ORDER BY t) AS step FROM lc),
fl AS (SELECT series_id, count(*) AS n, count(*) / ((max(t) - min(t)) / median(step)) AS fill FROM st GROUP BY 1)"""


@query(LC + _FILL + " SELECT series_id, n, round(fill, 6) + 0.0 AS fill FROM fl")
def fill_factor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(s.fill_factor(lightcurve(spark, sf_dir)))


def _crossings_sql(k: int = 5) -> str:
    w = "OVER (PARTITION BY series_id ORDER BY t)"
    ctes = ", y AS (SELECT series_id, t, flux - median(flux) OVER (PARTITION BY series_id) AS d0 FROM lc)"
    for i in range(1, k):
        ctes += f", y{i} AS (SELECT *, d{i - 1} - lag(d{i - 1}) {w} AS d{i} FROM y{i - 1 if i > 1 else ''})"
    flips = ", ".join(f"CASE WHEN d{i} IS NOT NULL AND lag(d{i}) {w} IS NOT NULL THEN CAST((d{i} >= 0) <> (lag(d{i}) {w} >= 0) AS INTEGER) END AS f{i}" for i in range(k))
    ctes += f", fs AS (SELECT series_id, {flips} FROM y{k - 1}), cs AS (SELECT series_id, " + ", ".join(f"coalesce(sum(f{i}), 0) AS c{i}" for i in range(k)) + " FROM fs GROUP BY 1)"
    rate = ", ".join(f"c{i}::DOUBLE / (n - {i}) / ((1 / (1 + exp(-{c}e0 * fill)) - 0.5e0) / (1 / (1 + exp(-{c}e0)) - 0.5e0)) AS zc{i}" for i, c in enumerate(s.CROSSING_FILL[:k]))
    psi = " + ".join(f"pow(zc{i}{f' - zc{i - 1}' if i else ''} - ({g}e0{f' - {s.CROSSING_GAUSS[i - 1]}e0' if i else ''}), 2) / ({g}e0{f' - {s.CROSSING_GAUSS[i - 1]}e0' if i else ''})" for i, g in enumerate(s.CROSSING_GAUSS[:k]))
    return ctes + f", z AS (SELECT series_id, {rate} FROM cs JOIN fl USING (series_id)) SELECT series_id, round({psi}, 6) + 0.0 AS psi, " + ", ".join(f"round(zc{i}, 6) + 0.0 AS zc{i}" for i in range(k)) + " FROM z"


@query(LC + _FILL + _crossings_sql())
def hoc_crossings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(s.crossings(lightcurve(spark, sf_dir)))


def _bins_sql(period: str, src: str = "lc", cut: bool = False, bins: int = 64) -> str:
    """CTE pb(series_id, bin, phase, flux)."""
    phase = f"(t - floor(t / ({period})) * ({period})) / ({period})"
    out = f", p0 AS (SELECT series_id, t, flux, CAST(least(floor({phase} * {bins}), {bins - 1}) AS INTEGER) AS bin FROM {src})"
    if cut:
        out += """, p1 AS (SELECT *, median(flux) OVER w AS m, count(*) OVER w AS n FROM p0 WINDOW w AS (PARTITION BY series_id, bin)),
p2 AS (SELECT *, abs(flux - m) AS d FROM p1), p3 AS (SELECT *, median(d) OVER (PARTITION BY series_id, bin) AS mad FROM p2),
pm AS (SELECT series_id, bin, avg(flux) FILTER (n <= 2 OR mad = 0 OR d <= mad * 5) AS m FROM p3 GROUP BY 1, 2)"""
    else:
        out += ", pm AS (SELECT series_id, bin, avg(flux) AS m FROM p0 GROUP BY 1, 2)"
    return out + f""", pa AS (SELECT series_id, avg(flux) AS mean FROM {src} GROUP BY 1),
pb AS (SELECT series_id, k.bin, (k.bin + 0.5e0) / {bins} AS phase, coalesce(m, mean) AS flux FROM pa CROSS JOIN (SELECT CAST(range AS INTEGER) AS bin FROM range({bins})) k LEFT JOIN pm USING (series_id, bin))"""


@query(LC + _bins_sql(f"{PERIOD}e0") + " SELECT series_id, bin, round(phase, 9) + 0.0 AS phase, round(flux, 9) + 0.0 AS flux FROM pb")
def phase_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(s.phase_bins(lightcurve(spark, sf_dir), F.lit(PERIOD)), 9)


@query(LC + _bins_sql(f"{PERIOD}e0", cut=True) + " SELECT series_id, bin, round(phase, 9) + 0.0 AS phase, round(flux, 9) + 0.0 AS flux FROM pb")
def phase_bins_clipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(s.phase_bins(lightcurve(spark, sf_dir), F.lit(PERIOD), cut=5), 9)


@query(LC + _bins_sql(f"{PERIOD}e0") + """, v AS (SELECT *, min(flux) OVER w AS low, max(flux) OVER w AS high, first_value(bin) OVER (PARTITION BY series_id ORDER BY flux, bin) AS first FROM pb WINDOW w AS (PARTITION BY series_id))
SELECT series_id, CAST((bin - first + 64) % 64 AS INTEGER) AS place, round(CASE WHEN high > low THEN (flux - low) / (high - low) ELSE 1 END, 6) + 0.0 AS value, round(high - low, 6) + 0.0 AS range FROM v""")
def som_input_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(s.shape_vector(lightcurve(spark, sf_dir), F.lit(PERIOD)))


def _period_sql(period: str) -> str:
    """Rows of a series' period, corrected; ``period`` may tell series apart by series_id."""
    return LC + _LINE.format(w="1e0") + ", fd AS (SELECT series_id, t, flux - level - slope * x + 1 AS flux FROM x JOIN l USING (series_id))" + _bins_sql(f"2 * {period}", "fd", cut=True) + f""",
b AS (SELECT *, first_value(phase) OVER w AS bp, first_value(flux) OVER w AS bf FROM pb WINDOW w AS (PARTITION BY series_id ORDER BY flux, bin)),
a AS (SELECT *, abs(phase - (bp + 0.5e0 - floor(bp + 0.5e0))) AS away FROM b),
sec AS (SELECT series_id, min(flux) AS second, any_value(bf) AS first FROM a WHERE away < 0.05e0 OR away > 0.95e0 GROUP BY 1),
e AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY flux, t) AS up, row_number() OVER (PARTITION BY series_id ORDER BY flux DESC, t) AS down FROM fd),
g AS (SELECT series_id, median(flux) FILTER (down <= 30) AS top, median(flux) FILTER (up <= 30) AS bottom, max(t) - min(t) AS span FROM e GROUP BY 1)
SELECT series_id, CASE WHEN second - first > 0.0025e0 AND second - first > 0.03e0 * (top - bottom) AND 2 * {period} <= span / 2 THEN 2 * {period} ELSE {period} END AS period FROM g LEFT JOIN sec USING (series_id)"""


@query(_period_sql(f"{PERIOD}e0"))
def eb_period_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    return s.corrected_period(lightcurve(spark, sf_dir), PERIOD)


@query(_period_sql(f"({PERIOD}e0 + 0.5e0 * (series_id % 3))"))
def eb_period_by_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return s.corrected_period(lightcurve(spark, sf_dir), F.lit(PERIOD) + 0.5 * (F.col("series_id") % 3))


@query(LC + _LINE.format(w="1 / (flux_err * flux_err)") + _STEPS + ", p AS (SELECT series_id, median(step) AS ptp FROM d GROUP BY 1) SELECT series_id, round(abs(slope) / ptp, 6) + 0.0 AS detrend_coeff_norm FROM l JOIN p USING (series_id)")
def detrend_coefficient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The slope taken off by --linfit, over the scatter, as a feature."""
    lc = lightcurve(spark, sf_dir)
    both = s.trend(lc).join(s.point_to_point(lc).select("series_id", "ptp"), "series_id")
    return tidy(both.select("series_id", (F.abs("slope") / F.col("ptp")).alias("detrend_coeff_norm")))


@query(LC + """, m AS (SELECT series_id, flux - avg(flux) OVER (PARTITION BY series_id) AS d FROM lc)
SELECT series_id, round(ln(sqrt(avg(d * d) FILTER (d < 0) / avg(d * d) FILTER (d >= 0))), 6) + 0.0 AS flux_ratio FROM m GROUP BY 1""")
def flux_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(s.flux_ratio(lightcurve(spark, sf_dir)))


@query(LC + """, d AS (SELECT series_id, list_sort(list_filter([""" + ", ".join(f"abs(flux - {f}(flux, {i}) OVER w)" for i in (1, 2, 3) for f in ("lag", "lead")) + """], lambda x: x IS NOT NULL))[3] AS d FROM lc WINDOW w AS (PARTITION BY series_id ORDER BY flux)),
a AS (SELECT series_id, count(*) AS n, avg(CASE WHEN d > 0 THEN ln(d) END) AS m FROM d GROUP BY 1)
SELECT series_id, round(((SELECT sum(1e0 / k.range) FROM range(1, 100000) k WHERE k.range < n) - 1.5e0 + ln(2e0) + m) / ln(2e0), 6) + 0.0 AS entropy FROM a""")
def knn_entropy_1d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(s.neighbour_entropy(lightcurve(spark, sf_dir)))


@query(LC + """, n AS (SELECT series_id, flux, (row_number() OVER (PARTITION BY series_id ORDER BY t) - 1) // 3 AS block FROM lc)
SELECT series_id, block, round(avg(flux), 6) + 0.0 AS flux FROM n GROUP BY 1, 2 HAVING count(*) = 3""")
def coarse_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(s.coarse_grained(lightcurve(spark, sf_dir), 3))


@query(LC + """, m AS (SELECT *, min(t) OVER w AS t0, max(t) OVER w AS t1 FROM lc WINDOW w AS (PARTITION BY series_id)),
b AS (SELECT series_id, CAST(least(floor((t - t0) * 12 / (t1 - t0)), 11) AS INTEGER) AS bin, flux FROM m)
SELECT series_id, bin, count(*) AS n, round(avg(flux), 7) + 0.0 AS mean, round(median(flux), 6) + 0.0 AS median, min(flux) AS least, max(flux) AS most FROM b GROUP BY 1, 2""")
def binned_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = s.binned(lightcurve(spark, sf_dir), 12)
    return b.select("series_id", "bin", "n", rounded(F.col("mean"), 7).alias("mean"), rounded(F.col("median")).alias("median"), "least", "most")


@query(LC + """, g AS (SELECT series_id, min(t) AS t0, max(t) AS t1 FROM lc GROUP BY 1), w AS (SELECT series_id, CAST(k.range AS INTEGER) AS k, t0 + (t1 - t0) * k.range / 40 AS t FROM g CROSS JOIN range(41) k),
n AS (SELECT w.series_id, w.k, w.t, max(lc.t) FILTER (lc.t <= w.t) AS ta, min(lc.t) FILTER (lc.t >= w.t) AS tb FROM w JOIN lc USING (series_id) GROUP BY 1, 2, 3)
SELECT n.series_id, k, round(coalesce(a.flux + (b.flux - a.flux) * CASE WHEN tb > ta THEN (n.t - ta) / (tb - ta) ELSE 0 END, a.flux, b.flux), 5) + 0.0 AS flux
FROM n LEFT JOIN lc a ON a.series_id = n.series_id AND a.t = ta LEFT JOIN lc b ON b.series_id = n.series_id AND b.t = tb""")
def linear_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(s.interpolated(lightcurve(spark, sf_dir), 40), 5)


@query(LC + """, r AS (SELECT series_id, flux, row_number() OVER (PARTITION BY series_id ORDER BY t) AS place, count(*) OVER (PARTITION BY series_id) AS n FROM lc),
f AS (SELECT a.series_id, a.place, a.n, b.flux FROM r a JOIN r b ON a.series_id = b.series_id AND b.place BETWEEN greatest(1, least(a.place - 5, a.n - 10)) AND greatest(1, least(a.place - 5, a.n - 10)) + 10)
SELECT series_id, CAST(place AS INTEGER) AS place, round(CASE WHEN place > 0.8e0 * any_value(n) THEN quantile_cont(flux, 0.98) ELSE quantile_cont(flux, 0.95) END, 6) + 0.0 AS level FROM f GROUP BY series_id, place""")
def moving_percentile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(s.moving_percentile(lightcurve(spark, sf_dir)))


@query(LC + """, r AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY flux DESC, t) AS down, row_number() OVER (PARTITION BY series_id ORDER BY flux, t) AS up, row_number() OVER (PARTITION BY series_id ORDER BY t DESC) AS back FROM lc)
SELECT series_id, round(median(flux) FILTER (down <= 30), 6) + 0.0 AS top, round(median(flux) FILTER (up <= 30), 6) + 0.0 AS bottom, round(median(flux) FILTER (back <= 30), 6) + 0.0 AS latest FROM r GROUP BY 1""")
def extreme_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(s.extremes(lightcurve(spark, sf_dir)))


@query("SELECT event_type, user_id, count(*) AS n FROM events GROUP BY 1, 2 HAVING count(*) > 1")
def duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lightcurve(spark, sf_dir).groupBy("event_type", F.col("series_id").alias("user_id")).agg(F.count("*").alias("n")).where("n > 1")
