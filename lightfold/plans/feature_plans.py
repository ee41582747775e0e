"""Queries of whole feature sets over ``events``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import features, prewhiten, spectrum
from .registry import LC, lightcurve, query, rounded, tidy
from .spectral_plans import _FIT, _sums_sql


def _parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    lc = lightcurve(spark, sf_dir)
    power = spectrum.periodogram(lc, None)
    return lc, power, prewhiten.prewhitened(lc, peaks=6, harmonics=5, refit=5, deviation=None)


#: Spectra on all steps under each series' own Nyquist frequency.
_WHOLE = (
    LC + _FIT + """, sp AS (SELECT series_id, t, t - lag(t) OVER (PARTITION BY series_id ORDER BY t) AS dt FROM lc),
nf AS (SELECT series_id, 1e6 / 86400 / (max(t) - min(t)) AS df, 0.5e6 / 86400 / median(dt) AS nyquist FROM sp GROUP BY 1),
gr AS (SELECT c0.series_id, x, y, 1e6 / 86400 / span AS step, CAST(k.range AS INTEGER) AS k, 1e6 / 86400 / span * k.range AS frequency
  FROM c0 JOIN nf USING (series_id) CROSS JOIN range(1, (SELECT CAST(max(ceil(nyquist / df)) AS BIGINT) FROM nf)) k WHERE span > 0 AND k.range <= ceil(nyquist / df) - 1)"""
    + _sums_sql("gr", "series_id, k, step")
    + """, rw AS (SELECT *, greatest(alpha * ys + beta * yc, 0) AS raw FROM ab), nm AS (SELECT *, var / sum(raw) OVER (PARTITION BY series_id) AS norm FROM rw),
ps AS MATERIALIZED (SELECT series_id, frequency, norm * raw / step AS density FROM nm)"""
)


@query(_WHOLE + " SELECT series_id, round(frequency, 6) + 0.0 AS frequency, round(density, 4) + 0.0 AS density FROM ps")
def periodogram_to_nyquist(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spectrum.periodogram(lightcurve(spark, sf_dir), None)
    return found.select("series_id", rounded(F.col("frequency")).alias("frequency"), rounded(F.col("density"), 4).alias("density"))


_BANDS = {"Fp07": "0.7 AND 277", "Fp7": "7 AND 277", "Fp20": "20 AND 277", "Fp50": "50 AND 277", "Fphi": "0 AND 28", "Fplo": "250 AND 277"}


@query(
    _WHOLE + """, bk AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY frequency DESC) AS back FROM ps),
fl AS (SELECT series_id, median(density) FILTER (back <= 100) / pow(1 - 2e0 / 18, 3) AS w, """ + ", ".join(f"avg(density) FILTER (frequency BETWEEN {b}) AS {n}" for n, b in _BANDS.items()) + """ FROM bk GROUP BY 1),
va AS (SELECT series_id, var_samp(flux) AS variance FROM lc GROUP BY 1),
de AS (SELECT series_id, abs(flux - lag(flux) OVER (PARTITION BY series_id ORDER BY t)) AS step FROM lc), pt AS (SELECT series_id, median(step) AS ptp FROM de GROUP BY 1),
m0 AS (SELECT *, min(t) OVER w AS t0, max(t) OVER w AS t1 FROM lc WINDOW w AS (PARTITION BY series_id)),
b0 AS (SELECT series_id, least(floor((t - t0) / (3600e0 / 86400)), greatest(ceil((t1 - t0) / (3600e0 / 86400)), 1) - 1) AS bin, avg(flux) AS m FROM m0 GROUP BY 1, 2),
d0 AS (SELECT series_id, abs(m - median(m) OVER (PARTITION BY series_id)) AS dev FROM b0), rm AS (SELECT series_id, 1.482602218505602e0 * median(dev) AS rms FROM d0 GROUP BY 1)
SELECT series_id, round(variance, 4) + 0.0 AS variance, round(rms, 4) + 0.0 AS rms_hour, round(ptp, 4) + 0.0 AS ptp, round(w, 4) + 0.0 AS FpWhite, """
    + ", ".join(f"round({n} - w, 4) + 0.0 AS {n}" for n in _BANDS) + " FROM va LEFT JOIN rm USING (series_id) LEFT JOIN pt USING (series_id) LEFT JOIN fl USING (series_id)"
)
def features_common(spark: SparkSession, sf_dir: str) -> DataFrame:
    lc = lightcurve(spark, sf_dir)
    return tidy(features.common(lc, spectrum.periodogram(lc, None)), 4)


@query()
def features_rfgc(spark: SparkSession, sf_dir: str) -> DataFrame:
    lc, power, found = _parts(spark, sf_dir)
    units = spark.range(8).select(F.col("id").cast("int").alias("unit"), F.transform(F.sequence(F.lit(0), F.lit(63)), lambda k: (F.sin((k + 8 * F.col("id")) * 0.0982) + 1) / 2).alias("weights"))
    return features.rfgc(lc, power, found, units)


@query()
def features_xgb(spark: SparkSession, sf_dir: str) -> DataFrame:
    lc, _, found = _parts(spark, sf_dir)
    return features.xgb(lc, found)


@query()
def features_sortinghat(spark: SparkSession, sf_dir: str) -> DataFrame:
    lc, power, found = _parts(spark, sf_dir)
    return features.sortinghat(lc, power, found)


@query()
def features_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, power, _ = _parts(spark, sf_dir)
    return features.pooled_image(power, bins=16, low=0.5, high=20.0)
