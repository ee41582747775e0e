"""Feature sets of the classifiers: one row for each series, joined from the series and spectral operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import learning, prewhiten, series, spectrum

COMMON = ("variance", "rms_hour", "ptp", "FpWhite", "Fp07", "Fp7", "Fp20", "Fp50", "Fphi", "Fplo")
RFGC = ("EBperiod", "p2", "p3", "p4", "p5", "p6", "ampratio21", "ampratio31", "phasediff21", "phasediff31", "SOM_map", "SOM_range", "p2p_98_phasefold", "p2p_mean_phasefold", "p2p_98_lc", "p2p_mean_lc", "psi", "zc", "Fp07", "Fp7", "Fp20", "Fp50")
XGB = ("skewness", "kurtosis", "shapiro_wilk", "eta", "PeriodLS", "amp1", "ampratio21", "ampratio31", "phasediff21", "phasediff31", "Rcs", "psi_Rcs")
SORTINGHAT = ("f1", "f2", "f3", "varrat", "number_significantharmonic", "skewness", "flux_ratio", "diff_entropy_lc", "diff_entropy_as", "mse_mean", "mse_max", "mse_std", "mse_power")


def _joined(*parts: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.join(b, "series_id", "left"), parts)


def _wide(values: DataFrame, names: list[str]) -> DataFrame:
    return values.groupBy("series_id").agg(*(F.max(F.when(F.col("place") == i, F.col("value"))).alias(n) for i, n in enumerate(names, 1)))


def spans(lc: DataFrame) -> DataFrame:
    return series.clean(lc).groupBy("series_id").agg((F.max("t") - F.min("t")).alias("span"))


def common(lc: DataFrame, power: DataFrame) -> DataFrame:
    """Features that all classifiers share, from the series and its spectrum."""
    ptp = series.point_to_point(lc).select("series_id", "ptp")
    rms = series.rms_timescale(lc).withColumnRenamed("rms", "rms_hour")
    return _joined(series.variance(lc), rms, ptp, spectrum.fliper(power)).select("series_id", *COMMON)


def rfgc(lc: DataFrame, power: DataFrame, frequencies: DataFrame, units: DataFrame, bins: int = 64, line: DataFrame | None = None) -> DataFrame:
    """Features of the shape-and-period forest. ``units`` is the trained map of shapes (unit, weights).

    EBperiod is the strongest period or twice it (see ``series.corrected_period``), and folds are at that period; a negative one has no
    place on the map (SOM_map and SOM_range are -10). ``line`` (series_id, slope: of the straight line that was taken off) adds detrend_coeff_norm, the slope
    over the point-to-point scatter.
    """
    periods = _wide(spectrum.top_frequencies(frequencies, spans(lc), 6), [f"p{i}" for i in range(1, 7)])
    own = series.prepared(lc)
    period = series.corrected_period(own.join(periods.select("series_id", F.col("p1").alias("_first")), "series_id"), F.col("_first")).withColumnRenamed("period", "EBperiod")
    flat = own.join(period.select("series_id", F.col("EBperiod").alias("_period")), "series_id")
    mapped = learning.best_units(_shapes(flat.where("_period > 0"), bins), units)
    folded = _folded(flat.where("_period > 0"))
    crossing = series.crossings(lc).select("series_id", "psi", F.col("zc0").alias("zc"))
    plain = series.point_to_point(own).select("series_id", F.col("p2p_98").alias("p2p_98_lc"), F.col("p2p_mean").alias("p2p_mean_lc"))
    bands = spectrum.fliper(power).select("series_id", "Fp07", "Fp7", "Fp20", "Fp50")
    shape = mapped.select("series_id", F.col("unit").cast("double").alias("SOM_map"), F.col("range").alias("SOM_range"))
    every = _joined(periods.drop("p1"), period, spectrum.ratios(frequencies), shape, folded, plain, crossing, bands)
    off = F.when(F.col("EBperiod") < 0, F.lit(-10.0))
    every = every.withColumns({c: F.coalesce(off, F.col(c)) for c in ("SOM_map", "SOM_range")})
    if line is None:
        return every.select("series_id", *RFGC)
    scatter = series.point_to_point(lc).select("series_id", F.col("ptp").alias("_ptp"))
    every = _joined(every, line.select("series_id", F.col("slope").alias("_slope")), scatter)
    return every.select("series_id", *RFGC, F.try_divide(F.abs("_slope"), F.col("_ptp")).alias("detrend_coeff_norm"))


def shapes(lc: DataFrame, frequencies: DataFrame, bins: int = 64) -> DataFrame:
    """(series_id, vector, range): what the map of shapes learns from, the folds at the corrected periods."""
    first = _wide(spectrum.top_frequencies(frequencies, spans(lc), 1), ["_first"])
    own = series.prepared(lc)
    period = series.corrected_period(own.join(first, "series_id"), F.col("_first"))
    return _shapes(own.join(period.select("series_id", F.col("period").alias("_period")), "series_id").where("_period > 0"), bins)


def _shapes(flat: DataFrame, bins: int) -> DataFrame:
    """(series_id, vector, range) of each series folded at its own period."""
    at = series.phase(F.col("t"), F.col("_period"))
    unit = flat.withColumn("t", at).drop("_period")  # a period of 1 in phase
    rows = series.shape_vector(unit, F.lit(1.0), bins)
    ordered = F.sort_array(F.collect_list(F.struct("place", "value")))  # ``bins`` values
    return rows.groupBy("series_id").agg(F.transform(ordered, lambda x: x["value"]).alias("vector"), F.first("range").alias("range"))


def _folded(flat: DataFrame) -> DataFrame:
    unit = flat.withColumn("t", series.phase(F.col("t"), F.col("_period"))).drop("_period")
    return series.folded_point_to_point(unit, F.lit(1.0 + 1e-12))


def xgb(lc: DataFrame, frequencies: DataFrame) -> DataFrame:
    """Features of the boosted trees."""
    period = _wide(spectrum.top_frequencies(frequencies, spans(lc), 6, ignore_harmonics=False), ["PeriodLS"])
    amp = frequencies.groupBy("series_id").agg(F.coalesce(F.max(F.when((F.col("num") == 1) & (F.col("harmonic") == 0), F.col("amplitude"))), F.lit(0.0)).alias("amp1"))
    turned = lc.join(period, "series_id")
    fold = series.cumulative_range(turned, order=series.phase(F.col("t"), F.col("PeriodLS"))).withColumnRenamed("rcs", "psi_Rcs")
    rcs = series.cumulative_range(lc).withColumnRenamed("rcs", "Rcs")
    wilk = prewhiten.shape_statistics(lc).select("series_id", "shapiro_wilk")
    return _joined(series.moments(lc), wilk, series.eta(lc), period, amp, spectrum.ratios(frequencies), rcs, fold).select("series_id", *XGB)


def sortinghat(lc: DataFrame, power: DataFrame, frequencies: DataFrame) -> DataFrame:
    """Features of the entropy forest."""
    top = _wide(spectrum.top_frequencies(frequencies, spans(lc), 3, in_days=False), ["f1", "f2", "f3"])
    harmonic = spectrum.harmonic_power(frequencies.join(series.variance(lc), "series_id")).select("series_id", "varrat", "number_significantharmonic")
    entropy = series.neighbour_entropy(lc).withColumnRenamed("entropy", "diff_entropy_lc")
    powers = series.neighbour_entropy(power, value="power").withColumnRenamed("entropy", "diff_entropy_as")
    shape = prewhiten.shape_statistics(lc).select("series_id", "mse_mean", "mse_max", "mse_std", "mse_power")
    skew = series.moments(lc).select("series_id", "skewness")
    return _joined(top, harmonic, skew, series.flux_ratio(lc), entropy, powers, shape).select("series_id", *SORTINGHAT)


def pooled_image(power: DataFrame, bins: int = 16, low: float = 3.0, high: float = 283.0) -> DataFrame:
    """(series_id, vector): the spectrum's picture in ``bins`` by ``bins`` pixels, row by row."""
    lit = spectrum.image(power, bins, low, high).select("series_id", (F.col("y") * bins + F.col("x")).alias("p"))
    held = lit.groupBy("series_id").agg(F.collect_set("p").alias("on"))  # at most the picture's pixels
    vector = F.transform(F.sequence(F.lit(0), F.lit(bins * bins - 1)), lambda p: F.array_contains("on", p).cast("double"))
    return power.select("series_id").distinct().join(held, "series_id", "left").withColumn("on", F.coalesce("on", F.array().cast("array<int>"))).select("series_id", vector.alias("vector"))

