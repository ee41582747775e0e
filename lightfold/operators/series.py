"""Statistics of irregular series, as DataFrame operators.

A series table has series_id, t (days), flux, flux_err, quality; each operator groups or windows by
series alone, so a plan has one exchange by series_id. Rows with a missing time or flux are skipped;
a series without any has no row, unless said otherwise.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.numbers import MAD_TO_SIGMA, digamma_less_euler, finite, sigmoid

# Fill corrections and cumulative Gaussian rates of higher-order crossings.
CROSSING_FILL = (3.625418060200669, 5.250836120401338, 7.117056856187291, 8.862876254180602, 10.608695652173914, 12.234113712374581)
CROSSING_GAUSS = (0.49912, 0.666367, 0.732079, 0.769869, 0.795083)


def by_series() -> WindowSpec:
    return Window.partitionBy("series_id")


def in_time() -> WindowSpec:
    return by_series().orderBy("t")


def clean(lc: DataFrame) -> DataFrame:
    """Rows with finite time and flux."""
    return lc.where(finite(F.col("t")) & finite(F.col("flux")))


def truncated(lc: DataFrame, days: float = 27.4) -> DataFrame:
    """The first ``days`` of each series."""
    return lc.withColumn("_t0", F.min("t").over(by_series())).where(F.col("t") - F.col("_t0") <= days).drop("_t0")


def relative_ppm(lc: DataFrame) -> DataFrame:
    """Flux relative to the series' median, in parts per million."""
    return lc.withColumn("flux", (F.col("flux") / F.median("flux").over(by_series()) - 1) * 1e6)


def variance(lc: DataFrame) -> DataFrame:
    return clean(lc).groupBy("series_id").agg(F.var_samp("flux").alias("variance"))


def point_to_point(lc: DataFrame) -> DataFrame:
    """Median, 98th percentile and mean of the absolute step between neighbours in time."""
    step = F.abs(F.col("flux") - F.lag("flux").over(in_time()))
    return clean(lc).withColumn("step", step).groupBy("series_id").agg(F.median("step").alias("ptp"), F.percentile("step", 0.98).alias("p2p_98"), F.avg("step").alias("p2p_mean"))


def folded_point_to_point(lc: DataFrame, period: Column) -> DataFrame:
    """The same of neighbours in phase."""
    folded = clean(lc).withColumn("phase", phase(F.col("t"), period))
    step = F.abs(F.col("flux") - F.lag("flux").over(by_series().orderBy("phase", "t")))
    return folded.withColumn("step", step).groupBy("series_id").agg(F.percentile("step", 0.98).alias("p2p_98_phasefold"), F.avg("step").alias("p2p_mean_phasefold"))


def phase(t: Column, period: Column, t0: Column | float = 0.0) -> Column:
    """Phase of t, 0 to 1."""
    t0 = t0 if isinstance(t0, Column) else F.lit(t0)
    return F.pmod(t - t0, period) / period


def rms_timescale(lc: DataFrame, width: float = 3600 / 86400) -> DataFrame:
    """Robust scatter of bin means; bins of ``width`` days from the series' first time, the last closed on the right.

    A series without finite flux has null; one whose bin spans it all has 0.
    """
    times = lc.where(finite(F.col("t")))
    span = times.withColumns({"t0": F.min("t").over(by_series()), "t1": F.max("t").over(by_series())})
    last = F.greatest(F.ceil((F.col("t1") - F.col("t0")) / width), F.lit(1)) - 1
    bins = span.withColumn("bin", F.least(F.floor((F.col("t") - F.col("t0")) / width), last)).groupBy("series_id", "bin").agg(F.avg(F.when(finite(F.col("flux")), F.col("flux"))).alias("m"))
    middle = bins.withColumn("dev", F.abs(F.col("m") - F.median("m").over(by_series())))
    return middle.groupBy("series_id").agg((F.median("dev") * MAD_TO_SIGMA).alias("rms"))


def median_mad(lc: DataFrame) -> DataFrame:
    middle = clean(lc).withColumn("med", F.median("flux").over(by_series()))
    return middle.groupBy("series_id").agg(F.first("med").alias("median"), (F.median(F.abs(F.col("flux") - F.col("med"))) * MAD_TO_SIGMA).alias("sigma"))


def moments(lc: DataFrame) -> DataFrame:
    """Population skewness and excess kurtosis."""
    return clean(lc).groupBy("series_id").agg(F.skewness("flux").alias("skewness"), F.kurtosis("flux").alias("kurtosis"))


def eta(lc: DataFrame) -> DataFrame:
    """Mean squared step over the variance, weighted by 1 / error."""
    step = F.col("flux") - F.lag("flux").over(in_time())
    w = 1 / F.col("flux_err")
    sums = clean(lc).withColumns({"step": step, "w": w}).groupBy("series_id").agg(F.count("*").alias("n"), F.sum(F.col("step") ** 2).alias("steps"), F.sum("w").alias("w"), F.sum(F.col("w") * F.col("flux")).alias("wf"), F.sum(F.col("w") * F.col("flux") ** 2).alias("wff"))
    spread = F.col("wff") / F.col("w") - (F.col("wf") / F.col("w")) ** 2
    return sums.select("series_id", F.try_divide(F.col("steps") / (F.col("n") - 1), spread).alias("eta"))


def trend(lc: DataFrame, weighted: bool = True) -> DataFrame:
    """Slope and level at the first time of a straight line; residuals are divided by flux_err if weighted."""
    w = 1 / F.col("flux_err") ** 2 if weighted else F.lit(1.0)
    x = F.col("t") - F.min("t").over(by_series())
    s = clean(lc).select("series_id", w.alias("w"), x.alias("x"), F.col("flux").alias("y")).groupBy("series_id").agg(F.sum("w").alias("s"), F.sum(F.col("w") * F.col("x")).alias("sx"), F.sum(F.col("w") * F.col("y")).alias("sy"), F.sum(F.col("w") * F.col("x") ** 2).alias("sxx"), F.sum(F.col("w") * F.col("x") * F.col("y")).alias("sxy"))
    slope = F.try_divide(F.col("s") * F.col("sxy") - F.col("sx") * F.col("sy"), F.col("s") * F.col("sxx") - F.col("sx") ** 2)
    return s.withColumn("slope", slope).select("series_id", "slope", ((F.col("sy") - F.col("slope") * F.col("sx")) / F.col("s")).alias("level"))


def detrended(lc: DataFrame, weighted: bool = True) -> DataFrame:
    """The series less its straight line."""
    line = trend(lc, weighted)
    x = F.col("t") - F.min("t").over(by_series())
    return lc.withColumn("_x", x).join(line, "series_id").withColumn("flux", F.col("flux") - F.col("level") - F.col("slope") * F.col("_x")).drop("_x", "slope", "level")


def prepared(lc: DataFrame, flatten: bool = False) -> DataFrame:
    """Flux in parts per million as relative flux, flattened about 1 if asked."""
    out = clean(lc).withColumn("flux", F.col("flux") * 1e-6 + 1)
    return detrended(out, weighted=False).withColumn("flux", F.col("flux") + 1) if flatten else out


def cumulative_range(lc: DataFrame, order: Column | None = None) -> DataFrame:
    """Range of the cumulative sum of deviations, over n sigma; in time, or by ``order``."""
    base = clean(lc).withColumns({"mean": F.avg("flux").over(by_series()), "sd": F.stddev_pop("flux").over(by_series()), "n": F.count("*").over(by_series())})
    upto = by_series().orderBy(F.col("t") if order is None else order, "t").rowsBetween(Window.unboundedPreceding, 0)
    s = F.sum(F.col("flux") - F.col("mean")).over(upto)
    sums = base.withColumn("s", F.try_divide(s, F.col("n") * F.col("sd")))
    return sums.groupBy("series_id").agg((F.max("s") - F.min("s")).alias("rcs"))


def fill_factor(lc: DataFrame) -> DataFrame:
    """Points over span by median step."""
    step = F.col("t") - F.lag("t").over(in_time())
    own = clean(lc).withColumn("step", step).groupBy("series_id").agg(F.count("*").alias("n"), (F.max("t") - F.min("t")).alias("span"), F.median("step").alias("step"))
    return own.select("series_id", "n", F.try_divide(F.col("n"), F.try_divide(F.col("span"), F.col("step"))).alias("fill"))


def crossings(lc: DataFrame, k: int = 5) -> DataFrame:
    """Rates of sign changes of the 0th to (k-1)th differences about the median, corrected for gaps, and psi."""
    base = clean(lc).withColumn("y", F.col("flux") - F.median("flux").over(by_series())).withColumn("d0", F.col("y"))
    for i in range(1, k):
        base = base.withColumn(f"d{i}", F.col(f"d{i - 1}") - F.lag(f"d{i - 1}").over(in_time()))
    flips = [F.when(F.col(f"d{i}").isNotNull() & F.lag(f"d{i}").over(in_time()).isNotNull(), ((F.col(f"d{i}") >= 0) != (F.lag(f"d{i}").over(in_time()) >= 0)).cast("int")) for i in range(k)]
    counted = base.withColumns({f"f{i}": f for i, f in enumerate(flips)}).groupBy("series_id").agg(*(F.coalesce(F.sum(f"f{i}"), F.lit(0)).alias(f"c{i}") for i in range(k)))
    own = counted.join(fill_factor(lc), "series_id")
    full = [1 / (1 + math.exp(-q)) - 0.5 for q in CROSSING_FILL]
    rates = own.withColumns({f"zc{i}": F.try_divide(F.col(f"c{i}") / (F.col("n") - i), sigmoid(F.col("fill"), CROSSING_FILL[i]) / full[i]) for i in range(k)})
    psi = F.lit(0.0)
    for i in range(k):
        gauss = CROSSING_GAUSS[i] - (CROSSING_GAUSS[i - 1] if i else 0)
        delta = F.col(f"zc{i}") - (F.col(f"zc{i - 1}") if i else 0)
        psi = psi + (delta - gauss) ** 2 / gauss
    return rates.select("series_id", psi.alias("psi"), *(f"zc{i}" for i in range(k)))


def phase_bins(lc: DataFrame, period: Column, bins: int = 64, cut: float = 0.0) -> DataFrame:
    """(series_id, bin, phase, flux): mean flux of each phase bin; empty bins have the series' mean.

    With ``cut``, points of a bin of over two that lie more than ``cut`` median deviations from its
    median are left out; a bin without deviation keeps all.
    """
    b = F.least(F.floor(phase(F.col("t"), period) * bins), F.lit(bins - 1)).cast("int")
    points = clean(lc).withColumn("bin", b)
    if cut:
        by = Window.partitionBy("series_id", "bin")
        points = points.withColumns({"_m": F.median("flux").over(by), "_n": F.count("*").over(by)}).withColumn("_d", F.abs(F.col("flux") - F.col("_m"))).withColumn("_mad", F.median("_d").over(by))
        points = points.withColumn("_use", (F.col("_n") <= 2) | (F.col("_mad") == 0) | (F.col("_d") <= F.col("_mad") * cut))
    else:
        points = points.withColumn("_use", F.lit(True))
    means = points.groupBy("series_id", "bin").agg(F.avg(F.when(F.col("_use"), F.col("flux"))).alias("m"), F.sum("flux").alias("s"), F.count("*").alias("n"))
    whole = means.groupBy("series_id").agg((F.sum("s") / F.sum("n")).alias("mean"), F.map_from_entries(F.collect_list(F.struct("bin", "m"))).alias("means"))  # one entry for each bin
    every = whole.select("series_id", "mean", "means", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return every.select("series_id", "bin", ((F.col("bin") + 0.5) / bins).alias("phase"), F.coalesce(F.col("means")[F.col("bin")], F.col("mean")).alias("flux"))


def shape_vector(lc: DataFrame, period: Column, bins: int = 64) -> DataFrame:
    """(series_id, place, value, range): the folded series scaled to 0..1 (all 1 if flat), its minimum first."""
    binned = phase_bins(lc, period, bins)
    own = binned.withColumns({"low": F.min("flux").over(by_series()), "high": F.max("flux").over(by_series())})
    scaled = own.withColumn("value", F.when(F.col("high") > F.col("low"), (F.col("flux") - F.col("low")) / (F.col("high") - F.col("low"))).otherwise(1.0))
    first = F.min_by("bin", F.struct("value", "bin")).over(by_series())
    return scaled.withColumn("first", first).select("series_id", F.pmod(F.col("bin") - F.col("first"), F.lit(bins)).cast("int").alias("place"), "value", (F.col("high") - F.col("low")).alias("range"))


def corrected_period(lc: DataFrame, period: float | Column, bins: int = 64) -> DataFrame:
    """(series_id, period): ``period`` (a number, or a column of ``lc``), or twice it where the fold at twice shows two unlike
    minima half a turn apart. A negative or missing period stays as it is."""
    own = clean(lc).withColumn("_period", (period if isinstance(period, Column) else F.lit(period)).cast("double"))
    told = own.groupBy("series_id").agg(F.first("_period").alias("told"))
    flat = detrended(own.where("_period > 0"), weighted=False).withColumn("flux", F.col("flux") + 1)
    binned = phase_bins(flat, 2 * F.col("_period"), bins, cut=5)
    least = binned.withColumn("best", F.min_by(F.struct("phase", "flux"), F.struct("flux", "bin")).over(by_series()))
    apart = F.pmod(F.abs(F.col("phase") - F.pmod(F.col("best.phase") + 0.5, F.lit(1.0))), F.lit(1.0))
    second = least.where((apart < 0.05) | (apart > 0.95)).groupBy("series_id").agg(F.min("flux").alias("second"), F.first("best.flux").alias("first"))
    ends = flat.withColumns({"up": F.row_number().over(by_series().orderBy("flux", "t")), "down": F.row_number().over(by_series().orderBy(F.desc("flux"), "t"))}).groupBy("series_id").agg(
        F.median(F.when(F.col("down") <= 30, F.col("flux"))).alias("top"), F.median(F.when(F.col("up") <= 30, F.col("flux"))).alias("bottom"), (F.max("t") - F.min("t")).alias("span")
    )
    depth = F.col("second") - F.col("first")
    double = (depth > 0.0025) & (depth > 0.03 * (F.col("top") - F.col("bottom"))) & (2 * F.col("told") <= F.col("span") / 2)
    every = told.join(ends, "series_id", "left").join(second, "series_id", "left")
    return every.select("series_id", F.when(double, 2 * F.col("told")).otherwise(F.col("told")).alias("period"))


def flux_ratio(lc: DataFrame) -> DataFrame:
    """Logarithm of the root of mean squares below the mean over those above.

    A flux that differs from the mean by no more than the rounding of a sum counts as the mean, so as above, in any order of the rows.
    """
    noise = F.lit(2.0**-51) * F.sqrt(F.count("flux").over(by_series())) * F.avg(F.abs("flux")).over(by_series())
    base = clean(lc).withColumns({"d": F.col("flux") - F.avg("flux").over(by_series()), "noise": noise})
    base = base.withColumn("d", F.col("d") - F.avg("d").over(by_series())).withColumn("d", F.when(F.abs("d") > F.col("noise"), F.col("d")).otherwise(0.0))
    own = base.groupBy("series_id").agg(F.avg(F.when(F.col("d") < 0, F.col("d") ** 2)).alias("below"), F.avg(F.when(F.col("d") >= 0, F.col("d") ** 2)).alias("above"))
    return own.select("series_id", F.log(F.sqrt(F.try_divide("below", "above"))).alias("flux_ratio"))


def neighbour_entropy(values: DataFrame, k: int = 3, value: str = "flux") -> DataFrame:
    """Differential entropy in bits from distances to the k-th nearest neighbour; points at distance 0 are left out."""
    order = by_series().orderBy(value)
    base = values.where(finite(F.col(value)))
    near = F.array(*(F.abs(F.col(value) - f(value, i).over(order)) for i in range(1, k + 1) for f in (F.lag, F.lead)))
    dist = F.array_sort(F.filter(near, lambda x: x.isNotNull()))[k - 1]
    own = base.withColumn("d", dist).groupBy("series_id").agg(F.count("*").alias("n"), F.avg(F.when(F.col("d") > 0, F.log("d"))).alias("ln"))
    return own.select("series_id", ((digamma_less_euler(F.col("n")) - sum(1 / i for i in range(1, k)) + math.log(2) + F.col("ln")) / math.log(2)).alias("entropy"))


def coarse_grained(lc: DataFrame, scale: int) -> DataFrame:
    """(series_id, block, flux): means of ``scale`` points in a row; a last part of a block is left out."""
    rows = clean(lc).withColumn("block", F.floor((F.row_number().over(in_time()) - 1) / scale))
    return rows.groupBy("series_id", "block").agg(F.avg("flux").alias("flux"), F.count("*").alias("n")).where(F.col("n") == scale).drop("n")


def binned(lc: DataFrame, bins: int, value: str = "flux") -> DataFrame:
    """(series_id, bin, n, mean, median, least, most) of ``bins`` equal steps of each series' time, the last closed on the right."""
    base = clean(lc).withColumns({"t0": F.min("t").over(by_series()), "t1": F.max("t").over(by_series())})
    b = F.coalesce(F.least(F.floor(F.try_divide((F.col("t") - F.col("t0")) * bins, F.col("t1") - F.col("t0"))), F.lit(bins - 1)), F.lit(0)).cast("int")
    v = F.col(value)
    return base.withColumn("bin", b).groupBy("series_id", "bin").agg(F.count("*").alias("n"), F.avg(v).alias("mean"), F.median(v).alias("median"), F.min(v).alias("least"), F.max(v).alias("most"))


def interpolated(lc: DataFrame, count: int) -> DataFrame:
    """(series_id, k, flux): the series at ``count`` + 1 even times from first to last, linear between neighbours."""
    base = clean(lc)
    edges = base.groupBy("series_id").agg(F.min("t").alias("t0"), F.max("t").alias("t1")).select("series_id", "t0", "t1", F.explode(F.sequence(F.lit(0), F.lit(count))).alias("k"))
    wanted = edges.select("series_id", "k", (F.col("t0") + (F.col("t1") - F.col("t0")) * F.col("k") / count).alias("t"), F.lit(None).cast("double").alias("flux"))
    both = base.select("series_id", F.lit(None).cast("int").alias("k"), "t", "flux").unionByName(wanted)
    order = by_series().orderBy("t", F.col("k").asc_nulls_first())
    known = F.when(F.col("k").isNull(), F.struct("t", "flux"))
    before, after = F.last(known, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)), F.first(known, ignorenulls=True).over(order.rowsBetween(0, Window.unboundedFollowing))
    at = both.withColumns({"a": before, "b": after}).where(F.col("k").isNotNull())
    share = F.coalesce(F.try_divide(F.col("t") - F.col("a.t"), F.col("b.t") - F.col("a.t")), F.lit(0.0))
    return at.select("series_id", "k", F.coalesce(F.col("a.flux") + (F.col("b.flux") - F.col("a.flux")) * share, F.col("a.flux"), F.col("b.flux")).alias("flux"))


def moving_percentile(lc: DataFrame, width: int = 11, q: float = 0.95, late: float = 0.98) -> DataFrame:
    """(series_id, place, level): the percentile of ``width`` points about each point, ``late`` in the last fifth; frames
    are shifted at the ends, so that all have the same size."""
    rows = clean(lc).withColumns({"place": F.row_number().over(in_time()), "n": F.count("*").over(by_series())})
    values = rows.groupBy("series_id", "n").agg(F.sort_array(F.collect_list(F.struct("place", "flux"))).alias("v"))  # one series
    each = values.select("series_id", "n", "v", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("place"))
    first = F.greatest(F.lit(1), F.least(F.col("place") - width // 2, F.col("n").cast("int") - width + 1))
    frame = F.array_sort(F.transform(F.slice("v", first, F.lit(width)), lambda x: x["flux"]))
    rank = (F.size("f") - 1) * F.when(F.col("place") > 0.8 * F.col("n"), late).otherwise(q)
    low = F.element_at("f", F.floor(rank).cast("int") + 1)
    high = F.element_at("f", F.ceil(rank).cast("int") + 1)
    return each.withColumn("f", frame).select("series_id", "place", (low + (high - low) * (rank - F.floor(rank))).alias("level"))


def extremes(lc: DataFrame, count: int = 30) -> DataFrame:
    """Medians of the ``count`` highest and lowest points, and of the last ones in time."""
    w = {"down": F.row_number().over(by_series().orderBy(F.desc("flux"), "t")), "up": F.row_number().over(by_series().orderBy("flux", "t")), "back": F.row_number().over(by_series().orderBy(F.desc("t")))}
    own = clean(lc).withColumns(w).groupBy("series_id")
    return own.agg(*(F.median(F.when(F.col(c) <= count, F.col("flux"))).alias(n) for c, n in (("down", "top"), ("up", "bottom"), ("back", "latest"))))
