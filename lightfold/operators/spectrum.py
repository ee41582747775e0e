"""Least-squares spectra of irregular series as DataFrame operators.

A spectrum table has series_id, k, frequency (microhertz), alpha, beta, power, density, amplitude.
Frequencies are multiples of the series' own resolution 1 / span. Every point meets every
frequency of its series by exploding a fixed sequence (no join), and sums are taken on the map side
before the one exchange by (series_id, k).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .series import by_series, clean

DAY_TO_MICROHERTZ = 1e6 / 86400.0
#: Angle for a frequency in microhertz and a time in days.
ANGLE = 2 * math.pi * 0.0864
#: From the median of a spectrum to its mean.
MEDIAN_TO_MEAN = (1 - 1 / 9) ** -3


def model(t: Column, alpha: Column, beta: Column, frequency: Column) -> Column:
    """alpha sin + beta cos at ``frequency`` microhertz, t in days."""
    return alpha * F.sin(ANGLE * frequency * t) + beta * F.cos(ANGLE * frequency * t)


def _centred(lc: DataFrame) -> DataFrame:
    own = clean(lc)
    return own.select("series_id", (F.col("t") - F.min("t").over(by_series())).alias("x"), (F.max("t").over(by_series()) - F.min("t").over(by_series())).alias("span"), (F.col("flux") - F.avg("flux").over(by_series())).alias("y"))


def _sums(points: DataFrame, *by: str) -> DataFrame:
    """Points (x, y, frequency) to the coefficients of sine and cosine, and the raw power."""
    s, c = F.sin(ANGLE * F.col("frequency") * F.col("x")), F.cos(ANGLE * F.col("frequency") * F.col("x"))
    sums = points.withColumns({"s": s, "c": c}).groupBy(*by, "frequency").agg(
        F.sum(F.col("y") * F.col("s")).alias("ys"), F.sum(F.col("y") * F.col("c")).alias("yc"), F.sum(F.col("s") ** 2).alias("ss"), F.sum(F.col("c") ** 2).alias("cc"), F.sum(F.col("s") * F.col("c")).alias("cs"),
        F.avg(F.col("y") ** 2).alias("var"), F.count("*").alias("n"),
    )
    d = F.col("ss") * F.col("cc") - F.col("cs") ** 2
    out = sums.withColumns({"alpha": F.try_divide(F.col("ys") * F.col("cc") - F.col("yc") * F.col("cs"), d), "beta": F.try_divide(F.col("yc") * F.col("ss") - F.col("ys") * F.col("cs"), d)})
    return out.withColumn("raw", F.greatest(F.col("alpha") * F.col("ys") + F.col("beta") * F.col("yc"), F.lit(0.0)))


def spacing(lc: DataFrame) -> DataFrame:
    """(series_id, df, nyquist) in microhertz: 1 / span, and half of 1 / median step."""
    own = clean(lc).withColumn("step", F.col("t") - F.lag("t").over(by_series().orderBy("t"))).groupBy("series_id").agg((F.max("t") - F.min("t")).alias("span"), F.median("step").alias("step"))
    return own.select("series_id", F.try_divide(F.lit(DAY_TO_MICROHERTZ), "span").alias("df"), F.try_divide(F.lit(DAY_TO_MICROHERTZ / 2), "step").alias("nyquist"))


def periodogram(lc: DataFrame, count: int | None = 50, oversampling: int = 1) -> DataFrame:
    """The first ``count`` steps of df / ``oversampling`` (None: all below each series' own Nyquist frequency), scaled so that
    the mean square is the sum of powers over two."""
    points = _centred(lc).where(F.col("span") > 0)
    last = F.lit(count)
    if count is None:
        own = spacing(lc).select("series_id", (F.ceil(F.col("nyquist") / F.col("df") * oversampling) - 1).cast("int").alias("last"))
        points, last = points.join(own.where("last >= 1"), "series_id"), F.col("last")
    step = F.lit(DAY_TO_MICROHERTZ / oversampling) / F.col("span")
    grid = points.select("series_id", "x", "y", step.alias("step"), F.explode(F.sequence(F.lit(1), last)).alias("k")).withColumn("frequency", F.col("step") * F.col("k"))
    raw = _sums(grid, "series_id", "k", "step")
    norm = F.try_divide(F.col("var"), F.sum("raw").over(by_series())) * oversampling
    scaled = raw.withColumn("norm", norm)
    power = 2 * F.col("norm") * F.col("raw")
    return scaled.select("series_id", "k", "frequency", "alpha", "beta", power.alias("power"), (F.col("norm") * F.col("raw") / (F.col("step") * oversampling)).alias("density"), F.sqrt(power).alias("amplitude"))


def alpha_beta(lc: DataFrame, frequency: float) -> DataFrame:
    """(series_id, alpha, beta, amplitude, phase) of the sine of ``frequency`` microhertz, time from the first point."""
    fit = _sums(_centred(lc).withColumn("frequency", F.lit(float(frequency))), "series_id")
    return fit.select("series_id", "alpha", "beta", F.sqrt(F.col("alpha") ** 2 + F.col("beta") ** 2).alias("amplitude"), F.atan2("beta", "alpha").alias("phase"))


def false_alarm(z: Column, n: Column, spread: Column, top: Column) -> Column:
    """Chance that noise gives a peak of normalised power z (share of the sum of squares); Baluev's bound.

    ``spread`` is the standard deviation of the times, ``top`` the highest frequency searched, in inverse units.
    """
    gamma = F.sqrt(F.lit(2.0) / (n - 1)) * F.exp(_log_gamma((n - 1) / 2) - _log_gamma((n - 2) / 2))
    width = top * F.sqrt(F.lit(4 * math.pi)) * spread
    single = F.pow(1 - z, (n - 3) / 2)
    tau = gamma * width * F.pow(1 - z, (n - 4) / 2) * F.sqrt(0.5 * (n - 1) * z)
    return 1 - (1 - single) * F.exp(-tau)


def _log_gamma(x: Column) -> Column:
    """Stirling's series, good to 1e-10 from 7 on and 1e-6 from 2 on."""
    return (x - 0.5) * F.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5)


def fliper(spectrum: DataFrame, top: float = 277.0, tail: int = 100) -> DataFrame:
    """Mean power density of bands above the noise, which is the median of the last ``tail`` frequencies."""
    last = spectrum.withColumn("back", F.row_number().over(by_series().orderBy(F.desc("frequency"))))
    f, p = F.col("frequency"), F.col("density")

    def band(low: float, high: float) -> Column:
        return F.avg(F.when(f.between(low, high), p))

    lows = {"Fp07": (0.7, top), "Fp7": (7, top), "Fp20": (20, top), "Fp50": (50, top), "Fphi": (0, 28), "Fplo": (250, top)}
    own = last.groupBy("series_id").agg((F.median(F.when(F.col("back") <= tail, p)) / (1 - 2 / 18) ** 3).alias("FpWhite"), *(band(*b).alias(n) for n, b in lows.items()))
    return own.select("series_id", "FpWhite", *((F.col(n) - F.col("FpWhite")).alias(n) for n in lows))


def frequency_table(spectrum: DataFrame, peaks: int = 3, harmonics: int = 1) -> DataFrame:
    """(series_id, num, harmonic, frequency, amplitude, phase, alpha, beta): the strongest grid frequencies and the grid
    values at their multiples; a multiple beyond the grid has nulls. Prewhitening is in ``prewhiten``."""
    ranked = spectrum.withColumn("num", F.row_number().over(by_series().orderBy(F.desc("amplitude"), "k"))).where(F.col("num") <= peaks)
    wanted = ranked.select("series_id", "num", F.col("k").alias("base"), F.explode(F.sequence(F.lit(0), F.lit(harmonics))).alias("harmonic")).withColumn("k", F.col("base") * (F.col("harmonic") + 1))
    values = spectrum.select("series_id", "k", "frequency", F.sqrt(F.col("alpha") ** 2 + F.col("beta") ** 2).alias("amplitude"), F.atan2("beta", "alpha").alias("phase"), "alpha", "beta")
    return wanted.join(values, ["series_id", "k"], "left").select("series_id", "num", "harmonic", "frequency", "amplitude", "phase", "alpha", "beta")


def top_frequencies(frequencies: DataFrame, spans: DataFrame, count: int = 6, in_days: bool = True, ignore_harmonics: bool = True) -> DataFrame:
    """(series_id, place, value): the ``count`` strongest frequencies as periods (or in microhertz), padded with the span (days)."""
    known = frequencies.where(F.col("amplitude").isNotNull() & ~F.isnan("amplitude"))
    own = known if ignore_harmonics else known.where("harmonic = 0")
    order = [F.desc("amplitude"), F.col("num"), F.col("harmonic")] if ignore_harmonics else [F.col("num")]
    ranked = own.withColumn("place", F.row_number().over(by_series().orderBy(*order))).where(F.col("place") <= count).select("series_id", "place", "frequency")
    every = spans.select("series_id", "span", F.explode(F.sequence(F.lit(1), F.lit(count))).alias("place"))
    f = F.coalesce("frequency", F.lit(DAY_TO_MICROHERTZ) / F.col("span"))
    return every.join(ranked, ["series_id", "place"], "left").select("series_id", "place", (F.lit(DAY_TO_MICROHERTZ) / f if in_days else f).alias("value"))


def ratios(frequencies: DataFrame) -> DataFrame:
    """Amplitude ratios and phase differences of the second and third peak to the first; 0 where one is missing."""

    def main(n: int, c: str) -> Column:
        return F.max(F.when((F.col("num") == n) & (F.col("harmonic") == 0), F.col(c)))

    own = frequencies.groupBy("series_id").agg(*(main(n, c).alias(f"{c}{n}") for n in (1, 2, 3) for c in ("amplitude", "phase")))
    zero = F.lit(0.0)
    return own.select(
        "series_id", *(F.coalesce(F.try_divide(F.col(f"amplitude{n}"), F.col("amplitude1")), zero).alias(f"ampratio{n}1") for n in (2, 3)), *(F.coalesce(F.col(f"phase{n}") - n * F.col("phase1"), zero).alias(f"phasediff{n}1") for n in (2, 3))
    )


def _key(num: int, harmonic: int) -> str:
    return f"{num}_harmonic{harmonic}" if harmonic else f"{num}"


def table_to_columns(frequencies: DataFrame, peaks: int, harmonics: int) -> DataFrame:
    """freq1, amp1, phase1, freq1_harmonic1, ...: one row for each series."""

    def at(n: int, h: int, c: str) -> Column:
        return F.max(F.when((F.col("num") == n) & (F.col("harmonic") == h), F.col(c)))

    names = (("frequency", "freq"), ("amplitude", "amp"), ("phase", "phase"))
    return frequencies.groupBy("series_id").agg(*(at(n, h, c).alias(short + _key(n, h)) for n in range(1, peaks + 1) for h in range(harmonics + 1) for c, short in names))


def columns_to_table(wide: DataFrame) -> DataFrame:
    """The inverse; the number of peaks and harmonics are read from the columns."""
    peaks = harmonics = 0
    while f"freq{peaks + 1}" in wide.columns:
        peaks += 1
    while f"freq1_harmonic{harmonics + 1}" in wide.columns:
        harmonics += 1
    rows = [F.struct(F.lit(n).alias("num"), F.lit(h).alias("harmonic"), *(F.col(s + _key(n, h)).alias(c) for s, c in (("freq", "frequency"), ("amp", "amplitude"), ("phase", "phase")))) for n in range(1, peaks + 1) for h in range(harmonics + 1)]
    out = wide.select("series_id", F.explode(F.array(*rows)).alias("r")).select("series_id", "r.*")
    return out.withColumns({"alpha": F.col("amplitude") * F.cos("phase"), "beta": F.col("amplitude") * F.sin("phase"), "deviation": F.lit(float("nan"))})


def harmonic_power(frequencies: DataFrame) -> DataFrame:
    """Share of the variance the first peak leaves, its number of known harmonics, and the log of its harmonics' power over the first."""
    a, h = F.col("amplitude"), F.col("harmonic")
    own = frequencies.where("num = 1").groupBy("series_id", "variance").agg(F.sum(a**2 / 2).alias("sines"), F.count(F.when((h > 0) & a.isNotNull() & ~F.isnan(a), 1)).alias("number_significantharmonic"), F.sum(F.when(h > 0, a**2)).alias("s"), F.max(F.when(h == 1, a)).alias("a11"))
    return own.select("series_id", F.coalesce(F.try_divide(F.col("variance") - F.coalesce("sines", F.lit(0.0)), F.col("variance")), F.lit(1.0)).alias("varrat"), "number_significantharmonic", F.log10(F.try_divide("s", "a11") - 1).alias("lpf1pa11"))


def image(spectrum: DataFrame, bins: int = 128, low: float = 3.0, high: float = 283.0, value: str = "density") -> DataFrame:
    """(series_id, x, y): the lit pixels of the spectrum's picture, y from above.

    The logarithm of power is standardised; each of ``bins`` equal steps of log frequency is lit from its
    least to its greatest value, border values interpolated (0 outside of the spectrum), on -5 to 5.
    """
    base = spectrum.where(F.col(value) > 0).select("series_id", F.log10("frequency").alias("lx"), F.log10(value).alias("v"))
    z = base.withColumns({"m": F.avg("v").over(by_series()), "sd": F.stddev_pop("v").over(by_series())}).select("series_id", "lx", F.try_divide(F.col("v") - F.col("m"), F.col("sd")).alias("v"))
    first, last = math.log10(low), math.log10(high)
    width = (last - first) / bins
    edges = z.select("series_id").distinct().select("series_id", F.explode(F.sequence(F.lit(0), F.lit(bins))).alias("e")).select("series_id", "e", (F.lit(first) + F.col("e") * width).alias("lx"), F.lit(None).cast("double").alias("v"))
    both = z.select("series_id", F.lit(None).cast("int").alias("e"), "lx", "v").unionByName(edges)
    order = by_series().orderBy("lx", F.col("e").asc_nulls_first())
    known = F.when(F.col("v").isNotNull(), F.struct("lx", "v"))
    left, right = F.last(known, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)), F.first(known, ignorenulls=True).over(order.rowsBetween(0, Window.unboundedFollowing))
    at = both.withColumns({"l": left, "r": right})
    between = F.col("l.v") + (F.col("r.v") - F.col("l.v")) * F.coalesce(F.try_divide(F.col("lx") - F.col("l.lx"), F.col("r.lx") - F.col("l.lx")), F.lit(0.0))
    filled = at.select("series_id", "e", "lx", F.when(F.col("v").isNotNull(), F.col("v")).when(F.col("l").isNull() | F.col("r").isNull(), 0.0).otherwise(between).alias("v"))
    # an edge counts for the bin on either side
    own = F.when(F.col("e").isNotNull(), F.array(F.col("e"), F.col("e") - 1)).otherwise(F.array(F.floor((F.col("lx") - first) / width).cast("int")))
    samples = filled.select("series_id", "v", F.explode(own).alias("x")).where(F.col("x").between(0, bins - 1))
    limits = samples.groupBy("series_id", "x").agg(F.min("v").alias("a"), F.max("v").alias("b"))

    def row(c: Column) -> Column:
        return F.least(F.greatest(c.cast("int"), F.lit(0)), F.lit(bins))

    step = 10.0 / bins
    lit = limits.select("series_id", "x", row(F.floor((F.col("a") + 5) / step)).alias("i"), row(F.ceil((F.col("b") + 5) / step)).alias("j")).where("j > i")
    return lit.select("series_id", "x", F.explode(F.sequence(F.col("i"), F.col("j") - 1)).alias("y")).withColumn("y", F.lit(bins - 1) - F.col("y"))
