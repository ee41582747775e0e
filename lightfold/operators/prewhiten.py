"""Extraction of sines from series one after the other, and other steps that are sequential within a series.

Each series is one group of a grouped map; series are independent, so the work spreads over them. A series is a
few thousand points, which bounds a task's memory.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from .series import clean
from .spectrum import ANGLE, DAY_TO_MICROHERTZ, MEDIAN_TO_MEAN

PEAKS = "series_id long, num int, harmonic int, frequency double, amplitude double, phase double, alpha double, beta double, deviation double"


class Grid:
    """Sines and cosines of a series' times at even frequencies, and the sums that do not depend on the flux.

    A block's are those of the first block turned by one angle for each point, so trigonometric functions are evaluated for one
    block alone; small grids are kept whole.
    """

    BLOCK, KEPT = 128, 2_000_000

    def __init__(self, t: np.ndarray, step: float, count: int):
        self.step, self.count = step, count
        self.first = np.exp(1j * ANGLE * step * np.arange(1, min(self.BLOCK, count) + 1)[:, None] * t)
        self.t, self.held = t, None
        sums = [((e.imag**2).sum(1), (e.real**2).sum(1), (e.imag * e.real).sum(1)) for e in self._turned()]
        self.ss, self.cc, self.cs = (np.concatenate([s[k] for s in sums]) if sums else np.zeros(0) for k in range(3))
        if count * len(t) <= self.KEPT:
            self.held = list(self._turned())

    def _turned(self) -> Iterator[np.ndarray]:
        for a in range(0, self.count, self.BLOCK):
            e = self.first[: min(self.BLOCK, self.count - a)]
            yield e * np.exp(1j * ANGLE * self.step * a * self.t) if a else e

    def fit(self, y: np.ndarray) -> np.ndarray:
        """The fall of the residual sum of squares at each frequency."""
        both = [e @ y for e in (self.held if self.held is not None else self._turned())]
        both = np.concatenate(both) if both else np.zeros(0, complex)
        ys, yc = both.imag, both.real
        with np.errstate(divide="ignore", invalid="ignore"):
            raw = (ys * ys * self.cc + yc * yc * self.ss - 2 * ys * yc * self.cs) / (self.ss * self.cc - self.cs**2)
        return np.clip(np.nan_to_num(raw), 0, None)


class Spectrum:
    """Exact least-squares spectrum of one series; frequencies in microhertz, times in days. ``like`` is another of the same
    times, whose grid is taken over."""

    def __init__(self, t: np.ndarray, y: np.ndarray, like: Spectrum | None = None):
        self.t, self.y = t, y - y.mean()
        self.grids: dict[tuple[int, float], Grid] = like.grids if like else {}
        span = float(t.max() - t.min()) if len(t) else 0.0
        self.df = DAY_TO_MICROHERTZ / span if span else math.nan
        step = float(np.median(np.diff(t))) if len(t) > 1 else 0.0
        self.nyquist = DAY_TO_MICROHERTZ / 2 / step if step else math.nan
        self.total = float((self.y**2).sum())

    def fit(self, f: np.ndarray | float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Coefficients of sine and cosine, and the fall of the residual sum of squares."""
        f = np.atleast_1d(np.asarray(f, float))
        alpha, beta, raw = np.empty(len(f)), np.empty(len(f)), np.empty(len(f))
        for a in range(0, len(f), 256):
            w = ANGLE * f[a : a + 256, None] * self.t
            s, c = np.sin(w), np.cos(w)
            ys, yc, ss, cc, cs = s @ self.y, c @ self.y, (s * s).sum(1), (c * c).sum(1), (s * c).sum(1)
            d = ss * cc - cs * cs
            with np.errstate(divide="ignore", invalid="ignore"):
                alpha[a : a + 256], beta[a : a + 256] = (ys * cc - yc * cs) / d, (yc * ss - ys * cs) / d
            raw[a : a + 256] = alpha[a : a + 256] * ys + beta[a : a + 256] * yc
        return alpha, beta, np.clip(np.nan_to_num(raw), 0, None)

    def power(self, oversampling: int = 4, nyquist_factor: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
        """The grid up to the Nyquist frequency, and power so that the sum over the unit grid is twice the mean square."""
        top = self.nyquist * nyquist_factor
        step, key = self.df / oversampling, (oversampling, nyquist_factor)
        if key not in self.grids:
            self.grids[key] = Grid(self.t, step, int(top / step))
        f = np.arange(1, self.grids[key].count + 1) * self.df / oversampling
        raw = self.grids[key].fit(self.y)
        unit = raw[oversampling - 1 :: oversampling].sum()
        return f, 2 * raw * (np.mean(self.y**2) / unit if unit else 0.0)

    def optimum(self, f: float | list[float], within: float = 1e-5) -> float:
        """The frequency of greatest power near ``f``, or between the outer two of three: the best of even steps, then of the steps about it."""
        low, high = (f[0], f[2]) if isinstance(f, list) else (f - 2 * self.df, f + 2 * self.df)
        low = max(low, 0.25 * self.df)
        while high - low > within:
            tried = np.linspace(low, high, 14)
            w = np.multiply.outer(ANGLE * tried, self.t)
            s, c = np.sin(w), np.cos(w)
            ys, yc, ss, cs = s @ self.y, c @ self.y, np.einsum("ij,ij->i", s, s), np.einsum("ij,ij->i", s, c)
            cc = len(self.t) - ss
            raw = (ys * ys * cc + yc * yc * ss - 2 * ys * yc * cs) / np.maximum(ss * cc - cs * cs, 1e-300)
            best = int(raw.argmax())
            low, high = tried[max(best - 1, 0)], tried[min(best + 1, 13)]
        return float((low + high) / 2)

    def false_alarm(self, f: float) -> float:
        """Baluev's bound for a peak as high as that at ``f``."""
        n = len(self.t)
        if n < 5 or not self.total:
            return 1.0
        z = min(max(self.fit(f)[2][0] / self.total, 0.0), 1 - 1e-15)
        span = float(self.t.max() - self.t.min())
        width = 5 * 0.5 * n / span * math.sqrt(4 * math.pi * float(self.t.var()))
        gamma = math.sqrt(2 / (n - 1)) * math.exp(math.lgamma((n - 1) / 2) - math.lgamma((n - 2) / 2))
        tau = gamma * width * (1 - z) ** (0.5 * (n - 4)) * math.sqrt(0.5 * (n - 1) * z)
        single = (1 - z) ** (0.5 * (n - 3))
        return 1 - (1 - single) * math.exp(-tau)

    def spacing_by_window(self, oversampling: int = 5) -> float:
        """Resolution as the integral of the spectral window over 100 resolutions on either side (Simpson's rule)."""
        centre, n = 0.5 * self.nyquist, 100 * oversampling
        f = centre + self.df / oversampling * np.arange(-n, n)
        x = 0.5 * np.sin(ANGLE * centre * self.t) + 0.5 * np.cos(ANGLE * centre * self.t)
        p = Spectrum(self.t, x).fit(f)[2]
        p = p / p[n]
        q = p[: len(p) - (len(p) + 1) % 2]
        h = self.df / oversampling
        return float(h / 3 * (q[0] + q[-1] + 4 * q[1:-1:2].sum() + 2 * q[2:-1:2].sum()))

    def spacing_by_minimum(self, oversampling: int = 10) -> float:
        """Resolution as the first minimum of the spectral window."""
        centre, n = 0.5 * self.nyquist, 5 * oversampling
        x = 0.5 * np.sin(ANGLE * centre * self.t) + 0.5 * np.cos(ANGLE * centre * self.t)
        p = Spectrum(self.t, x).fit(centre + self.df / oversampling * np.arange(n))[2]
        lows = np.flatnonzero((p[1:-1] <= p[:-2]) & (p[1:-1] < p[2:])) + 1
        return float(lows[0] * self.df / oversampling) if len(lows) else self.df


def _noise(frequency: np.ndarray, power: np.ndarray, df: float, top: float, least: int = 20) -> np.ndarray | float:
    """The noise floor: medians of 19 steps merged until each has ``least`` frequencies, interpolated, plus 1."""
    edges = np.linspace(df, top, 20)
    for _ in range(100):
        own = np.clip(np.digitize(frequency, edges), 0, len(edges))
        own[frequency == edges[-1]] = len(edges) - 1
        counts = np.bincount(own, minlength=len(edges))[1 : len(edges)]
        small = np.flatnonzero(counts < least)
        if not len(small) or len(edges) <= 2:
            break
        edges = np.delete(edges, small[0] + 1 if small[0] + 1 < len(edges) - 1 else small[0])
    middle = edges[:-1] + 0.5 * np.diff(edges)
    floor = np.array([np.median(power[own == i + 1]) if (own == i + 1).any() else np.nan for i in range(len(middle))])
    good = np.isfinite(floor)
    if good.sum() <= 2:
        return 1.0
    x, y = middle[good], floor[good]
    out = np.interp(frequency, x, y)
    left, right = frequency < x[0], frequency > x[-1]
    out[left] = y[0] + (frequency[left] - x[0]) * (y[1] - y[0]) / (x[1] - x[0])
    out[right] = y[-1] + (frequency[right] - x[-1]) * (y[-1] - y[-2]) / (x[-1] - x[-2])
    return np.clip(MEDIAN_TO_MEAN * out, 0, None) + 1


def extract(t: np.ndarray, y: np.ndarray, peaks: int = 6, harmonics: int = 0, oversampling: int = 4, nyquist_factor: float = 1.0, alarm: float | None = 0.0027, snr: float | None = None, deviation: float | None = 0.5, failures: int | None = 10, refit: int = 10, refit_within: float | None = 10.0, noise: bool = True, multiples: list[float] | None = None, snr_width: float | None = None) -> pd.DataFrame:
    """Sines in order of amplitude: (peaks * (harmonics + 1)) rows, NaN where none was found.

    The strongest peak over the noise floor is fitted and taken off, then its multiples; after each, the nearest
    ones found before are fitted anew. It ends where the false-alarm chance exceeds ``alarm``, or the amplitude is under ``snr`` times
    the noise within ``snr_width`` microhertz (15 steps) of the peak. ``multiples`` are the harmonics' factors (2, 3, ...); fewer than ``harmonics`` are an error.
    """
    if multiples is None:
        multiples = list(range(2, harmonics + 2))
    elif len(multiples) < harmonics:
        raise ValueError("fewer multiples than harmonics")
    shape = (peaks, harmonics + 1)
    nu, a, b, dev = (np.full(shape, np.nan) for _ in range(4))
    rest = y - y.mean() if len(y) else y
    first = Spectrum(t, rest) if len(t) > 4 and np.ptp(t) > 0 else None
    top = first.nyquist * nyquist_factor if first else 0.0

    def line(i: tuple[int, int]) -> np.ndarray:
        return a[i] * np.sin(ANGLE * nu[i] * t) + b[i] * np.cos(ANGLE * nu[i] * t)

    def compare(i: tuple[int, int]) -> None:
        if deviation is not None:
            x, z, _ = first.fit(nu[i])
            dev[i] = (a[i] ** 2 + b[i] ** 2) / (x[0] ** 2 + z[0] ** 2)

    def fitted(i: tuple[int, int], spectrum: Spectrum, f: float | list[float]) -> None:
        nu[i] = spectrum.optimum(f)
        x, z, _ = spectrum.fit(nu[i])
        a[i], b[i] = x[0], z[0]

    def strange(values: np.ndarray) -> np.ndarray:
        with np.errstate(invalid="ignore"):
            return (values > 1 / deviation) | (values < deviation)

    for i in range(peaks if first and first.total > 0 else 0):
        spectrum = Spectrum(t, rest, first)
        f, power = spectrum.power(oversampling, nyquist_factor)
        if len(f) < 3:
            break
        best = int(np.argmax(power / (_noise(f, power, first.df, top) if noise else 1.0)))
        fitted((i, 0), spectrum, [f[best - 1], f[best], f[best + 1]] if 0 < best < len(f) - 1 else float(f[best]))
        weak = alarm is not None and spectrum.false_alarm(nu[i, 0]) > alarm
        if not weak and snr is not None:
            near = np.abs(f - nu[i, 0]) < (15 * first.df if snr_width is None else snr_width)
            floor = math.sqrt(MEDIAN_TO_MEAN * np.median(power[near])) if near.any() else 0.0
            weak = math.hypot(a[i, 0], b[i, 0]) < snr * floor
        if weak:
            nu[i, 0] = a[i, 0] = b[i, 0] = np.nan
            break
        compare((i, 0))
        if deviation is not None and failures is not None and strange(dev[max(i - failures, 0) : i + 1, 0]).all():
            break
        rest = rest - line((i, 0))
        for h in range(1, harmonics + 1):
            if multiples[h - 1] * nu[i, 0] > top:
                break
            spectrum = Spectrum(t, rest)
            fitted((i, h), spectrum, multiples[h - 1] * nu[i, 0])
            if alarm is not None and spectrum.false_alarm(nu[i, h]) > alarm:
                nu[i, h] = a[i, h] = b[i, h] = np.nan
                continue
            rest = rest - line((i, h))
            compare((i, h))
        if i and refit:
            for h in range(harmonics + 1):
                apart = np.abs(nu - nu[i, h]).ravel()
                order = np.argsort(apart)
                most = (i + 1) * (harmonics + 1)
                order = order[1 : most if refit == -1 else min(refit + 1, most)]
                with np.errstate(invalid="ignore"):
                    order = order[apart[order] < refit_within] if refit_within is not None else order
                for j in zip(*np.unravel_index(order, shape), strict=True):
                    if np.isfinite(a[j]):
                        rest = rest + line(j)
                        fitted(j, Spectrum(t, rest), float(nu[j]))
                        compare(j)
                        rest = rest - line(j)
    if deviation is not None:
        bad = strange(dev)
        bad |= bad[:, :1]
        nu[bad] = a[bad] = b[bad] = np.nan
    amplitude = np.hypot(a, b)
    order = np.argsort(-np.nan_to_num(amplitude[:, 0], nan=-np.inf), kind="stable")
    num, harmonic = np.divmod(np.arange(peaks * shape[1]), shape[1])
    columns = {"frequency": nu, "amplitude": amplitude, "phase": np.arctan2(b, a), "alpha": a, "beta": b, "deviation": dev}
    return pd.DataFrame({"num": (num + 1).astype(np.int32), "harmonic": harmonic.astype(np.int32)} | {c: v[order].ravel() for c, v in columns.items()})


def prewhitened(lc: DataFrame, **options) -> DataFrame:
    """``extract`` of each series, times from its first point. Values that were not found are null."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("t")
        t = pdf["t"].to_numpy(float)
        out = extract(t - t.min(), pdf["flux"].to_numpy(float), **options)
        out.insert(0, "series_id", pdf["series_id"].iloc[0])
        return out

    return clean(lc).select("series_id", "t", "flux").groupBy("series_id").applyInPandas(run, PEAKS)


def shapiro_w(x: np.ndarray) -> float:
    """Shapiro and Wilk's W with Royston's weights; NaN under three values or without spread."""
    x = np.sort(x)
    n = len(x)
    if n < 3 or x[0] == x[-1]:
        return math.nan
    m = np.array([NormalDist().inv_cdf((i - 0.375) / (n + 0.25)) for i in range(1, n + 1)])
    if n == 3:
        w = np.array([-math.sqrt(0.5), 0.0, math.sqrt(0.5)])
    else:
        mm, u = float(m @ m), 1 / math.sqrt(n)
        c = m / math.sqrt(mm)
        last = c[-1] + 0.221157 * u - 0.147981 * u**2 - 2.071190 * u**3 + 4.434685 * u**4 - 2.706056 * u**5
        w = np.empty(n)
        if n <= 5:
            rest = (mm - 2 * m[-1] ** 2) / (1 - 2 * last**2)
            w[1:-1] = m[1:-1] / math.sqrt(rest)
        else:
            second = c[-2] + 0.042981 * u - 0.293762 * u**2 - 1.752461 * u**3 + 5.682633 * u**4 - 3.582633 * u**5
            rest = (mm - 2 * m[-1] ** 2 - 2 * m[-2] ** 2) / (1 - 2 * last**2 - 2 * second**2)
            w[2:-2] = m[2:-2] / math.sqrt(rest)
            w[-2], w[1] = second, -second
        w[-1], w[0] = last, -last
    return float((w @ x) ** 2 / ((x - x.mean()) ** 2).sum())


def joint_entropy(points: np.ndarray, k: int = 3, base: float = 2.0) -> float:
    """Differential entropy of points (rows) from distances to the k-th neighbour, by the largest coordinate; NaN for k points or fewer."""
    n, d = points.shape
    if n <= k:
        return math.nan
    far = np.empty(n)
    for a in range(0, n, 256):
        apart = np.abs(points[a : a + 256, None] - points).max(2)
        far[a : a + 256] = np.partition(apart, k, axis=1)[:, k]
    harmonic = sum(1 / i for i in range(1, n)) - sum(1 / i for i in range(1, k))
    known = far[far > 0]
    return (harmonic + d * math.log(2) + d * float(np.log(known).mean())) / math.log(base) if len(known) else math.nan


def neighbours_within(points: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """How many points (itself too) lie within each point's own radius, by the largest coordinate."""
    return np.concatenate([(np.abs(points[a : a + 256, None] - points).max(2) <= radius[a : a + 256, None]).sum(1) for a in range(0, len(points), 256)]) if len(points) else np.zeros(0, int)


def mean_digamma(points: np.ndarray, radius: np.ndarray) -> float:
    """Mean digamma of the neighbours within a hair less than each radius."""
    counts = neighbours_within(points, radius - 1e-15)
    return float(np.mean([sum(1 / i for i in range(1, int(c))) - 0.5772156649015329 for c in counts]))


def conditional_entropy(lc: DataFrame, given: str = "t", value: str = "flux", k: int = 3) -> DataFrame:
    """(series_id, conditional_entropy): the entropy of ``value`` and ``given`` together less that of ``given`` alone, in bits."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        both = pdf[[value, given]].to_numpy(float)
        return pd.DataFrame([(key[0], joint_entropy(both, k) - joint_entropy(both[:, 1:], k))])

    return clean(lc).select("series_id", value, given).groupBy("series_id").applyInPandas(run, "series_id long, conditional_entropy double")


def sample_entropy(x: np.ndarray, length: int = 2, tolerance: float | None = None) -> float:
    """-ln of how much rarer runs of ``length`` + 1 repeat within ``tolerance`` (0.1 sigma) than runs of ``length``; 0 if none repeat."""
    n = len(x)
    if n <= length + 1:
        return 0.0
    r = 0.1 * float(x.std()) if tolerance is None else tolerance

    def matches(m: int) -> int:
        runs = np.lib.stride_tricks.sliding_window_view(x, m)[: n - length]
        return sum(int((np.abs(runs[i + 1 :] - runs[i]).max(1) < r).sum()) for i in range(len(runs) - 1))

    a, b = matches(length + 1), matches(length)
    return -math.log(a / b) if a and b else 0.0


def multiscale_entropy(x: np.ndarray, scales: int = 10) -> tuple[float, float, float, float]:
    """Mean, maximum, deviation and power of the sample entropies of the series and its block means."""
    r = 0.1 * float(x.std()) if len(x) else 0.0
    found = []
    for scale in range(1, scales + 1):
        n = len(x) // scale
        found.append(sample_entropy(x[: n * scale].reshape(n, scale).mean(1), 2, r))
    e = np.array(found)
    return float(e.mean()), float(e.max()), float(e.std()), float((e**2).mean())


def shape_statistics(lc: DataFrame) -> DataFrame:
    """(series_id, shapiro_wilk, mse_mean, mse_max, mse_std, mse_power)."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        y = pdf.sort_values("t")["flux"].to_numpy(float)
        return pd.DataFrame([(key[0], shapiro_w(y), *multiscale_entropy(y))])

    return clean(lc).select("series_id", "t", "flux").groupBy("series_id").applyInPandas(run, "series_id long, shapiro_wilk double, mse_mean double, mse_max double, mse_std double, mse_power double")
