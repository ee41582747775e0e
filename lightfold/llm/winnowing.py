"""Document fingerprints by winnowing.

All k-grams of code points are hashed by a rolling hash; of each window of w consecutive hashes the
least is kept, the rightmost among equals, with its position. Two texts that share w + k - 1 code
points in a row share at least one fingerprint, and no match under k code points counts.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textops import _INVERSE, _ODD, U, _grown, mix, trim

_LOW = U(0xFFFFFFFF)


def winnow(text: str, k: int = 24, w: int = 77) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and positions of the text's fingerprints; a text under k code points has its whole as one, an empty one none."""
    n = len(text)
    if not n:
        return np.zeros(0, U), np.zeros(0, np.int64)
    v = mix(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(U) + U(0x51ED27))
    size = min(k, n)
    sums = np.zeros(n + 1, U)
    np.cumsum(v * _grown(0, _ODD, n), dtype=U, out=sums[1:])
    h = mix((sums[size:] - sums[:-size]) * _grown(1, _INVERSE, n + 1)[: n - size + 1] + U(size)) >> U(32)
    least = h << U(32) | (_LOW - np.arange(len(h), dtype=U))  # equal hashes: the rightmost is the lesser
    window, step = min(w, len(h)), 1
    while step * 2 <= window:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if step < window:
        least = np.minimum(least[: len(least) - (window - step)], least[window - step :])
    least = least[np.r_[True, least[1:] != least[:-1]]]
    return least >> U(32), (_LOW - (least & _LOW)).astype(np.int64)


def written_form(hashes: np.ndarray, positions: np.ndarray) -> str:
    """Hashes and position steps as base64 of little-endian 32-bit numbers, parted by a point; empty for none."""
    if not len(hashes):
        return ""
    return ".".join(base64.b64encode(x.astype("<u4").tobytes()).decode() for x in (hashes, np.diff(positions, prepend=0)))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two fingerprints' hashes; 1 if both are empty."""
    a, b = np.unique(a), np.unique(b)
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by the first as many of ``following``, or all."""
    q = len(text) // 4
    return text[: len(text) - q] + following[:q]


def _fingerprinted(k: int, w: int):
    """Rows (range, ahead, id, text) in order; a row ahead only tells what follows the last of its range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = []
            for r, ahead, i, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                text = text or ""
                own = winnow(text, k, w)
                if held and held[0] == r:
                    _, last, before, print_ = held
                    new = edited(before, text)
                    other = winnow(new, k, w)
                    rows.append((last, len(before), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), written_form(*print_), written_form(*other), likeness(print_[0], other[0]), likeness(print_[0], own[0])))
                held = None if ahead else (r, i, text, own)
            if rows:
                kinds = (pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64())
                names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)
        trim()

    return run


def _borders(docs: DataFrame, ranges: int) -> np.ndarray:
    """The first id of each of about ``ranges`` ranges of equally many rows, the least id first. They are quantiles of ids, those
    whose hash a number divides (about 64 for each range), so clumped ids are split like others and reruns agree."""
    low, count = docs.agg(F.min("id"), F.count("*")).first()
    if ranges < 2:
        return np.array([low], np.int64)
    step = max(1, count // (64 * ranges))
    some = docs.where(F.pmod(F.xxhash64("id"), F.lit(step)) == 0).select("id").toArrow().column(0).to_numpy()
    some = np.sort(some)[:: max(1, len(some) // ranges)]
    return np.unique(np.r_[np.int64(low), some])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 24, w: int = 77, range_bytes: int = 4 << 20, most: int = 50_000) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) for each row.

    The next document is the next by id (equal ids: by text, so repeated rows follow each other), the
    first after the last. Null texts are empty; rows with a null id have no place in the order and
    are left out; extra columns are ignored; an empty table gives an empty one. Ids may be any longs.

    Rows are dealt into ranges of ids of about ``range_bytes`` of text, at most ``most`` of them (then they are longer and are
    sorted on disk); their borders are on the driver, as those of any sort by ranges.
    Each range is sorted and read in order by one task, with a copy of the first row of the next
    range. Texts are shuffled once.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where("id is not null")
    out = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    size = docs.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 64)).first()[0]
    if size is None:
        return spark.createDataFrame([], out)
    borders = _borders(docs, min(int(size) // range_bytes + 1, most))

    @F.pandas_udf("int")
    def of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(borders, ids.to_numpy(), "right").astype(np.int32) - 1)

    heads = [(int(first), (r - 1) % len(borders)) for r, first in enumerate(borders)]
    ahead = spark.createDataFrame(heads, "head long, before int")  # bounded: a row for each range
    own = F.struct(F.col("r"), F.lit(0).alias("ahead"))
    both = docs.withColumn("r", of("id")).join(F.broadcast(ahead), F.col("id") == F.col("head"), "left")
    both = both.select("id", "text", F.explode(F.when(F.col("head").isNull(), F.array(own)).otherwise(F.array(own, F.struct(F.col("before").alias("r"), F.lit(1).alias("ahead"))))).alias("at"))
    rows = both.select("at.r", "at.ahead", "id", "text").repartitionById(len(borders), F.col("r")).sortWithinPartitions("r", "ahead", "id", "text")
    return rows.mapInArrow(_fingerprinted(k, w), out)
