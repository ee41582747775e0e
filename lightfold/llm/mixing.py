"""Mixing of sources to target weights by iterative proportional fitting.

Token weights are summed over the cells of source, language and topic; each margin in turn is raked
to its targets until all agree; a document is then kept with its cell's calibrated probability.
Only cells are iterated over, never documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .counts import count_tokens
from .scratch import drop, mapped, quoted, unused, written
from .textops import LOWER, SPACE, U, flat, prefix_hash, slices, span_hash, spans, trim

MARGINS = ("source", "lang", "topic")
#: Beyond so many cells the rounds run as DataFrames instead of on the driver; steps and end are the same.
DRIVER_CELLS = 200_000
#: Rounds end when no probability moves by more.
SETTLED = 1e-12
_WORD = U((1 << 44) - 1)


def weigh(texts: pa.Array, topics: int, least: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Words of each text, and its topic: the 44-bit hash of its most frequent word of at least ``least`` bytes, modulo
    ``topics``; of equally frequent ones (a million times or more is as often), that of the least hash; -1 without any."""
    data, at = flat(texts)
    count, topic = np.zeros(len(texts), np.int64), np.full(len(texts), -1, np.int32)
    for i, j in slices(at):
        part = LOWER[data[at[i] : at[j]]]
        starts, ends, ranges = spans(~SPACE[part], at[i : j + 1] - at[i])
        count[i:j] = np.diff(ranges)
        long = ends - starts >= least
        h = span_hash(prefix_hash(part), starts[long], ends[long]) >> U(20)
        if not len(h):
            continue
        own = np.repeat(np.arange(j - i, dtype=U), np.diff(ranges))[long]
        key = np.sort(own << U(44) | h)
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        times, key = np.diff(np.r_[first, len(key)]), key[first]
        own, least_first = key >> U(44), _WORD - (key & _WORD)
        start = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        top = np.maximum.reduceat(np.minimum(times, (1 << 20) - 1).astype(U) << U(44) | least_first, start)
        topic[i + own[start].astype(np.int64)] = ((_WORD - (top & _WORD)) % U(topics)).astype(np.int32)
    return count, topic


def rake(cells: np.ndarray, weight: np.ndarray, targets: list[dict], rate: float, rounds: int = 300) -> np.ndarray:
    """The probability of each cell (rows of ``cells``: one value for each margin) by which a share of ``rate`` of
    ``weight`` is kept, with the margins' shares of ``targets`` (value -> share).

    Values without a target keep their share; shares are rescaled to 1. Each margin in turn is scaled to
    its targets; a probability that would exceed 1 is 1, and further rounds make up for it from the
    other cells. A value with less weight than its target asks for is kept whole.
    """
    total = weight.sum()
    plans = []
    for k, told in enumerate(targets):
        values, own = np.unique(cells[:, k], return_inverse=True)
        now = np.bincount(own, weight) / (total or 1)
        want = np.array([told.get(v, s) for v, s in zip(values.tolist(), now, strict=True)])
        want = np.where(now > 0, want, 0)
        want = want / want.sum() if want.sum() else now
        plans.append((own, np.minimum(want * rate, now)))
    return scaled(plans, weight, rate, rounds)


def scaled(plans: list[tuple[np.ndarray, np.ndarray]], weight: np.ndarray, rate: float, rounds: int = 300) -> np.ndarray:
    """Rounds over the margins (each cell's place in a margin, and the share of all weight wanted at each place) until
    no probability moves by ``SETTLED``."""
    p = np.full(len(weight), float(rate))
    total = weight.sum()
    for _ in range(rounds if total else 0):
        before = p
        for own, want in plans:
            now = np.bincount(own, weight * p, len(want)) / total
            p = np.minimum(1.0, p * np.where(now > 0, want / np.where(now > 0, now, 1), 1)[own])
        if np.abs(p - before).max() < SETTLED:
            break
    return p


def wanted(cells: DataFrame, margin: str, total: float, rate: float, told: DataFrame | None, power: float) -> DataFrame:
    """(value, want): the share of all weight that is to be kept of each value of a margin.

    ``told`` (value, share) states shares, others stay as they are; without it shares are raised to ``power``.
    """
    now = cells.groupBy(F.col(margin).alias("value")).agg((F.sum("weight") / F.lit(float(total))).alias("now"))
    if told is not None:
        own = now.join(told, "value", "left").withColumn("raw", F.coalesce("share", "now"))
    else:
        own = now.withColumn("raw", F.pow("now", F.lit(float(power))))
    own = own.select("value", "now", F.when(F.col("now") > 0, F.col("raw")).otherwise(0.0).alias("raw"))
    whole = own.agg(F.sum("raw").alias("scale"))  # one row
    share = F.when(F.col("scale") > 0, F.col("raw") / F.col("scale")).otherwise(F.col("now"))
    return own.crossJoin(F.broadcast(whole)).select("value", F.least(share * rate, "now").alias("want"))


def _rake_frames(cells: DataFrame, wants: dict[str, DataFrame], total: float, rate: float, rounds: int = 300) -> DataFrame:
    """``scaled`` as DataFrame rounds, for more cells than the driver takes: cells with probability."""
    now = written(cells.withColumn("probability", F.lit(float(rate))), "cells")
    for _ in range(rounds):
        step = now.withColumn("before", F.col("probability"))
        for m, want in wants.items():
            share = step.groupBy(F.col(m).alias("value")).agg((F.sum(F.col("weight") * F.col("probability")) / F.lit(float(total))).alias("now")).join(want, "value")
            share = share.select(F.col("value").alias(m), F.when(F.col("now") > 0, F.col("want") / F.col("now")).otherwise(1.0).alias("factor"))
            step = step.join(share, m).withColumn("probability", F.least(F.lit(1.0), F.col("probability") * F.col("factor"))).drop("factor")
        new = written(step, "cells")
        moved = new.agg(F.max(F.abs(F.col("probability") - F.col("before")))).first()[0]
        drop(now)
        now = new.drop("before")
        if moved < SETTLED:
            break
    return now


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang", tokenizer: str | None = None, topics: int = 8, targets: dict[str, dict] | None = None, power: float = 0.8, rate: float = 0.7, seed: int = 11, with_text: bool = True) -> DataFrame:
    """All rows of ``docs`` (less its text unless ``with_text``) with _tokens, _topic, _probability and _kept.

    A document weighs its tokens by the sentencepiece model at ``tokenizer``, or its words without one.
    ``targets`` gives shares of tokens by margin and value (``source``, ``lang``, ``topic``); without it each
    margin's shares are raised to ``power`` and rescaled.
    Probabilities are raked so that a share of ``rate`` of all tokens is expected to be kept, in the
    target shares; see ``rake``. A row is kept if a hash of its id (a null id: of its text, if that stays) and
    ``seed`` falls under its probability, so reruns agree and repeated rows stay together.

    Null source or language is a value of its own, written as the empty text. Texts without words
    weigh nothing and have topic -1; they follow their cell's probability. An empty table gives an
    empty one. Columns of ``docs`` with the four added names are replaced; others may have any name.

    The texts are read once: rows and their weights are written to the shared folder, and cells are summed from there.
    """
    docs = docs.drop("_tokens", "_topic", "_probability", "_kept")
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = "counts" if tokenizer else ""
        trim(keep)
        for b in batches:
            texts = b.column(at).cast(pa.string())
            words, topic = weigh(texts, topics)
            tokens = count_tokens(texts, tokenizer)[1] if tokenizer else words
            kept = [k for k in range(len(b.columns)) if with_text or k != at]
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in kept), pa.array(tokens), pa.array(topic)], [*(b.schema.names[k] for k in kept), "_tokens", "_topic"])
        trim(keep)

    weighed = written(mapped(docs, run, [T.StructField("_tokens", T.LongType()), T.StructField("_topic", T.IntegerType())], less=None if with_text else text_col), "weighed")

    def text(name: str) -> Column:
        return F.coalesce(F.col(quoted(name)).cast("string"), F.lit(""))

    keys = {"source": text(source_col), "lang": text(lang_col), "topic": F.col("_topic").cast("string")}
    cells = written(weighed.groupBy(*(k.alias(m) for m, k in keys.items())).agg(F.sum("_tokens").alias("weight")), "cells")
    count, total = cells.agg(F.count("*"), F.sum("weight")).first()
    told = {m: weighed.sparkSession.createDataFrame([(str(v), float(s)) for v, s in (targets.get(m) or {}).items()], "value string, share double") if targets is not None else None for m in MARGINS}
    wants = {m: wanted(cells, m, total or 1, rate, told[m], power) for m in MARGINS}
    if count <= DRIVER_CELLS:
        rows = cells.collect()
        plans = []
        for k, m in enumerate(MARGINS):
            want = dict(wants[m].collect())  # no more values than cells
            codes = {v: i for i, v in enumerate(want)}
            plans.append((np.array([codes[r[k]] for r in rows], np.int64), np.array(list(want.values()), float)))
        p = scaled(plans, np.array([r[3] for r in rows], float), rate)
        fitted = weighed.sparkSession.createDataFrame([(*r[:3], float(x)) for r, x in zip(rows, p, strict=True)], "source string, lang string, topic string, probability double")
        fitted = F.broadcast(fitted)  # bounded by DRIVER_CELLS
    else:
        fitted = _rake_frames(cells, {m: written(w, "margin") for m, w in wants.items()}, total or 1, rate)
    names = {m: unused(m, weighed.columns) for m in MARGINS}
    fitted = fitted.select(*(F.col(m).alias(n) for m, n in names.items()), F.col("probability").alias("_probability"))
    on = [keys[m] == F.col(quoted(n)) for m, n in names.items()]
    named = F.col(quoted(id_col)).cast("string")
    named = F.coalesce(named, F.col(quoted(text_col)).cast("string")) if with_text else named
    chance = (F.xxhash64(F.lit(seed), named) / F.lit(2.0**64)) + 0.5
    return weighed.join(fitted, on).drop(*names.values()).withColumn("_kept", chance < F.col("_probability"))
