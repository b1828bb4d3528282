"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams, learned with
follow-the-regularised-leader and elastic-net penalties, probabilities calibrated by a temperature.

An n-gram is 1 to 3 code points of the lower-cased text with a blank at both ends,
hashed to a bucket; its value is its share of the text's n-grams times its inverse
document frequency over all documents that may be learned from. The sum of a
class's weights over a text's n-grams is then a plain sum over its positions.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table
from .rolling import batched

BUCKETS = 1 << 15
SCALE = 100.0
#: Bound of the fitting sample: labelled rows of a language. All languages are learned; document frequencies and predictions cover all rows.
PER_LANGUAGE = 600
TOGETHER = 16              # languages scored at once
FOLDS, HELD_OUT = 3, 1


def grams(texts: list):
    """Yields (indices of the texts, where each text's positions begin, buckets): three arrays of buckets, one for each
    length, with BUCKETS where an n-gram would leave its text."""
    for chunk in batched(((" " + t.lower() + " ").encode("utf-32-le") if t else b"" for t in texts), 4 << 20):
        size = np.fromiter((len(b) // 4 for _, b in chunk), np.int64, len(chunk))
        first = np.concatenate(([0], np.cumsum(size)))
        c = np.frombuffer(b"".join(b for _, b in chunk), "<u4")
        h = c * np.uint32(2654435761)
        found, two = [], None
        for n in (1, 2, 3):
            if n > 1:
                h = (h[:-1] * np.uint32(31)) ^ (c[n - 1:] * np.uint32(2246822519) + np.uint32(n))
            bucket = np.full(len(c), BUCKETS, np.int32)
            bucket[:max(len(c) - n + 1, 0)] = ((h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B)) >> np.uint32(17)
            if n > 1:
                for back in range(1, n):
                    ends = first[1:] - back
                    bucket[ends[(ends >= first[:-1])]] = BUCKETS
            found.append(bucket)
        yield [i for i, _ in chunk], first, found


def ftrl(rows: list, y: np.ndarray, classes: int, epochs: int = 3, alpha: float = 0.3, beta: float = 1.0,
         l1: float = 0.5, l2: float = 0.5, seed: int = 11) -> np.ndarray:
    """Weights (buckets + 1 for the bias, classes) by FTRL-proximal, one example at a time."""
    z = np.zeros((BUCKETS + 1, classes))
    n = np.zeros((BUCKETS + 1, classes))

    def weights(zi, ni):
        return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2))

    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for k in order.permutation(len(rows)):
            at, x = rows[k]
            zi, ni = z[at], n[at]
            w = weights(zi, ni)
            s = x @ w
            p = np.exp(s - s.max())
            p /= p.sum()
            p[y[k]] -= 1
            g = x[:, None] * p
            more = ni + g * g
            z[at] = zi + g - (np.sqrt(more) - np.sqrt(ni)) / alpha * w
            n[at] = more
    return weights(z, n)


def temperature(s: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least log loss on scores s of rows of classes y."""
    def loss(t):
        a = s / t
        a = a - a.max(axis=1, keepdims=True)
        return float((np.log(np.exp(a).sum(axis=1)) - a[np.arange(len(y)), y]).mean())

    return min(np.geomspace(0.2, 20, 93), key=loss) if len(y) else 1.0


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"):
    """(languages, table of weight times idf, bias, temperature) from rows of the learning folds with a language; None
    without one. Every language is learned, from about PER_LANGUAGE of its rows in the order of a hash of their ids."""
    spark = docs.sparkSession
    fold = F.pmod(F.crc32(F.col(f"`{id_col}`").cast("string")), F.lit(FOLDS))
    learn = (docs.where(fold.isNotNull() & (fold != HELD_OUT))
             .select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang"))
             .where("lang is not null and text is not null"))

    def frequencies(batches):
        df, docs_seen = np.zeros(BUCKETS + 1, np.int64), 0
        mark = np.zeros(BUCKETS + 1, bool)
        for batch in batches:
            for at, first, found in grams(batch.column(0).to_pylist()):
                for a, b in zip(first, first[1:]):
                    for bucket in found:
                        mark[bucket[a:b]] = True
                    df += mark
                    mark[:] = False
                docs_seen += len(at)
        df[BUCKETS] = docs_seen
        yield pa.RecordBatch.from_arrays([pa.array([df], pa.list_(pa.int64()))], names=["df"])

    sums = (learn.select("text").mapInArrow(frequencies, "df array<long>").select(F.posexplode("df").alias("k", "c"))
            .groupBy("k").agg(F.sum("c").alias("c")).toArrow())           # BUCKETS + 1 numbers
    if not sums.num_rows:
        return None
    df = np.zeros(BUCKETS + 1)
    df[sums["k"].to_numpy()] = sums["c"].to_numpy()
    if not df[BUCKETS]:
        return None
    idf = np.log((1 + df[BUCKETS]) / (1 + df[:BUCKETS])) + 0.1

    langs = learn.groupBy("lang").count().toArrow().to_pylist()              # a row per language
    rates = spark.createDataFrame([(r["lang"], min(1.0, PER_LANGUAGE / r["count"])) for r in langs], "lang string, rate double")
    draw = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < F.col("rate") * (1 << 30)

    def extract(batches):
        for batch in batches:
            out = [[], [], []]
            langs_of = batch.column(1).to_pylist()
            for at, first, found in grams(batch.column(0).to_pylist()):
                for i, a, b in zip(at, first, first[1:]):
                    all_of = np.concatenate([bucket[a:b] for bucket in found])
                    bucket, times = np.unique(all_of[all_of < BUCKETS], return_counts=True)
                    out[0].append(langs_of[i])
                    out[1].append(bucket.astype("<i4").tobytes())
                    out[2].append((times / max(times.sum(), 1)).astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.binary()), pa.array(out[2], pa.binary())],
                                             names=["lang", "at", "tf"])

    sample = (learn.join(F.broadcast(rates), "lang").where(draw).orderBy(F.xxhash64("id"), "id").limit(2 * PER_LANGUAGE * len(langs))
              .select("text", "lang").mapInArrow(extract, "lang string, at binary, tf binary").toArrow().to_pylist())
    names = sorted({r["lang"] for r in sample})
    if not names:
        return None
    rows = [(np.append(np.frombuffer(r["at"], "<i4"), BUCKETS),
             np.append(np.frombuffer(r["tf"], "<f4") * idf[np.frombuffer(r["at"], "<i4")] * SCALE, 1.0)) for r in sample]
    y = np.array([names.index(r["lang"]) for r in sample])
    test = np.arange(len(rows)) % 5 == 4
    w = ftrl([r for r, t in zip(rows, test) if not t], y[~test], len(names))
    scores = np.array([x @ w[at] for (at, x), t in zip(rows, test) if t]).reshape(-1, len(names))
    table_ = np.zeros((BUCKETS + 1, len(names)), np.float32)
    table_[:BUCKETS] = w[:BUCKETS] * idf[:, None] * SCALE
    return names, table_, w[BUCKETS], temperature(scores, y[test])


def probabilities(texts: list, model) -> np.ndarray:
    names, weights, bias, heat = model
    out = np.tile(bias, (len(texts), 1))
    for at, first, found in grams(texts):
        size = np.diff(first)
        some = np.flatnonzero(size)
        if not len(some):
            continue
        # some languages at a time, so that memory does not grow with their number
        total = np.concatenate([sum(np.add.reduceat(weights[bucket, c:c + TOGETHER], first[some], axis=0) for bucket in found)
                                for c in range(0, weights.shape[1], TOGETHER)], axis=1)
        count = sum(np.add.reduceat((bucket < BUCKETS).astype(np.int64), first[some]) for bucket in found)
        out[np.array(at)[some]] += total / np.maximum(count, 1)[:, None]
    a = out / heat
    a = np.exp(a - a.max(axis=1, keepdims=True))
    return a / a.sum(axis=1, keepdims=True)


def identify(docs: DataFrame, model, text_col: str = "text") -> DataFrame:
    """``docs`` as ``row``, with ``lang_pred`` and ``score``: ``und`` and 0 for a text that is null or has no letter, or
    without a model. Whole texts count; other columns are not looked at."""
    row = docs.select(F.struct("*").alias("row"), F.col(f"`{text_col}`").cast("string").alias("text"))
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    if model is None:
        return row.select("row", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def guess(texts: pd.Series) -> pd.DataFrame:
        p = probabilities(texts.tolist(), held.value)
        best = p.argmax(axis=1)
        return pd.DataFrame({"lang": np.array(held.value[0], object)[best], "score": p[np.arange(len(p)), best]})

    got = row.withColumn("guess", guess("text"))
    return got.select("row", F.when(letters, F.col("guess.lang")).otherwise("und").alias("lang_pred"),
                      F.when(letters, F.col("guess.score")).otherwise(0.0).alias("score"))


def query(spark, sf):
    docs = table(spark, sf, "documents")
    out = identify(docs.select("doc_id", "text"), fit(docs))
    held = F.coalesce(F.pmod(F.crc32(F.col("row.doc_id").cast("string")), F.lit(FOLDS)) == HELD_OUT, F.lit(False))
    return out.select("row.doc_id", held.alias("held_out"), "lang_pred", "score")


SQL = None
