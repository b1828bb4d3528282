"""Toxicity: non-negative positive-unlabelled learning of a linear classifier in numpy.

Confirmed toxic documents are the positives; documents without a label are the
unlabelled. With the class prior p taken from the labelled rows, the classifier
minimises p*R_P(+) + max(0, R_U(-) - p*R_P(-)), the risk that full labels would give,
held at no less than zero for the negatives. Features say which words, and which
beginnings of words, a text holds anywhere; all of its words count, and only a fixed
number of weights travels to the executors.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table, unpack
from .rolling import Hasher, batched, joined

BUCKETS = 1 << 18
STARTS = (4, 5, 6)        # lengths, in bytes, of the beginnings of words that are features too
#: Bounds of the sample that the classifier is fitted on. Prior and scores cover all rows.
POSITIVES, UNLABELLED, FEATURES = 2000, 6000, 2048
THRESHOLD = 0.3
DECAYS = (1e-4, 1e-3, 1e-2)
FOLDS, HELD_OUT = 4, 2


def _wordlike() -> np.ndarray:
    c = np.arange(256)
    return ((c >= 48) & (c <= 57)) | ((c >= 97) & (c <= 122)) | (c >= 128)


def features(texts: list):
    """(first, buckets): the buckets of all words and beginnings in order of the texts, with repeats; text k's are
    buckets[first[k]:first[k + 1]]."""
    parts, counts = [], np.zeros(len(texts), np.int64)
    inside_of = _wordlike()
    for chunk in batched(t.lower().encode() if t else b"" for t in texts):
        data, begin = joined([b for _, b in chunk])
        edge = np.flatnonzero(np.diff(inside_of[data].astype(np.int8), prepend=0, append=0))
        start, end = edge[0::2], edge[1::2]
        hasher = Hasher(data)
        full = (hasher.ranges(start, end) % np.uint64(BUCKETS)).astype(np.int32)
        columns = [full]
        for n in STARTS:
            cut = (hasher.ranges(start, np.minimum(start + n, end)) + np.uint64(n)) % np.uint64(BUCKETS)
            columns.append(np.where(end - start > n, cut.astype(np.int32), full))
        at = np.searchsorted(start, begin)
        width = len(columns)
        parts.append(np.stack(columns, axis=1).ravel())
        for k, (i, _) in enumerate(chunk):
            counts[i] = (at[k + 1] - at[k]) * width
    return np.concatenate(([0], np.cumsum(counts))), np.concatenate(parts) if parts else np.empty(0, np.int32)


def logits(texts: list, weights: np.ndarray, bias: float, chars: int = 1 << 20) -> np.ndarray:
    """The sum of the weights of the distinct buckets of each text; about ``chars`` characters are looked at at a time."""
    out, a = np.full(len(texts), bias), 0
    ends = np.cumsum([len(t) if t else 0 for t in texts])
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + chars, side="right")))
        first, buckets = features(texts[a:b])
        hit = np.flatnonzero(weights[buckets])
        doc = np.searchsorted(first, hit, side="right") - 1
        distinct = np.unique(doc * BUCKETS + buckets[hit])
        out[a:b] += np.bincount(distinct // BUCKETS, weights=weights[distinct % BUCKETS], minlength=b - a)
        a = b
    return out


def nnpu(x_p: np.ndarray, x_u: np.ndarray, prior: float, steps: int = 200, rate: float = 0.05, decay: float = 1e-4):
    """Weights and bias of a linear classifier by the non-negative risk with logistic loss (Adam, whole batches)."""
    x = np.concatenate([x_p, x_u]).astype(np.float32)
    n_p, n_u = len(x_p), len(x_u)
    w, m, v = (np.zeros(x.shape[1] + 1, np.float32) for _ in range(3))
    w[-1] = np.log(prior / (1 - prior))
    for t in range(1, steps + 1):
        g = x @ w[:-1] + w[-1]
        s = 1 / (1 + np.exp(-np.clip(g, -30, 30)))
        loss = np.logaddexp(0, g)
        negative = loss[n_p:].mean() - prior * loss[:n_p].mean()      # R_U(-) - p R_P(-)
        grad_neg = np.concatenate([-prior * s[:n_p] / n_p, s[n_p:] / n_u])
        if negative >= 0:
            d = grad_neg
            d[:n_p] += prior * (s[:n_p] - 1) / n_p
        else:
            d = -grad_neg                                              # back to where the risk is one that can occur
        grad = np.append(d @ x, d.sum()) + decay * np.append(w[:-1], 0)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w = w - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w[:-1], float(w[-1])


def _matrix(rows: list, chosen: np.ndarray) -> np.ndarray:
    out = np.zeros((len(rows), len(chosen)), np.float32)
    for k, r in enumerate(rows):
        out[k] = np.isin(chosen, r, assume_unique=True)
    return out


def learn_from(pos: list, unl: list, prior: float, decay: float):
    """(buckets, weights, bias): the buckets whose share among the positives differs most, by chance's measure, from
    that among the unlabelled, no more of them than positives, and their weights."""
    p, u = (np.bincount(np.concatenate(part), minlength=BUCKETS) / len(part) for part in (pos, unl))
    z = (p - u) / np.sqrt((p * (1 - p) + 1 / len(pos)) / len(pos) + (u * (1 - u) + 1 / len(unl)) / len(unl))
    chosen = np.sort(np.argsort(-np.abs(z), kind="stable")[:min(FEATURES, len(pos))])
    return chosen, *nnpu(_matrix(pos, chosen), _matrix(unl, chosen), prior, decay=decay)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"):
    """(weights, bias), learned from rows outside the held-out fold; None without a confirmed toxic document.

    A document is toxic if any of its label rows is 1. The unlabelled set is drawn from those without a label, and
    where these are too few, from all others, so a fully labelled table gives a model as
    well. Ties in the hash go by id; rows that repeat an id are one document with several texts. The prior counts all labelled rows. The sample is the first of each class in the order
    of a hash of their ids; its ids are few, so texts are not shuffled to reach it.
    """
    spark = docs.sparkSession
    learn = ~F.coalesce(F.pmod(F.crc32(F.col("id").cast("string")), F.lit(FOLDS)) == HELD_OUT, F.lit(True))
    marked = (labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("y"))
              .where("id is not null and y is not null").groupBy("id").agg(F.max("y").alias("y")).where(learn))
    n, toxic = marked.agg(F.count("*"), F.count_if(F.col("y") == 1)).first()
    if not toxic:
        return None
    ids = docs.select(F.col(f"`{id_col}`").alias("id")).where("id is not null")
    first = lambda df, k: df.orderBy(F.xxhash64("id"), "id").limit(k)
    bare = ids.where(learn).distinct().join(marked, "id", "left")
    bare = bare.orderBy(F.col("y").isNotNull(), F.xxhash64("id"), "id").limit(UNLABELLED).select("id")
    pick = (first(marked.where("y = 1").select("id"), POSITIVES).withColumn("y", F.lit(1))
            .unionAll(bare.withColumn("y", F.lit(0))))
    chosen_ids = pick.toArrow()                                        # at most POSITIVES + UNLABELLED ids
    pick = spark.createDataFrame(chosen_ids.to_pandas(), pick.schema)

    def extract(batches):
        for batch in batches:
            at, buckets = features(batch.column(1).to_pylist())
            rows = [np.unique(buckets[a:b]).astype("<i4").tobytes() for a, b in zip(at, at[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], names=["y", "f"])

    text = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    got = text.join(F.broadcast(pick), "id").select("y", "text").mapInArrow(extract, "y int, f binary").toArrow()
    y = got["y"].to_numpy()
    rows = [np.frombuffer(b, "<i4") for b in got["f"].to_pylist()]
    pos, unl = [r for r, k in zip(rows, y) if k == 1], [r for r, k in zip(rows, y) if k == 0]
    prior = min(max(toxic / n, 1e-3), 0.999)
    if not pos or not unl:
        return None
    # the decay of least risk on a quarter of the sample that it was not fitted on
    def risk(decay):
        chosen, w, bias = learn_from([r for k, r in enumerate(pos) if k % 4], [r for k, r in enumerate(unl) if k % 4], prior, decay)
        g_p, g_u = (_matrix(part[::4], chosen) @ w + bias for part in (pos, unl))
        return prior * np.logaddexp(0, -g_p).mean() + max(0.0, np.logaddexp(0, g_u).mean() - prior * np.logaddexp(0, g_p).mean())

    chosen, w, bias = learn_from(pos, unl, prior, min(DECAYS, key=risk) if min(len(pos), len(unl)) >= 8 else DECAYS[-1])
    weights = np.zeros(BUCKETS)
    weights[chosen] = w
    return weights, bias


def toxic_score(docs: DataFrame, model, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the probability that a text is toxic; 0 if there is no model. Null and empty texts get the score
    of a text without words."""
    if model is None:
        return docs.withColumn(name, F.lit(0.0))
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        weights, bias = held.value
        return pd.Series(1 / (1 + np.exp(-np.clip(logits(texts.tolist(), weights, bias), -30, 30))))

    return docs.withColumn(name, score(F.col(f"`{text_col}`").cast("string")))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the documents that score the threshold or more. Columns, and rows with any null, stay."""
    row = docs.select(F.struct("*").alias("row"), F.col(f"`{text_col}`").alias("text"))
    scored = toxic_score(row, fit(docs, labels, id_col, text_col))
    return unpack(scored.where(F.col("score") < threshold), docs.columns)


def query(spark, sf):
    docs = table(spark, sf, "documents")
    scored = toxic_score(docs.select("doc_id", "text"), fit(docs, table(spark, sf, "labels")))
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(FOLDS)) == HELD_OUT, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


SQL = None
