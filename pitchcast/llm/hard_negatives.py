"""Hard-negative mining with lists that the anchors of a cluster share, sorted by angular upper bound.

The angle between an anchor and a candidate is no smaller than the angle between the candidate and the centre of the
anchor's cluster, less the widest angle between that centre and an anchor of the cluster. So one list, sorted by the candidate's length
times the cosine of that difference, bounds the scores of all of a cluster's anchors. Each walks the list from its head and
stops where the bound certifies that nothing behind can be among its best. Candidates lie in parts, anchors
in blocks; a task joins one of each, and Spark ranks the best of all parts.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, table

SAMPLE = 20_000            # anchors that the centres are fitted on
CLUSTERS = 16
PARTS, PART_ROWS = 32, 1 << 16    # candidates lie in PARTS parts, in more once a part would hold more rows than PART_ROWS
BLOCK_ROWS = 1 << 15       # anchors of a block
MEMBERS = 64               # anchors that walk a list side by side
STEP = 256                 # candidates walked before the first look at the bound; twice as many before each next
ROUNDS = 8                 # of fitting the centres


def centres(vectors: np.ndarray, clusters: int = CLUSTERS) -> np.ndarray:
    """Unit vectors of spherical k-means; none if no vector has a direction."""
    norm = np.linalg.norm(vectors, axis=1)
    x = vectors[norm > 0] / norm[norm > 0, None]
    if not len(x):
        return np.zeros((0, vectors.shape[1]))
    c = x[np.linspace(0, len(x) - 1, min(clusters, len(x))).astype(int)]
    for _ in range(ROUNDS):
        near = (x @ c.T).argmax(axis=1)
        c = np.stack([x[near == j].sum(axis=0) if (near == j).any() else c[j] for j in range(len(c))])
        size = np.linalg.norm(c, axis=1, keepdims=True)
        c = np.where(size > 0, c / np.where(size > 0, size, 1), 0)
    return c


def matrix(column: pa.ChunkedArray, width: int = 0) -> np.ndarray:
    """Rows of whole numbers as an array; shorter ones are filled with zeros."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat, size = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    wide = max(int(size.max(initial=0)), width)
    if len(size) and (size == wide).all():
        return flat.reshape(len(size), wide)
    out = np.zeros((len(size), wide), np.int64)
    out[np.repeat(np.arange(len(size)), size), np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products in 64-bit integers; through doubles where those are exact."""
    largest = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    return (a.astype(float) @ b.astype(float).T).astype(np.int64) if largest < 2**53 else a @ b.T


def _angles(x: np.ndarray, norm: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Angle to the centre; 0 for a vector without a direction, whose scores are 0 anyway."""
    return np.where(norm > 0, np.arccos(np.clip(x @ centre / np.where(norm > 0, norm, 1), -1, 1)), 0)


def walks(anchors: np.ndarray, candidates: np.ndarray, allowed, low: np.ndarray, high: np.ndarray, order: np.ndarray, k: int, centre: np.ndarray):
    """Yields (anchor, window, candidates, scores): for each anchor and each of its windows ``low..high`` of scores the first
    ``k`` allowed candidates, higher scores first, ties by ``order``; and last, how many products were made.

    All anchors share one list of the candidates, sorted by the bound that ``centre`` gives. ``allowed(anchors,
    candidates)`` is a table of booleans.
    """
    size_a, size_c = np.linalg.norm(anchors.astype(float), axis=1), np.linalg.norm(candidates.astype(float), axis=1)
    widest = float(_angles(anchors.astype(float), size_a, centre).max(initial=0))
    bound = size_c * np.cos(np.maximum(_angles(candidates.astype(float), size_c, centre) - widest, 0))
    listed = np.argsort(-bound, kind="stable")
    bound = bound[listed] + 1e-6 * size_c.max(initial=0)      # more than rounding can take from it
    made = 0
    for s in range(0, len(anchors), MEMBERS):
        who = np.arange(s, min(s + MEMBERS, len(anchors)))
        score = np.zeros((len(who), len(listed)), np.int64)
        good = np.zeros((len(who), len(listed)), bool)
        walked = np.zeros(len(who), np.int64)
        active, at, step = np.arange(len(who)), 0, STEP
        while at < len(listed) and len(active):
            end = min(at + step, len(listed))
            score[active, at:end] = products(anchors[who[active]], candidates[listed[at:end]])
            good[active, at:end] = allowed(who[active], listed[at:end])
            made += len(active) * (end - at)
            walked[active] = end
            at, step = end, step * 2
            if at < len(listed):
                rest = np.floor(size_a[who[active]] * bound[at]) + 1        # what is left scores less
                done = np.ones(len(active), bool)
                for w in range(low.shape[1]):
                    least, most = low[who[active], w], high[who[active], w]
                    floor = np.maximum(least, rest)
                    seen = good[active, :at] & (score[active, :at] >= floor[:, None]) & (score[active, :at] <= most[:, None])
                    done &= (seen.sum(axis=1) >= k) | (rest <= least)
                active = active[~done]
        for i, a in enumerate(who):
            n = walked[i]
            for w in range(low.shape[1]):
                fit = np.flatnonzero(good[i, :n] & (score[i, :n] >= low[a, w]) & (score[i, :n] <= high[a, w]))
                if len(fit) > k:
                    fit = fit[score[i, fit] >= np.partition(score[i, fit], len(fit) - k)[len(fit) - k]]
                fit = fit[np.lexsort((order[listed[fit]], -score[i, fit]))][:k]
                if len(fit):
                    yield int(a), w, listed[fit], score[i, fit]
    yield None, made, None, None


def _ordered(ids) -> np.ndarray:
    """Place of each id in ascending order, nulls last."""
    place = np.empty(len(ids), np.int64)
    place[pc.sort_indices(ids, null_placement="at_end").to_numpy()] = np.arange(len(ids))
    return place


def _codes(*columns) -> list[np.ndarray]:
    """Equal numbers for equal values of the columns; a null equals nothing."""
    whole = pa.chunked_array([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns]).combine_chunks()
    code = pc.fill_null(whole.dictionary_encode().indices, -1).to_numpy(zero_copy_only=False).astype(np.int64)
    code = np.where(code < 0, -np.arange(1, len(code) + 1), code)
    return np.split(code, np.cumsum([len(c) for c in columns])[:-1])


def _best(blocks: DataFrame, parts: DataFrame, middle, k: int, same: bool, id_kind: str) -> DataFrame:
    """(no, window, id, score): the best of each part for each anchor, of its own label (``same``) or of any other."""
    def task(key, left: pa.Table, right: pa.Table) -> pa.Table:
        cols = {"no": [], "window": [], "id": [], "score": []}
        if left.num_rows and right.num_rows:
            width = max(matrix(left["v"]).shape[1], matrix(right["v"]).shape[1])
            a, c = matrix(left["v"], width), matrix(right["v"], width)
            label_a, label_c = _codes(left["label"], right["label"])
            id_a, id_c = _codes(left["id"], right["id"])
            order, ids, no = _ordered(right["id"].combine_chunks()), right["id"], left["no"].to_numpy()
            low, high = matrix(left["low"]), matrix(left["high"])
            mid = middle.value
            mid = np.pad(mid, ((0, 0), (0, max(width - mid.shape[1], 0))))[:, :max(width, mid.shape[1])]
            if mid.shape[1] > width:
                a, c = (np.pad(x, ((0, 0), (0, mid.shape[1] - width))) for x in (a, c))
            near = (a @ mid.T).argmax(axis=1) if len(mid) else np.zeros(len(a), np.int64)
            # of the own label, only that label's candidates are listed
            for group in np.unique(np.stack([near, label_a if same else np.zeros(len(a), np.int64)], axis=1), axis=0):
                mine = np.flatnonzero((near == group[0]) & ((label_a == group[1]) | (not same)))
                theirs = np.flatnonzero(label_c == group[1]) if same else np.arange(len(c))

                def allowed(x, y):
                    x, y = mine[x], theirs[y]
                    return id_a[x][:, None] != id_c[y] if same else label_a[x][:, None] != label_c[y]

                centre = mid[group[0]] if len(mid) else np.zeros(a.shape[1])
                for i, w, found, score in walks(a[mine], c[theirs], allowed, low[mine], high[mine], order[theirs], k, centre):
                    if i is not None:
                        cols["no"] += [int(no[mine[i]])] * len(found)
                        cols["window"] += [w] * len(found)
                        cols["id"] += theirs[found].tolist()
                        cols["score"] += score.tolist()
        ids = right["id"].combine_chunks().take(pa.array(cols["id"], pa.int64()))
        return pa.table({"no": pa.array(cols["no"], pa.int64()), "window": pa.array(cols["window"], pa.int32()), "id": ids, "score": pa.array(cols["score"], pa.int64())})

    dealt = blocks.groupBy("block", "part").cogroup(parts.groupBy("block", "part"))
    return dealt.applyInArrow(task, f"no long, window int, id {id_kind}, score long")


def _top(df: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for rows of ``id``, ``label`` and ``v``
    (whole numbers), the anchors among them marked by ``anchor``.

    Scores are inner products, the higher the better, ties by smaller id (a null id is the largest). An anchor's positives are the first
    rows of its label with another id; its negatives for a positive the first rows of another label whose score is ``low`` to
    ``high`` hundredths of the positive's. Rows with a null label or vector, or a null in it, take no part; rows that repeat id,
    label and vector count once; of vectors of different lengths the shorter is filled with zeros; scores are
    64-bit. An anchor without positives or negatives has no rows, nor has an empty table.
    """
    spark = rows.sparkSession
    kind = rows.schema["id"].dataType.simpleString()
    held = rows.where(F.col("label").isNotNull() & F.col("v").isNotNull() & ~F.exists("v", lambda x: x.isNull()))
    held = stored(held.select("id", "label", F.col("v").cast("array<long>").alias("v"), F.coalesce(anchor, F.lit(False)).alias("anchor")), "vectors")
    # rows of one label and vector score alike with every anchor, so only the smallest ids of them can be among the first
    most = max(positives + 1, negatives)
    alike = Window.partitionBy("label", "v").orderBy(F.col("id").asc_nulls_last())
    candidates = (held.drop("anchor").withColumn("nth", F.dense_rank().over(alike)).where(F.col("nth") <= most)
                  .dropDuplicates(["label", "v", "id"]).drop("nth"))
    asked = stored(held.where("anchor").select("id", "label", "v").distinct().withColumn("no", F.monotonically_increasing_id()), "anchors")
    n, n_asked = held.count(), asked.count()
    sample = asked.orderBy(F.xxhash64("no")).select("v").limit(SAMPLE).toArrow()
    middle = spark.sparkContext.broadcast(centres(matrix(sample["v"]).astype(float)) if n_asked else np.zeros((0, 0)))
    parts, blocks = max(PARTS, -(-n // PART_ROWS)), max(-(-n_asked // BLOCK_ROWS), 1)
    every = lambda count, name: F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias(name)
    parted = candidates.withColumn("part", F.pmod(F.xxhash64("id", "v"), F.lit(parts)).cast("int")).select("*", every(blocks, "block"))

    def dealt(df):
        return df.withColumn("block", F.pmod(F.xxhash64("no"), F.lit(blocks)).cast("int")).select("*", every(parts, "part"))

    wide = asked.select("*", F.array(F.lit(-(2**63)).cast("long")).alias("low"), F.array(F.lit(2**63 - 1).cast("long")).alias("high"))
    first = stored(_top(_best(dealt(wide), parted, middle, positives, True, kind), ["no"], positives), "positives")
    hundredth = lambda s, x: F.call_function("div", s * x - F.pmod(s * x, F.lit(100)), F.lit(100))   # noqa: E731  (rounded down)
    windows = (first.groupBy("no").agg(F.array_sort(F.collect_list(F.struct(F.col("rank").alias("nth"), "id", "score"))).alias("found"))
               .select("no", F.transform("found", lambda p: -hundredth(-p["score"], F.lit(low))).alias("low"),
                       F.transform("found", lambda p: hundredth(p["score"], F.lit(high))).alias("high")))
    best = _best(dealt(asked.join(windows, "no")), parted, middle, negatives, False, kind)
    found = _top(best, ["no", "window"], negatives)
    pairs = first.select("no", (F.col("rank") - 1).alias("window"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return (found.join(pairs, ["no", "window"]).join(asked.select("no", F.col("id").alias("anchor_id")), "no")
            .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(id, label, v): components become floor(256 * x); rows with a null or non-finite one are left out."""
    x = F.col(f"row.`{vector_col}`").cast("array<double>")
    odd = F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(math.inf)))
    return (vectors.select(F.struct("*").alias("row"))
            .select(F.col(f"row.`{id_col}`").alias("id"), F.col(f"row.`{label_col}`").alias("label"), x.alias("x"))
            .where(F.col("x").isNotNull() & ~F.coalesce(odd, F.lit(True)))
            .select("id", "label", F.transform("x", lambda c: F.floor(c * F.lit(256.0))).alias("v")))


def query(spark, sf):
    rows = quantised(table(spark, sf, "embeddings"))
    moved = F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.withColumn("label", moved), F.col("id") % 100 == 0)


SQL = """
with e as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                  list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
           from embeddings where label is not null and embedding is not null
             and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.vec_id as anchor_id, a.label as own, b.vec_id, b.label, cast(list_inner_product(a.v, b.v) as bigint) as score
      from e a join e b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0),
p as (select anchor_id, own, vec_id as positive_id, score as positive_score from s where own = label
      qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5),
n as (select p.anchor_id, positive_id, positive_score, vec_id as negative_id, score as negative_score,
             row_number() over (partition by p.anchor_id, positive_id order by score desc, vec_id) as r
      from p join s on s.anchor_id = p.anchor_id and s.label <> p.own
       and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score)
select anchor_id, positive_id, cast(r as int) as rank, negative_id, positive_score, negative_score from n where r <= 10
"""
