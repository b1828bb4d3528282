"""Ranked lexical search, a term at a time and rarest first, with accumulators limited by bounds.

Documents are read once: what is kept of them is their length and their counts of the terms that queries hold. Then
each task takes the documents of a slice and, query by query, adds the contributions of one term after the
other. A document gets an accumulator when it first meets a term; once what the remaining terms can add at most
is below the k-th best partial score, no more are made, and those that exist are updated to the end, so scores
are exact. The best of a slice start the next one's threshold; the best of all tasks are ranked by Spark.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import keyed, stored, table

# [^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+ over UTF-8: the bytes that part terms become blanks, A-Z become a-z
_PARTS = [b for b in range(128) if not chr(b).isalnum()]
FOLD = bytes(0x20 if b in _PARTS else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
PIECE = 1 << 20            # bytes of a text split into terms at once
SLICE_DOCS, SLICE_POSTINGS = 1 << 16, 1 << 22   # documents that a task ranks together
QUERY_BYTES = 16 << 20     # of queries that are searched for together; more go group by group


def terms_of(text: bytes | None):
    """Lists of the terms of a text, in order, a piece at a time."""
    if not text:
        return
    folded = text.translate(FOLD)
    start = 0
    while start < len(folded):
        end = folded.find(b" ", start + PIECE)
        end = len(folded) if end < 0 else end
        yield folded[start:end].split()
        start = end


def _postings(base: DataFrame, vocabulary) -> DataFrame:
    """(id, n, terms, counts): each row's number of terms, and how often it holds those of the vocabulary."""
    kind = base.schema["id"].dataType.simpleString()

    def count(batches):
        for batch in batches:
            number = vocabulary.value
            for s in range(0, batch.num_rows, 512):
                part = batch.slice(s, 512)
                lengths, terms, counts = [], [], []
                for text in part.column(1).cast(pa.binary()):
                    held, n = Counter(), 0
                    for words in terms_of(text.as_py()):
                        n += len(words)
                        held.update(map(number.get, words))
                    held.pop(None, None)
                    lengths.append(n)
                    terms.append(list(held))
                    counts.append(list(held.values()))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(lengths, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))],
                                                 names=["id", "n", "terms", "counts"])

    return base.select("id", "text").mapInArrow(count, f"id {kind}, n long, terms array<int>, counts array<long>")


def _statistics(postings: DataFrame, terms: int) -> tuple[int, int, np.ndarray]:
    """N (documents with a term), L (all their terms) and the number of documents that hold each term."""
    def add(batches):
        docs, total, df = 0, 0, np.zeros(terms, np.int64)
        for batch in batches:
            n = batch.column(0).to_numpy()
            docs, total = docs + int((n > 0).sum()), total + int(n.sum())
            df += np.bincount(batch.column(1).flatten().to_numpy(), minlength=terms)
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(([-2, -1], held))), pa.array(np.concatenate(([docs, total], df[held])))], names=["term", "n"])

    got = postings.select("n", "terms").mapInArrow(add, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    sums = dict(zip(got["term"].to_pylist(), got["n"].to_pylist()))
    df = np.array([sums.get(t, 0) for t in range(terms)], np.int64)
    return sums.get(-2, 0), sums.get(-1, 0), df


def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)


def best_of_slice(size: int, lists: dict, query: list, k: int, floor: int):
    """(places, scores) of the k best of ``size`` documents, equal scores by place, and how many accumulators were made.

    ``lists``: term -> (places, contributions); ``query``: its terms, rarest first. Documents that cannot reach
    ``floor`` may be left out.
    """
    held = [lists[t] for t in query if t in lists]
    left = np.append(np.cumsum([int(c.max()) for _, c in held][::-1], dtype=np.int64)[::-1], 0)
    score, making, kth = np.zeros(size, np.int64), True, floor
    for (places, more), remaining in zip(held, left):
        if making and kth <= remaining < score.max(initial=0) and size > k:
            kth = max(kth, int(np.partition(score, size - k)[size - k]))
        making = making and remaining >= kth
        if making:
            score[places] += more
        else:
            has = score[places] > 0
            score[places[has]] += more[has]
    made = int((score > 0).sum())
    least = int(np.partition(score, size - k)[size - k]) if size > k else 0
    top = np.flatnonzero(score > max(least, 0))
    if least > 0:
        top = np.concatenate((top, np.flatnonzero(score == least)[:k - len(top)]))
    top = top[np.lexsort((top, -score[top]))]
    return top, score[top], made


def _ranked(postings: DataFrame, queries, weight, n_docs: int, total: int, k: int) -> DataFrame:
    kind, id_type = postings.schema["id"].dataType.simpleString(), to_arrow_type(postings.schema["id"].dataType)

    def rank(batches):
        best: dict = {}

        def take(held):
            whole = pa.Table.from_batches(held)
            whole = whole.take(pc.sort_indices(whole["id"], null_placement="at_end"))     # equal scores: by id
            ids, n = whole["id"], whole["n"].to_numpy()
            lists = whole["terms"].combine_chunks()
            sizes = np.diff(lists.offsets.to_numpy())
            term, doc = lists.flatten().to_numpy(), np.repeat(np.arange(len(n)), sizes)
            tf = whole["counts"].combine_chunks().flatten().to_numpy()
            m = 100 - 50 + (50 * n * n_docs) // max(total, 1)
            more = weight.value[term] * ((1000000000 * tf) // (1000 * tf + 20 * m[doc]))
            order = np.argsort(term, kind="stable")
            term, doc, more = term[order], doc[order], more[order]
            edge = np.append(np.flatnonzero(np.diff(term, prepend=-1)), len(term))
            found = {int(term[s]): (doc[s:e], more[s:e]) for s, e in zip(edge[:-1], edge[1:])}
            for no, query in queries.value:
                before = best.get(no, [])
                top, score, _ = best_of_slice(len(n), found, query, k, before[k - 1][0] if len(before) >= k else 0)
                if len(top):
                    now = before + list(zip(score.tolist(), ids.take(pa.array(top)).to_pylist()))
                    best[no] = sorted(now, key=lambda x: (-x[0], x[1] is None, x[1]))[:k] if before else now

        held, docs, postings_held = [], 0, 0
        for batch in batches:
            for s in range(0, batch.num_rows, 4096):
                part = batch.slice(s, 4096)
                held.append(part)
                docs, postings_held = docs + part.num_rows, postings_held + len(part.column(2).flatten())
                if docs >= SLICE_DOCS or postings_held >= SLICE_POSTINGS:
                    take(held)
                    held, docs, postings_held = [], 0, 0
        if held:
            take(held)
        rows = [(no, i, s) for no, found in best.items() for s, i in found]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], id_type), pa.array([r[2] for r in rows], pa.int64())],
                                         names=["no", "id", "score"])

    return postings.select("id", "n", "terms", "counts").mapInArrow(rank, f"no long, id {kind}, score long")


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", k: int = 50) -> DataFrame:
    r"""(item, rank, id, score): the ``k`` best documents with a score above 0 for each row of ``items``, all if fewer.

    Terms are the matches of ``[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+`` with A-Z lower-cased; null and empty texts have
    none. Equal scores rank by ascending id, a null id last, and rows that repeat an id are documents of their own, in any
    order among themselves. Each row of ``items`` is ranked by itself, also where it repeats an id; one without a term that a
    document holds has no rows. Empty tables give no rows.
    """
    spark = docs.sparkSession
    asked = stored(keyed(items, item_col, item_text_col).select(F.monotonically_increasing_id().alias("no"), F.col("id").alias("item"), "text"), "items")
    size = asked.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    groups = max(-(-size // QUERY_BYTES), 1)
    base = keyed(docs, id_col, text_col).select("id", "text")
    found = None
    for g in range(groups):
        mine = asked if groups == 1 else asked.where(F.pmod(F.xxhash64("no"), F.lit(groups)) == g)
        number: dict = {}
        queries = []
        for no, text in mine.select("no", "text").toLocalIterator():        # about QUERY_BYTES of text
            held = {w for words in terms_of(text.encode()) for w in words}
            queries.append((no, [number.setdefault(w, len(number)) for w in sorted(held)]))
        postings = stored(_postings(base, spark.sparkContext.broadcast(number)), "postings")
        n_docs, total, df = _statistics(postings, len(number))
        weight = spark.sparkContext.broadcast(weights(n_docs, df))
        rarest = [(no, sorted((t for t in terms if df[t]), key=lambda t: (df[t], t))) for no, terms in queries]
        best = _ranked(postings, spark.sparkContext.broadcast([q for q in rarest if q[1]]), weight, n_docs, total, k)
        found = best if found is None else found.unionByName(best)
    order = Window.partitionBy("no").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(asked.select("no", "item"), "no").select("item", "rank", "id", "score")


def query(spark, sf):
    out = search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return out.select(F.col("item").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")


SQL = r"""
with d as (select doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from documents),
q as (select distinct item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark),
len as (select doc_id, count(*) as n from d group by doc_id),
s as (select count(*) as nn, cast(sum(n) as bigint) as ll from len),
m as (select doc_id, 100 - 50 + ((50 * n * nn) // ll) as m from len, s),
tf as (select doc_id, term, count(*) as tf from d where term in (select term from q) group by doc_id, term),
w as (select term, cast(floor(1000 * ln((2 * max(nn) + 2) / (2 * count(*) + 1))) as bigint) as w from tf, s group by term),
r as (select item_id, tf.doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) as bigint) as score
      from q join tf on q.term = tf.term join w on w.term = tf.term join m on m.doc_id = tf.doc_id group by item_id, tf.doc_id)
select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as int) as rank, doc_id, score
from r where score > 0
qualify row_number() over (partition by item_id order by score desc, doc_id) <= 50
"""
