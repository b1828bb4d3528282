"""Exact dedup in two Bloom passes: only rows whose hash may stand twice shuffle, the rest pass straight through.

The first pass writes a 64-bit hash of every text without its blanks and fills a Bloom filter of two planes from
them: a slot's bit in the first plane says that it was hit, in the second that it was hit again. The second pass
probes each row: a hash of which all slots were hit again may be repeated, any other surely stands once. Of the
rows that may be repeated, a strong digest decides.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_groups, keyed, same, stored, table, unpack
from .line_dedup import BLANKS

PROBES = 4
BITS_A_ROW = 8          # of rows that stand once, some 2 % are taken for repeated ones
SEGMENT = 1 << 19       # bits that are merged together
MAX_BITS = 1 << 29      # 64 MB: what is broadcast at once, so 67 million rows; hashes of more go range by range


def normalised(text: Column) -> Column:
    return F.translate(text, BLANKS, "")


def _slots(h: np.ndarray, bits: int) -> np.ndarray:
    """PROBES slots of each hash, one row a probe."""
    h = h.view(np.uint64)
    a, b = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    return np.stack([(a + np.uint64(j) * b) % np.uint64(bits) for j in range(PROBES)]).astype(np.int64)


def _planes(segments: dict, slots: np.ndarray) -> None:
    """Hits ``slots`` in ``segments``: number -> (hit, hit again), each an array of bytes."""
    slots, times = np.unique(slots, return_counts=True)
    number = slots // SEGMENT
    edge = np.append(np.flatnonzero(np.diff(number, prepend=-1)), len(slots))
    for s, e in zip(edge[:-1].tolist(), edge[1:].tolist()):
        hit, again = segments.setdefault(int(number[s]), (np.zeros(SEGMENT // 8, np.uint8), np.zeros(SEGMENT // 8, np.uint8)))
        place = slots[s:e] % SEGMENT
        byte, bit = place >> 3, (1 << (place & 7)).astype(np.uint8)
        twice = ((hit[byte] & bit) != 0) | (times[s:e] > 1)
        np.bitwise_or.at(again, byte[twice], bit[twice])
        np.bitwise_or.at(hit, byte, bit)


def repeated_filter(hashes: DataFrame, bits: int) -> np.ndarray:
    """The plane of slots hit again by the column ``hash``, ``bits`` long. Tasks fill planes of their own, which are
    merged segment by segment; a hash that many rows hold is no more than its slots to any task."""
    def fill(batches):
        segments: dict = {}
        for batch in batches:
            _planes(segments, _slots(batch.column(0).to_numpy(), bits).ravel())
        for number, (hit, again) in segments.items():
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([hit.tobytes()], pa.binary()), pa.array([again.tobytes()], pa.binary())],
                                             names=["segment", "hit", "again"])

    def merge(part: pa.Table) -> pa.Table:
        hit, again = np.zeros(SEGMENT // 8, np.uint8), np.zeros(SEGMENT // 8, np.uint8)
        for h, a in zip(part.column("hit"), part.column("again")):
            h = np.frombuffer(h.as_py(), np.uint8)
            again |= np.frombuffer(a.as_py(), np.uint8) | (hit & h)
            hit |= h
        return pa.table({"segment": part.column("segment")[:1].cast(pa.int64()), "again": pa.array([again.tobytes()], pa.binary())})

    filled = hashes.mapInArrow(fill, "segment long, hit binary, again binary")
    got = filled.groupBy("segment").applyInArrow(merge, "segment long, again binary").toArrow()
    plane = np.zeros(bits // 8, np.uint8)
    for number, again in zip(got["segment"].to_pylist(), got["again"]):
        plane[number * (SEGMENT // 8):(number + 1) * (SEGMENT // 8)] = np.frombuffer(again.as_py(), np.uint8)
    return plane


def _probe(again, bits: int):
    @F.pandas_udf("boolean")
    def probe(h: pd.Series) -> pd.Series:
        slots = _slots(h.to_numpy().astype(np.int64), bits)
        return pd.Series(((again.value[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1).astype(bool).all(axis=0))

    return probe


def _probed(base: DataFrame, max_bits: int = MAX_BITS):
    """(rows counted, [frames]): ``base`` with ``maybe``, whether its text may be repeated; a frame for each range of hashes,
    one unless the rows are more than a broadcast filter holds."""
    spark = base.sparkSession
    hashes = stored(base.select(F.xxhash64(normalised(F.col("text"))).alias("hash")), "hashes")
    total = hashes.count()
    ranges = max(-(-total * BITS_A_ROW // max_bits), 1)
    bits = -(-max(total * BITS_A_ROW // ranges, 1) // SEGMENT) * SEGMENT
    which = F.expr(f"pmod(shiftrightunsigned(hash, 48), {ranges})")
    frames = []
    for r in range(ranges):
        mine = hashes if ranges == 1 else hashes.where(which == r)
        probe = _probe(spark.sparkContext.broadcast(repeated_filter(mine, bits)), bits)
        rows = base.withColumn("hash", F.xxhash64(normalised(F.col("text"))))
        rows = rows if ranges == 1 else rows.where(which == r)
        frames.append(rows.withColumn("maybe", probe("hash")))
    return total, frames


def _digest() -> Column:
    return F.unhex(F.sha2(normalised(F.col("text")).cast("binary"), 256))


def find_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    r"""One row per row of ``docs``: ``id``, ``keep_id``, ``group_size``, ``kept``, ``digest`` (SHA-256 of the normalised text).

    Texts are equal that are identical without the characters ``[\x20\x09-\x0D]``; null counts as empty. Of equal texts,
    the row with the most code points as it stands stays, then the smallest id (a null id is the largest), then any
    one of the rows that repeat it, so exactly one row of a group is ``kept``. An empty table gives no rows.
    """
    base = keyed(docs, id_col, text_col)
    total, frames = _probed(base, max_bits)
    narrow = [f.select("id", _digest().alias("digest"), F.char_length("text").alias("n_chars"), "maybe",
                       F.struct(F.lit(r).alias("range"), F.monotonically_increasing_id().alias("no")).alias("place")) for r, f in enumerate(frames)]
    marked = narrow[0]
    for other in narrow[1:]:
        marked = marked.unionByName(other)
    marked = stored(marked, "marked")          # the place of a row is fixed from here on
    alone = marked.where("not maybe").select("id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "digest")
    some = marked.where("maybe").drop("maybe")
    first = F.min(F.struct((-F.col("n_chars")).alias("n"), F.col("id").isNull().alias("none"), "id", "place"))
    groups = some.groupBy("digest").agg(F.count("*").alias("group_size"), first.alias("first"))
    groups = stored(groups.select("digest", "group_size", F.col("first.id").alias("keep_id"), F.col("first.place").alias("keep_place")), "groups")
    met = join_groups(some, groups, "digest", "group_size", total)
    return met.select("id", "keep_id", "group_size", (F.col("place") == F.col("keep_place")).alias("kept"), "digest").unionByName(alone)


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` without the rows that ``find_duplicates`` does not keep (of rows that agree in id and text, any one stays)."""
    base = keyed(docs, id_col, text_col)
    _, frames = _probed(base, max_bits)
    out = None
    for f in frames:
        some = f.where("maybe").select("row", "id", "tag", _digest().alias("digest"), F.char_length("text").alias("n_chars"))
        first = F.min(F.struct((-F.col("n_chars")).alias("n"), F.col("id").isNull().alias("none"), "id", "tag")).alias("first")
        stay = some.groupBy("digest").agg(first).select(F.col("digest").alias("k_digest"), F.col("first.id").alias("k_id"), F.col("first.tag").alias("k_tag"))
        best = some.join(stay, same(some, stay, ("digest", "k_digest"), ("id", "k_id"), ("tag", "k_tag"))).dropDuplicates(["digest"])
        kept = f.where("not maybe").select("row").unionByName(best.select("row"))
        out = kept if out is None else out.unionByName(kept)
    return unpack(out, docs.columns)


def query(spark, sf):
    out = find_duplicates(table(spark, sf, "documents"))
    return out.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


SQL = r"""
with d as (select doc_id, length(coalesce(text, '')) as n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as t from documents)
select doc_id, first_value(doc_id) over w as keep_id, count(*) over (partition by t) as group_size,
       row_number() over w = 1 as kept, sha256(t) as text_sha256
from d window w as (partition by t order by n desc, doc_id)
"""
