"""Removal of repeated byte strings by induced sorting of sampled suffixes, external and in parallel.

Equal strings of ``width`` bytes hold equal samples: the sample of a string is the least
hash among its substrings of half that width. So only sampled suffixes (about one in
fifty) are named and counted across the corpus, and only those whose sample stands more
than once go on. Those are sorted by Spark (an external merge of runs on disk), with the
length that neighbours share, and the suffixes before them are induced from their
order: the order of the suffixes one byte to the left follows from the byte put in front and
the order before, and what two of them share is one more than the least shared between
them. A suffix that shares ``width`` bytes with a neighbour starts a repeated string.

Sorting every suffix of a corpus would move some 16 bytes for each of its bytes; this
moves about one for each byte, and no task or driver holds the corpus.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keyed, same, stored, table
from .rolling import Hasher, joined, portions

WIDTH = 200
PIECE = 1 << 18        # bytes of a text looked at together; pieces overlap by width - 1 bytes
MARKS_EACH = 8         # bits of a mark table for each value in it
MAX_MARKS = 1 << 28    # 32 MB: a larger table is not made, a join on the values takes its place
BLOCK = 16 << 20       # bytes of a row group of the samples
STRIDE = 1_000_003     # of the starts in a text, in the marks of its samples
CROWD = 20_000         # different surroundings of one sample that a task takes in; more go another, exact way


def _sliding_least(x: np.ndarray, w: int) -> np.ndarray:
    """The least of each w neighbours."""
    n = len(x) - w + 1
    rows = -(-len(x) // w)
    full = np.full(rows * w, np.uint64(0xFFFFFFFFFFFFFFFF))
    full[:len(x)] = x
    grid = full.reshape(rows, w)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[w - 1:w - 1 + n])


def _without_periods(data: np.ndarray, h: np.ndarray, first: np.ndarray, last: np.ndarray, at: np.ndarray, width: int):
    """The samples less those inside periodic runs, and the runs (start, end) with all of their strings repeated.

    Where bytes repeat with a short period p, samples of one name follow each other p apart. All strings of such a
    run that is at least ``width + p`` long stand in it twice, so the run is a span by itself, and for the rest of the corpus its
    first p starts tell all its strings: of its samples only those with other starts as well are kept.
    """
    half = width // 2
    name = h[at]
    step = np.diff(at)
    link = (name[1:] == name[:-1]) & (step <= half)
    link[1:] &= ~link[:-1] | (step[1:] == step[:-1])          # a chain has one period
    edge = np.flatnonzero(np.diff(np.concatenate(([0], link.astype(np.int8), [0]))))
    keep, runs = np.ones(len(at), bool), []
    for a, b in zip(edge[0::2].tolist(), edge[1::2].tolist()):      # samples a..b are linked
        p, start, end = int(step[a]), int(at[a]), int(at[b]) + half
        if end - start < width + p or (step[a:b] != p).any() or (data[start:end - p] != data[start + p:end]).any():
            continue
        runs.append((start, end))
        keep[a:b + 1] = (first[a:b + 1] < start + p) | (last[a:b + 1] + width > end)
    return first[keep], last[keep], at[keep], np.array(runs, np.int64).reshape(-1, 2)


def samples(texts: list, width: int):
    """Yields (data, text, offset, at, first, last, name, around, spans) for pieces of the texts (bytes) with any string of
    ``width`` bytes. ``spans``: (texts, starts, ends) of periodic runs, repeated by themselves. For each sample in the piece: the index of its text, where the piece's text starts in ``data`` less where
    it starts in the text, the sample's place in data, the first and last start of the strings it stands for, the hash of
    its bytes and the hash of all bytes from ``first`` to the end of the last string."""
    half = width // 2

    def pieces():
        for i, t in enumerate(texts):
            t = t or b""
            for s in range(0, max(len(t) - width + 1, 0), PIECE):
                yield i, s, t[s:s + PIECE + width - 1]

    def chunks():
        held, size = [], 0
        for p in pieces():
            held.append(p)
            size += len(p[2])
            if size >= PIECE:
                yield held
                held, size = [], 0
        if held:
            yield held

    for chunk in chunks():
        data, begin = joined([b for _, _, b in chunk])
        hasher = Hasher(data)
        h = hasher.windows(half)
        least = _sliding_least((h & np.uint64(0xFFFFFFFFF0000000)) | np.arange(len(h), dtype=np.uint64), width - half + 1)
        least &= np.uint64(0xFFFFFFF)
        edge = np.flatnonzero(least[1:] != least[:-1]) + 1
        first, last = np.append(0, edge), np.append(edge, len(least)) - 1
        at = least[first].astype(np.int64)
        first, last, at, runs = _without_periods(data, h, first, last, at, width)
        # of the strings that a sample stands for, those that lie in its own piece (the line feed after it left out)
        own = np.searchsorted(begin, at, side="right") - 1
        first, last = np.maximum(first, begin[own]), np.minimum(last, begin[own + 1] - 1 - width)
        good = np.flatnonzero(first <= last)
        if not len(good):
            continue
        first, last, at, own = first[good], last[good], at[good], own[good]
        where = np.array([c[:2] for c in chunk], np.int64).reshape(-1, 2)
        around = hasher.ranges(first, last + width) ^ ((at - first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        # a periodic run lies in one piece, as the line feed between pieces breaks it
        in_run = np.searchsorted(begin, runs[:, 0], side="right") - 1
        spans = (where[in_run, 0], runs[:, 0] - begin[in_run] + where[in_run, 1], runs[:, 1] - begin[in_run] + where[in_run, 1])
        yield data, where[own, 0], begin[own] - where[own, 1], at, first, last, h[at].view(np.int64), around.view(np.int64), spans


def _bit(marks: np.ndarray | None, name: np.ndarray) -> np.ndarray:
    """Which values may be in the table; all where there is none."""
    if marks is None:
        return np.ones(len(name), bool)
    place = (name.view(np.uint64) % np.uint64(len(marks) * 32)).astype(np.int64)
    return (marks[place // 32] >> (place % 32)) & 1 == 1


def _mark_table(df: DataFrame, column: str, max_marks: int = MAX_MARKS) -> np.ndarray | None:
    """A table of bits with one for each value, MARKS_EACH times as long as there are values, so about one in eight is set. None if it
    would be longer than ``max_marks``: then the values themselves decide, in the joins that follow each use."""
    size = 1 << max(df.count() * MARKS_EACH - 1, 1 << 16).bit_length()
    if size > max_marks:
        return None
    place = F.expr(f"cast(pmod(pmod({column}, {size}L), {size}L) as long)")
    got = (df.select(place.alias("p")).groupBy(F.expr("p div 32").alias("w"))
           .agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 32 as int))")).alias("b")).toArrow())
    marks = np.zeros(size // 32, np.int64)
    marks[got["w"].to_numpy()] = got["b"].to_numpy()
    return marks


def induced(group: np.ndarray, left: list, right: list, low: np.ndarray, high: np.ndarray, width: int) -> np.ndarray:
    """For members in order of (group, right): a table (member, offset) that tells which strings, ``offset`` bytes
    before the member's sample, stand more than once in its group. ``left``: the bytes before the sample, nearest first;
    ``right``: those from it on; strings start ``low`` to ``high`` bytes before it."""
    n, deep = len(group), int(high.max()) + 1
    fixed = lambda rows, w: np.frombuffer(b"".join(r[:w].ljust(w, b"\0") for r in rows), np.uint8).reshape(len(rows), w)
    r, l = fixed(right, width), fixed(left, deep)
    size = np.fromiter((len(x) for x in right), np.int64, n)
    shared = np.zeros(n, np.int64)                        # with the member before
    if n > 1:
        differs = r[1:] != r[:-1]
        shared[1:] = np.where(differs.any(axis=1), differs.argmax(axis=1), width)
        shared[1:] = np.minimum(shared[1:], np.minimum(size[1:], size[:-1]))
        shared[1:][group[1:] != group[:-1]] = -width * 2
    shared[0] = -width * 2
    out = np.zeros((n, deep), bool)
    order = np.arange(n)
    for d in range(deep):
        if d:
            go = np.flatnonzero(high[order] >= d)
            # least shared between each remaining member and the one that remains before it
            if not len(go):
                break
            gap = np.minimum.reduceat(shared[:go[-1] + 1], np.append(0, go[:-1] + 1))
            order = order[go]
            byte = group[order] * 256 + l[order, d - 1]
            turn = np.argsort(byte, kind="stable")
            # least shared over the run between two that come next to each other: runs grow from their ends
            before = turn[:-1]
            shared = np.full(len(turn), -width * 2, np.int64)
            alike = np.flatnonzero(byte[turn[1:]] == byte[before]) + 1
            a, b = turn[alike - 1] + 1, turn[alike] + 1
            near = b - a == 1
            shared[alike[near]] = gap[a[near]] + 1
            far = np.flatnonzero(~near)
            if len(far):
                bounds = np.stack([a[far], b[far]], axis=1).ravel()
                padded = np.append(gap, np.iinfo(np.int64).max)
                shared[alike[far]] = np.minimum.reduceat(padded, bounds)[::2] + 1
            order = order[turn]
        both = shared >= width
        hit = both.copy()
        hit[:-1] |= both[1:]
        hit &= (low[order] <= d)
        out[order[hit], d] = True
    return out


def repeated_spans(base: DataFrame, width: int = WIDTH) -> DataFrame:
    """(id, tag, start, end): byte ranges covered by strings of ``width`` bytes that also start elsewhere."""
    spark = base.sparkSession
    kind = base.schema["id"].dataType.simpleString()
    texts = base.select("id", "tag", "text")

    def portioned(batches, column):
        """Slices of a batch with about a megabyte of texts, and these as bytes."""
        for batch in batches:
            for s, n in portions(batch.column(column)):
                part = batch.slice(s, n)
                yield part, part.column(column).cast(pa.binary()).to_pylist()

    def named(batches):
        for _, held in portioned(batches, 0):
            for *_, name, around, _ in samples(held, width):
                both, times = _pairs(name, around)
                yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(times.astype(np.int64))], names=["name", "around", "n"])

    names = base.select("text").mapInArrow(named, "name long, around long, n long")
    again = stored(names.groupBy("name").agg(F.sum("n").alias("n"), F.min("around").alias("a"), F.max("around").alias("b"))
                   .where("n > 1").select("name"), "names")
    twice = spark.sparkContext.broadcast(_mark_table(again, "name"))

    def met(batches):
        for batch, held in portioned(batches, 2):
            for data, text, shift, at, first, last, name, around, (run, start, end) in samples(held, width):
                if len(run):       # periodic runs: spans without a name
                    none, take = pa.nulls(len(run), pa.int64()), pa.array(run)
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), none, pa.nulls(len(run), pa.binary()),
                                                      pa.array(start), pa.array(end - width)], names=["id", "tag", "name", "around", "first", "last"])
                k = np.flatnonzero(_bit(twice.value, name))
                raw = data.tobytes()
                strong = [hashlib.blake2b(raw[a:b + width], digest_size=16, salt=int(c - a).to_bytes(16, "little")).digest()
                          for a, b, c in zip(first[k].tolist(), last[k].tolist(), at[k].tolist())]
                take = pa.array(text[k])
                yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array(name[k]), pa.array(strong, pa.binary()),
                                                  *(pa.array((x - shift)[k]) for x in (first, last))], names=["id", "tag", "name", "around", "first", "last"])

    met_rows = texts.mapInArrow(met, f"id {kind}, tag long, name long, around binary, first long, last long")
    if twice.value is None:      # more names than a table is made for: they are joined
        met_rows = met_rows.join(again.withColumnRenamed("name", "again"), F.col("name") == F.col("again"), "left").where("again is not null or name is null").drop("again")
    every = stored(met_rows, "samples", BLOCK)
    runs, found = every.where("name is null"), every.where("name is not null")
    # (a name that stands once, and came along because its mark coincides with another's, has one surroundings that stands once)
    # whole surroundings that stand more than once: all their strings do
    around = found.groupBy("name", "around").agg(F.count("*").alias("n"), F.min(F.struct("tag", "first", "id")).alias("one"))
    around = stored(around, "around")
    copies = found.join(around.where("n > 1").select("name", "around").repartition("around"), ["name", "around"]).select(
        "id", "tag", F.col("first").alias("start"), (F.col("last") + width).alias("end"))

    # one member for each different surroundings of a name that has several
    crowd = around.groupBy("name").agg(F.count("*").alias("ways")).where("ways > 1")
    ones = around.join(crowd, "name").select("name", "ways", "one.tag", "one.first", "one.id")
    ones = stored(ones.withColumn("mark", F.expr(f"tag ^ (first * {STRIDE})")), "ones")
    chosen = spark.sparkContext.broadcast(_mark_table(ones, "mark"))

    def contents(batches):
        for batch, held in portioned(batches, 2):
            out, tag = [], batch.column(1).to_numpy()
            for data, text, shift, at, first, last, name, _, _ in samples(held, width):
                k = np.flatnonzero(_bit(chosen.value, tag[text] ^ ((first - shift) * STRIDE)))
                k = k[_bit(twice.value, name[k])]
                raw = data.tobytes()
                out += [(t, int(n), int(f - s), int(l - s), int(c - s), raw[f:c][::-1], raw[c:l + width])
                        for t, n, f, l, c, s in zip(text[k].tolist(), name[k], first[k], last[k], at[k], shift[k])]
            take = pa.array([o[0] for o in out], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), *(pa.array([o[j] for o in out], pa.int64()) for j in (1, 2, 3, 4)),
                                              pa.array([o[5] for o in out], pa.binary()), pa.array([o[6] for o in out], pa.binary())],
                                             names=["id", "tag", "name", "first", "last", "at", "left", "right"])

    filled = texts.mapInArrow(contents, f"id {kind}, tag long, name long, first long, last long, at long, left binary, right binary")
    ones_ = ones.withColumnsRenamed({"id": "o_id", "tag": "o_tag", "first": "o_first", "name": "o_name"}).drop("mark")
    members = filled.join(ones_, same(filled, ones_, ("id", "o_id"), ("tag", "o_tag"), ("first", "o_first"), ("name", "o_name"))).select(
        "id", "tag", "name", "first", "last", "at", "left", "right", "ways")
    members = stored(members, "members", BLOCK)

    def sorted_runs(batches):
        def spans(rows):
            name, right = [r[2] for r in rows], [r[7] for r in rows]
            group = np.cumsum(np.array([a != b for a, b in zip(name, [None, *name])]))
            at, first, last = (np.array([r[j] for r in rows], np.int64) for j in (5, 3, 4))
            hits = induced(group, [r[6] for r in rows], right, at - last, at - first, width)
            edge = np.diff(np.pad(hits, ((0, 0), (1, 1))).astype(np.int8), axis=1)
            (who, near), (_, far) = np.nonzero(edge == 1), np.nonzero(edge == -1)
            return [(rows[m][0], rows[m][1], int(at[m] - f + 1), int(at[m] - n + width)) for m, n, f in zip(who.tolist(), near.tolist(), far.tolist())]

        rows = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if len(rows) >= CROWD and row[2] != rows[-1][2]:
                    yield _span_batch(spans(rows), batch.schema.field(0).type)
                    rows = []
                rows.append(row)
        if rows:
            yield _span_batch(spans(rows), batch.schema.field(0).type)

    dealt = members.where(F.col("ways") <= CROWD).drop("ways").repartition("name").sortWithinPartitions("name", "right")
    schema = f"id {kind}, tag long, start long, end long"
    near = dealt.mapInArrow(sorted_runs, schema)

    # a sample with more surroundings than a task takes in: each of its strings is named, and names are counted
    def strings(batches):
        for batch in batches:
            out = []
            for i, (_, _, _, first, last, at, left, right) in enumerate(zip(*(c.to_pylist() for c in batch.columns))):
                whole = left[::-1] + right
                out += [(i, p, hashlib.blake2b(whole[p - first:p - first + width], digest_size=16).digest()) for p in range(first, last + 1)]
            take = pa.array([o[0] for o in out], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array([o[1] for o in out], pa.int64()),
                                              pa.array([o[2] for o in out], pa.binary())], names=["id", "tag", "start", "string"])

    each = members.where(F.col("ways") > CROWD).drop("ways").mapInArrow(strings, f"id {kind}, tag long, start long, string binary")
    common = each.groupBy("string").count().where("count > 1").select("string").repartition("string")
    far = each.join(common, "string").select("id", "tag", "start", (F.col("start") + width).alias("end"))
    alone = runs.select("id", "tag", F.col("first").alias("start"), (F.col("last") + width).alias("end"))
    return copies.unionByName(near).unionByName(far).unionByName(alone)


def _pairs(name: np.ndarray, around: np.ndarray):
    order = np.lexsort((around, name))
    n, a = name[order], around[order]
    new = np.flatnonzero(np.append(True, (n[1:] != n[:-1]) | (a[1:] != a[:-1])))
    return np.stack([n[new], a[new]], axis=1), np.diff(np.append(new, len(n)))


def _span_batch(spans: list, kind) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([s[0] for s in spans], kind), *(pa.array([s[j] for s in spans], pa.int64()) for j in (1, 2, 3))],
                                      names=["id", "tag", "start", "end"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """One row per row of ``docs``: ``row``, ``kept`` (binary), ``n_bytes``, ``removed`` (the spans, merged).

    Texts are UTF-8 bytes (null: empty). Each byte covered by a string of ``width`` bytes that also starts anywhere
    else goes, judged on the input; strings do not cross rows. Rows that agree in id and text repeat each other like any
    other two. Shorter texts stay as they are.
    """
    base = keyed(docs, id_col, text_col)
    # rows that agree in id and text share their spans; the row that repeats another is told apart by nothing else
    spans = stored(repeated_spans(base, width), "spans")
    per = (spans.groupBy(F.col("id").alias("s_id"), F.col("tag").alias("s_tag"))
           .agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("spans")))
    marks = base.sparkSession.sparkContext.broadcast(_mark_table(spans.select("tag").distinct(), "tag"))

    @F.pandas_udf("boolean")
    def touched(tag: pd.Series) -> pd.Series:
        return pd.Series(_bit(marks.value, tag.to_numpy().astype(np.int64)))      # all, if there are too many for a table

    flagged = base.withColumn("touched", touched("tag"))
    with_spans = flagged.where("touched").drop("touched")
    joined_rows = with_spans.join(per, same(with_spans, per, ("id", "s_id"), ("tag", "s_tag")), "left").select("row", "text", "spans")
    others = flagged.where("not touched").select("row", F.col("text").cast("binary").alias("kept"), F.octet_length("text").cast("long").alias("n_bytes"),
                                                 F.array().cast("array<struct<start:bigint,end:bigint>>").alias("removed"))

    @F.pandas_udf("kept binary, n_bytes long, removed array<struct<start:long,end:long>>")
    def cut(text: pd.Series, spans: pd.Series) -> pd.DataFrame:
        out = []
        for t, given in zip(text, spans):
            t = t.encode()
            merged, kept, done = [], [], 0
            for s in given if given is not None else []:
                a, b = int(s["start"]), int(s["end"])
                if merged and a <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], b)
                else:
                    merged.append([a, b])
            for a, b in merged:
                kept.append(t[done:a])
                done = b
            kept.append(t[done:])
            out.append((b"".join(kept), len(t), [{"start": a, "end": b} for a, b in merged]))
        return pd.DataFrame(out, columns=["kept", "n_bytes", "removed"])

    return joined_rows.select("row", cut("text", "spans").alias("c")).select("row", "c.*").unionAll(others)


def query(spark, sf):
    out = remove_repeats(table(spark, sf, "documents"))
    lengths = F.transform("removed", lambda s: s["end"] - s["start"])
    return out.select("row.doc_id", "n_bytes", F.aggregate(lengths, F.lit(0).cast("long"), lambda a, x: a + x).alias("n_removed"),
                      F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


SQL = None
