"""N-gram Jaccard join: a size-aware join of the documents' shingle sets, exact at any size.

Sets up to a boundary are light: each names its subsets of the least size at which two
sets of given sizes are similar, and similar light sets name one subset alike. Larger
sets are heavy: each enters the inverted lists of its rarest shingles, as many as make
sure that two similar sets meet in one. The boundary is where, over the sizes found in
the table, naming subsets would start to cost more than entering lists and being read there.

Neither subsets nor lists are expanded into pairs. All members of a list are sent, with
their sets, to the list's smallest member; members that meet there are compared as
blocks of bit signatures first (the number of bits that differ is never above the number
of shingles that do), then set by set, except where a chain of links already joins
them. A task returns at most one link per member.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, table
from .components import components
from .rolling import Hasher, batched, joined, mixed, word_ranges

SKETCH = 1 << 18       # counters of the shingle frequency sketch (fixed, whatever the size of the table)
MARKS = 1 << 24        # bits of the mark table of documents that met another (fixed)
LARGEST_LIGHT = 24     # sizes looked at for the boundary
BLOCK = 1000           # members compared with each other at a time
SIGNATURE = 32         # 64-bit words of the short signatures


def shingle_sets(texts: list, words: int):
    """Yields (index, sorted distinct 64-bit shingle hashes) for each text; those with fewer words have one shingle."""
    weights = np.random.default_rng(7).integers(0, 1 << 63, max(words, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    for chunk in batched((t.encode().lower() if t else b"" for t in texts), 2 << 20):   # bytes.lower changes A-Z only
        data, begin = joined([b for _, b in chunk])
        start, end = word_ranges(data)
        h = Hasher(data).ranges(start, end)
        first = np.searchsorted(start, begin)
        n = len(h) - words + 1
        run = sum((h[k:n + k] * weights[k] for k in range(words)), np.zeros(max(n, 0), np.uint64)) if n > 0 else np.empty(0, np.uint64)
        run = mixed(run)
        for k, (i, _) in enumerate(chunk):
            a, b = first[k], first[k + 1]
            if b - a >= words:
                yield i, np.unique(run[a:b - words + 1])
            elif b > a:
                short = (h[a:b] * weights[:b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
                yield i, mixed(np.array([short], np.uint64))
            else:
                yield i, np.empty(0, np.uint64)


def least_overlap(n: int, m: int, percent: int) -> int:
    """The least intersection of sets of n and m at which 100 * intersection >= percent * union."""
    return -(-percent * (n + m) // (100 + percent))


def partners(n: int, percent: int) -> list[int]:
    """Sizes of the sets that a set of n can be similar to."""
    return [m for m in range(max(1, n * percent // 100), n * 100 // percent + 2) if least_overlap(n, m, percent) <= min(n, m)]


def subset_cost(n: int, percent: int) -> int:
    return sum(math.comb(n, least_overlap(n, m, percent)) for m in partners(n, percent))


def prefix(n: int, percent: int) -> int:
    return n + percent * n // -100 + 1


def boundary(sizes: dict[int, int], percent: int) -> int:
    """The largest light size: up to it, naming subsets costs no more than list entries and the sets sent to the lists."""
    best = light = heavy = 0
    for n in range(1, LARGEST_LIGHT + 1):
        light += sizes.get(n, 0) * subset_cost(n, percent)
        heavy += sizes.get(n, 0) * (prefix(n, percent) + n)
        if light <= heavy:
            best = n
    return best


def tokens_of(s: np.ndarray, counts: np.ndarray, light: int, percent: int) -> np.ndarray:
    """What a set is listed under: its subsets (light), its rarest shingles (heavy), both near the boundary."""
    n, out = len(s), []
    if n <= light:
        for m in partners(n, percent):
            if m <= light:
                c = least_overlap(n, m, percent)
                pick = np.array(list(itertools.combinations(range(n), c)), np.int64).reshape(-1, c)
                salt = np.uint64((min(n, m) * 100003 + max(n, m)) * 2 + 1)
                out.append(mixed(s[pick].sum(axis=1, dtype=np.uint64) * salt))
    if n > light or any(m > light for m in partners(n, percent)):
        out.append(s[np.lexsort((s, counts[(s % np.uint64(SKETCH)).astype(np.int64)]))[:prefix(n, percent)]])
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def node_of(s: np.ndarray) -> tuple[int, bytes]:
    """A 64-bit name of a set, and 128 bits that tell it from others of that name."""
    import hashlib

    d = hashlib.blake2b(s.tobytes(), digest_size=24).digest()
    return int.from_bytes(d[:8], "little", signed=True), d[8:]


def signature(s: np.ndarray, words: int | None = None) -> bytes:
    """A bit for each of so many places, set where an odd number of shingles falls: one shingle more or less moves one
    bit. Without a number of 64-bit words, a power of two with two places for each shingle at least."""
    places = (words or max(SIGNATURE, 1 << (len(s) // 32).bit_length())) * 64
    times = np.bincount(((s >> np.uint64(32)) % np.uint64(places)).astype(np.int64), minlength=places)
    return np.packbits((times & 1).astype(np.uint8)).tobytes()


class Members:
    """Sizes and signatures of the members of a group; a signature is folded where it meets one of half its length."""

    def __init__(self, signatures: list[bytes], size: np.ndarray, percent: int):
        self.size, self.percent = size, percent
        self.length = np.fromiter((len(b) for b in signatures), np.int64, len(signatures))
        self.rows, self.bits = {}, {}
        for n in np.unique(self.length).tolist():
            who = np.flatnonzero((self.length == n) | (self.length == 2 * n))
            full = [np.frombuffer(signatures[k], np.uint8) for k in who]
            # place p of the longer one is place p modulo n of the shorter
            self.bits[n] = np.stack([b if len(b) == n else b[:n] ^ b[n:] for b in full]).view(np.uint64)
            self.rows[n] = np.full(len(signatures), -1)
            self.rows[n][who] = np.arange(len(who))

    def may_link(self, a: int, b0: int) -> np.ndarray:
        """Which members from ``b0`` on can be similar to member ``a``, by their sizes and the bits that differ."""
        both = self.size[b0:] + self.size[a]
        most = both - 2 * (-(-self.percent * both // (100 + self.percent)))   # shingles that similar sets may differ in
        near = np.flatnonzero(np.abs(self.size[b0:] - self.size[a]) <= most)
        shorter = np.minimum(self.length[near + b0], self.length[a])
        out = []
        for n in np.unique(shorter).tolist():
            some = near[shorter == n]
            bits, row = self.bits[n], self.rows[n]
            apart = np.bitwise_count(bits[row[some + b0]] ^ bits[row[a]]).sum(axis=1, dtype=np.int64)
            out.append(some[apart <= most[some]] + b0)
        return np.concatenate(out) if out else near + b0


def with_partner(signatures: list[bytes], size: np.ndarray, left: int, percent: int) -> np.ndarray:
    """Which members can be similar to another one (as in ``links_among``)."""
    out = np.zeros(len(size), bool)
    members = Members(signatures, size, percent)
    for a in range(left or len(size)):
        others = members.may_link(a, left or a + 1)
        if len(others):
            out[a] = True
            out[others] = True
    return out


def links_among(ids: np.ndarray, sets: list[np.ndarray], left: int, percent: int) -> list[tuple[int, int]]:
    """A forest of links that joins all that similarity joins among the members; the first ``left`` members and the
    others are two blocks (0: one block), of which only pairs across are compared."""
    size = np.array([len(s) for s in sets], np.int64)
    members = Members([signature(s) for s in sets], size, percent)
    parent = np.arange(len(sets))
    out = []
    for a in range(left or len(sets)):
        for b in members.may_link(a, left or a + 1).tolist():
            ra, rb = _root(parent, a), _root(parent, b)
            if ra != rb:
                common = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
                if 100 * common >= percent * (size[a] + size[b] - common):
                    parent[max(ra, rb)] = min(ra, rb)
                    out.append((int(ids[a]), int(ids[b])))
    return out


def _groups(batches, keys: int):
    """(key, rows) of each run of rows with equal first ``keys`` columns."""
    key, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[:keys] != key:
                if len(rows) > 1:
                    yield key, rows
                key, rows = row[:keys], []
            rows.append(row[keys:])
    if len(rows) > 1:
        yield key, rows


def _root(parent: np.ndarray, a: int) -> int:
    while parent[a] != a:
        parent[a] = parent[parent[a]]
        a = parent[a]
    return a


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       words: int = 4, percent: int = 85) -> DataFrame:
    r"""One row per row of ``docs``: id, n_shingles, class_id, component_id.

    Words are runs of characters other than ``[\x20\x09-\x0D]``, A-Z lower-cased; a set is
    the distinct shingles of ``words`` words, or the whole text's words as one. Two
    documents link when 100 * intersection >= percent * union. ``class_id`` is the smallest
    id with an equal set, ``component_id`` the smallest that links reach. A text without
    words, null or empty, links with nothing and stands for itself. Rows that repeat an id are one
    document that has the links of each. A row with a null id takes the class and component of
    rows with an equal set, and null where there are none.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def profile(batches):
        counts = np.zeros(SKETCH, np.int64)
        for batch in batches:
            at, n, node, sig, bits, more = [], [], [], [], [], []
            for i, s in shingle_sets(batch.column(1).to_pylist(), words):
                counts += np.bincount((s % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH) if len(s) > 1000 else 0
                if len(s) <= 1000:
                    counts[(s % np.uint64(SKETCH)).astype(np.int64)] += 1
                name, rest = node_of(s)
                at.append(i), n.append(len(s)), node.append(name), sig.append(rest), bits.append(signature(s, SIGNATURE)), more.append(signature(s))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(n, pa.int32()), pa.array(node, pa.int64()),
                                              pa.array(sig, pa.binary()), pa.array(bits, pa.binary()), pa.array(more, pa.binary()),
                                              pa.nulls(len(at), pa.list_(pa.int32()))], names=["id", "n", "node", "sig", "bits", "more", "counts"])
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.array([-1], pa.int32()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()),
                                          pa.array([counts.astype(np.int32)], pa.list_(pa.int32()))], names=["id", "n", "node", "sig", "bits", "more", "counts"])

    seen = stored(slim.mapInArrow(profile, "id long, n int, node long, sig binary, bits binary, more binary, counts array<int>"), "profile")
    members = seen.where("n >= 0")
    # both results are of fixed size: SKETCH numbers, and one per light size
    total = np.zeros(SKETCH, np.int64)
    sums = seen.where("n = -1").select(F.posexplode("counts").alias("k", "c")).groupBy("k").agg(F.sum("c").alias("c")).toArrow()
    total[sums["k"].to_numpy()] = sums["c"].to_numpy()
    sizes = {r["n"]: r["c"] for r in members.where(F.col("n").between(1, LARGEST_LIGHT)).groupBy("n").agg(F.count("*").alias("c")).collect()}
    light = boundary(sizes, percent)
    rank = spark.sparkContext.broadcast(total)

    def listed(batches):
        for batch in batches:
            token, node = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
            for _, s in shingle_sets(batch.column(0).to_pylist(), words):
                if len(s):
                    t = tokens_of(s, rank.value, light, percent)
                    token.append(t)
                    node.append(np.full(len(t), node_of(s)[0], np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(token).view(np.int64)), pa.array(np.concatenate(node))], names=["token", "node"])

    tokens = stored(slim.select("text").mapInArrow(listed, "token long, node long"), "tokens")
    hubs = (tokens.groupBy("token").agg(F.min("node").alias("hub"), F.max("node").alias("last"))
            .where("hub <> last").select("token", "hub"))
    met = stored(tokens.join(hubs, "token").select("hub", "node").distinct(), "met")

    classes = (members.where("n > 0").groupBy("node", "sig").agg(F.min("id").alias("class_id"), F.first("n").alias("n"), F.first("bits").alias("bits"), F.first("more").alias("more"))
               .where("class_id is not null"))

    # a hub's members are dealt to blocks; blocks meet in pairs, so that no task holds more than two
    room = met.groupBy("hub").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    dealt = met.join(room, "hub").withColumn("block", F.pmod(F.xxhash64("node", "hub"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("node", "hub", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), (F.col("block") > F.col("other")).alias("right"))

    # by their bits alone, most members turn out to have no partner; only the others' sets are sent
    def promising(batches):
        for key, rows in _groups(batches, 3):
            left = sum(not r[0] for r in rows) if key[1] != key[2] else 0
            if key[1] != key[2] and left in (0, len(rows)):
                continue
            go = with_partner([r[4] for r in rows], np.array([r[3] for r in rows], np.int64), left, percent)
            some = [r for r, k in zip(rows, go) if k]
            columns = [[v] * len(some) for v in key] + [[r[j] for r in some] for j in (0, 1, 2)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.int64()))],
                                             names=["hub", "x", "y", "right", "node", "class_id"])

    # first by short signatures, then, for those that pass, by signatures in proportion to the sets
    promised = dealt
    for bits in ("bits", "more"):
        brief = (promised.join(classes.select("node", "class_id", "n", bits), "node").select("hub", "x", "y", "right", "node", "class_id", "n", bits)
                 .repartition("hub", "x", "y").sortWithinPartitions("hub", "x", "y", "right", "class_id"))
        promised = stored(brief.mapInArrow(promising, "hub long, x int, y int, right boolean, node long, class_id long"), "promising")
        promised, kept = promised.drop("class_id").distinct(), promised
    promised = kept
    wanted = promised.select("node", "class_id").distinct()
    mark = F.pmod(F.xxhash64("class_id"), F.lit(MARKS))
    words_of_marks = (wanted.select(mark.alias("mark")).groupBy(F.expr("mark div 32").alias("w"))
                      .agg(F.bit_or(F.expr("shiftleft(1L, cast(mark % 32 as int))")).alias("b")).toArrow())   # at most MARKS / 32 rows
    marks = np.zeros(MARKS // 32, np.int64)
    marks[words_of_marks["w"].to_numpy()] = words_of_marks["b"].to_numpy()
    marked = spark.sparkContext.broadcast(marks)

    def gathered(batches):
        for batch in batches:
            mark = batch.column(2).to_numpy(zero_copy_only=False)
            rows = np.flatnonzero((marked.value[mark // 32] >> (mark % 32)) & 1)
            took = batch.take(pa.array(rows, pa.int64()))
            at, node, sets = [], [], []
            for i, s in shingle_sets(took.column(1).to_pylist(), words):
                if len(s):
                    at.append(i), node.append(node_of(s)[0]), sets.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([took.column(0).take(pa.array(at, pa.int64())), pa.array(node, pa.int64()), pa.array(sets, pa.binary())],
                                             names=["id", "node", "shingles"])

    sets = (slim.where("id is not null").withColumn("mark", F.pmod(F.xxhash64("id"), F.lit(MARKS)))
            .mapInArrow(gathered, "id long, node long, shingles binary"))
    # only the row that stands for its class: marks of other documents may coincide
    sets = sets.join(wanted.select("node", F.col("class_id").alias("id")), ["node", "id"], "left_semi")

    groups = promised.join(sets, ["node"]).where("class_id = id").select("hub", "x", "y", "right", "id", "shingles")
    groups = groups.repartition("hub", "x", "y").sortWithinPartitions("hub", "x", "y", "right", "id")

    def compared(batches):
        for key, rows in _groups(batches, 3):
            left = sum(not r[0] for r in rows) if key[1] != key[2] else 0
            if key[1] == key[2] or left not in (0, len(rows)):
                out = links_among(np.array([r[1] for r in rows], np.int64), [np.frombuffer(r[2], np.uint64) for r in rows], left, percent)
                yield pa.RecordBatch.from_arrays([pa.array([e[k] for e in out], pa.int64()) for k in (0, 1)], names=["a", "b"])

    # rows that repeat an id with other texts are one document
    again = (members.where("n > 0 and id is not null").select("id", "node", "sig").distinct()
             .join(classes, ["node", "sig"]).select(F.col("id").alias("a"), F.col("class_id").alias("b")))
    several = members.where("n > 0 and id is not null").groupBy("id").agg(F.count_distinct("node", "sig").alias("k")).where("k > 1").select(F.col("id").alias("a"))
    found = groups.mapInArrow(compared, "a long, b long").union(again.join(several, "a", "left_semi"))

    named = (classes.join(components(found).withColumnRenamed("node", "joined"), F.col("class_id") == F.col("joined"), "left")
             .select(F.col("node").alias("name"), F.col("sig").alias("name_sig"), "class_id",
                     F.coalesce("component", "class_id").alias("component_id")))
    named = named.repartition("class_id")   # joined by its own exchange, so that a class with a third of all rows can be split
    out = members.join(named, (F.col("node") == F.col("name")) & (F.col("sig") == F.col("name_sig")) & (F.col("n") > 0), "left")
    alone = F.col("n") == 0
    return out.select("id", F.col("n").cast("long").alias("n_shingles"), F.when(alone, F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
                      F.when(alone, F.col("id")).otherwise(F.col("component_id")).alias("component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with the smallest id of each component. Texts without words all stay; rows that repeat that id stay;
    rows with a null id stay unless a row with an id has the same shingles."""
    groups = jaccard_components(docs, id_col, text_col, words, percent)
    keep = (groups.where("n_shingles = 0 or id = component_id or (id is null and component_id is null)")
            .select(F.col("id").alias("_kept_id")).distinct())
    row = docs.select(F.struct("*").alias("row"))
    return (row.join(keep, F.col(f"row.`{id_col}`").cast("long").eqNullSafe(F.col("_kept_id")), "left_semi")
            .select("row.*"))


def query(spark, sf):
    out = jaccard_components(table(spark, sf, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "class_id")


SQL = None
