"""Secret scans: candidates found by a pattern, false positives removed by a random forest.

The forest looks at a candidate's length and make-up, how usual its character
transitions are in the corpus, how much of it dictionary words cover, the path it was
found under and the words next to it. Transitions and dictionary come from all documents;
the forest is trained in numpy on a bounded sample of labelled findings. Findings are labelled by another
view, issuers' formats and what a value is assigned to; neither these rules nor their parts are among the
features, and nothing passes the forest by. What a word or a kind of path tells is learned from the labels.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, table
from .rolling import Hasher, batched, joined, word_ranges

#: A run that may be a secret wherever it stands: 8 or more with a digit, or 20 or more; dots and . ! @ $ ~ within it belong to it.
RUN = re.compile(r"(?<![A-Za-z0-9+/_.!@$~-])(?:(?=[A-Za-z+/_.!@$~-]*[0-9])[A-Za-z0-9+/_.!@$~-]{8,}|[A-Za-z+/_.!@$~-]{20,})={0,2}")
#: What is assigned, of any characters: a quoted value whole, another up to a blank. It counts if NAMED meets what stands before.
ASSIGN = re.compile(r"=>|:=|[=:>]|(?<=[Bb]earer)(?=[ \t])")
VALUE = re.compile(r"""[ \t]{0,4}(["'`])?(?:(?:[Bb]earer|[Bb]asic)[ \t]+)?((?(1)(?:(?!\1)[^\n])+(?=\1)|(?:(?!&\w+=)[^\s"'`<])+))""")
CREDENTIALS = re.compile(r"://[^\s:/@]*:([^\s@/]+)@")
#: A private key is offered whole, from its first line to its last.
BLOCK = re.compile(r"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY)-----[^-]*-----END \1-----")
CUES = ("token", "key", "secret", "password", "passwd", "passphrase", "pwd", "auth", "credential", "bearer", "private", "api")
NAMED = re.compile(r"(?i)(?:%s)[\w.-]{0,24}[\"'`\]]{0,2}[ \t]{0,4}$" % "|".join(CUES))
ASSIGNED = re.compile(NAMED.pattern[:-1] + r"(?:=>|:=|[=:>])[ \t]{0,4}[\"'`]?(?:(?:[Bb]earer|[Bb]asic)[ \t]+)?$|[Bb]earer[ \t]+$|://[^\s:/@]{0,64}:$")
HASH = re.compile(r"(?i)(?:^|[^a-z])(?:commit|sha-?\d*|md5|hash|digest|checksum|revision|rev|blob|tree|parent|merge|etag|integrity|fingerprint|changeset|crc)s?[^\w]*$")
#: Families of formats that issuers give their secrets.
ISSUED = re.compile(r"(?:(?:AKIA|ASIA)[0-9A-Z]{16}|gh[opsur]_[A-Za-z0-9]{20,}|github_pat_\w{20,}|glpat-[\w-]{16,}|xox[abeoprs]-[\w-]{10,}|[rs]k_(?:live|test)_[A-Za-z0-9]{10,}"
                    r"|sk-[\w-]{20,}|AIza[\w-]{35}|SG\.[\w-]{10,}\.[\w-]{10,}|(?:npm|hf|pat|shpat|dop_v1|lin_api)_[A-Za-z0-9]{20,}|pypi-[\w-]{20,}|ya29\.[\w.-]{20,}"
                    r"|eyJ[\w-]{8,}\.[\w-]{8,}\.[\w-]*)")
#: Numbers, dates, addresses, versions, mail addresses, host and file names; and what stands in place of a secret.
PLAIN = re.compile(r"[\d.,/_+$-]+|v?\d+(?:\.\d+)+[\w.-]*|[\w.+-]+@[\w-]+(?:\.[\w-]+)+|(?:[a-z][a-z0-9_-]*[./])+[a-z]{1,12}\d?"
                   r"|.*(?i:x{4,}|\*{3,}|change.?me|example|your[_-]|placeholder|redacted|dummy|\$\{|%\().*")
BUCKETS = 1 << 17
DICTIONARY = 4096          # buckets of the most frequent words
SAMPLE = 4000              # labelled findings of each kind that the forest is fitted on, at most
MADE = ("length", "digits", "upper", "lower", "hexadecimal", "symbols", "distinct", "entropy", "transition", "worst_transition",
        "dictionary", "longest_word", "switches", "quoted", "path_depth", "words")
NAMES = (*MADE, "best_word", "worst_word", "sum_of_words", "path")      # what words and path tell, as learned
PRIOR = 4.0                # weight of the general share of secrets in what a word or a path tells


def _classes() -> np.ndarray:
    """a-z by letter, then digits, upper case, white space, other."""
    c = np.full(256, 29, np.int64)
    c[97:123] = np.arange(26)
    c[48:58], c[65:91], c[[9, 10, 11, 12, 13, 32]] = 26, 27, 28
    return c


KINDS = 30


def corpus_model(docs: DataFrame, text_col: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """(log share of each transition, dictionary flags of the word buckets), counted over all documents."""
    def count(batches):
        kinds, moves, words = _classes(), np.zeros(KINDS * KINDS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for chunk in batched(t.encode() if t else b"" for t in batch.column(0).to_pylist()):
                data, _ = joined([b for _, b in chunk])
                k = kinds[data]
                moves += np.bincount(k[:-1] * KINDS + k[1:], minlength=KINDS * KINDS)
                start, end = word_ranges(data)
                words += np.bincount((Hasher(data).ranges(start, end) % np.uint64(BUCKETS)).astype(np.int64), minlength=BUCKETS)
        yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([moves, words])], pa.list_(pa.int64()))], names=["c"])

    got = (docs.select(F.col(f"`{text_col}`").cast("string")).mapInArrow(count, "c array<long>").select(F.posexplode("c").alias("k", "c"))
           .groupBy("k").agg(F.sum("c").alias("c")).toArrow())             # KINDS^2 + BUCKETS numbers
    total = np.zeros(KINDS * KINDS + BUCKETS, np.int64)
    total[got["k"].to_numpy()] = got["c"].to_numpy()
    moves, words = total[:KINDS * KINDS].reshape(KINDS, KINDS), total[KINDS * KINDS:]
    known = np.zeros(BUCKETS, bool)
    known[np.argsort(-words, kind="stable")[:DICTIONARY]] = True
    return np.log((moves + 1) / (moves.sum(axis=1, keepdims=True) + KINDS)), known & (words > 0)


def spans(text: str):
    """(start, end) of the candidates of a text in order: values of names that tell of a secret, credentials in addresses,
    and what else of the runs lies outside those."""
    taken = [m.span() for m in BLOCK.finditer(text)] if "-----BEGIN " in text else []
    blocks, at, inside = list(taken), 0, 0
    while m := ASSIGN.search(text, at):
        a = m.start()
        at = max(m.end(), a + 1)
        while inside < len(blocks) and blocks[inside][1] <= a:
            inside += 1
        if inside < len(blocks) and blocks[inside][0] <= a:
            at = blocks[inside][1]
            continue
        if text.startswith("://", a):
            if value := CREDENTIALS.match(text, a):
                taken.append(value.span(1))
                at = value.end()
        elif (not m.group() or NAMED.search(text[max(0, a - 64):a])) and (value := VALUE.match(text, m.end())):
            a, b = value.span(2)
            if not value.group(1):
                b = a + len(value.group(2).rstrip(",;)]}>").removesuffix("."))
            if b > a:
                taken.append((a, b))
                at = value.end()
    taken = sorted(set(taken))
    taken = [x for k, x in enumerate(taken) if k == 0 or x[0] >= taken[k - 1][1]]
    out, k = list(taken), 0
    for m in RUN.finditer(text):
        a, end = m.span()
        while k < len(taken) and taken[k][1] <= a:
            k += 1
        rest, j = [], k
        while j < len(taken) and taken[j][0] < end:
            rest.append((a, taken[j][0]))
            a = taken[j][1]
            j += 1
        for a, b in [*rest, (a, end)]:
            piece = text[a:b].rstrip(".!@$~/")
            b = a + len(piece)
            a = b - len(piece.lstrip(".!@$~/"))
            if b - a >= 20 or b - a >= 8 and any(c.isdigit() for c in text[a:b]):
                out.append((a, b))
    return sorted(out)


def evidence(found: str, before: str) -> bool | None:
    """True for a secret, by an issuer's format or the name that it is assigned to; False for what is plain, or named
    as a hash; None if nothing tells, or both."""
    if ISSUED.fullmatch(found) or BLOCK.fullmatch(found):
        return True
    named = ASSIGNED.search(before)
    not_one = bool(PLAIN.fullmatch(found) or HASH.search(before) or before.endswith("://"))
    if named and len(set(found)) >= 5 and re.search(r"[^a-z_.]", found):
        return None if not_one else True
    return False if not_one and not named else None


def describe(found: str, before: str, after: str, path: str, model) -> tuple[list[float], list[str], str]:
    """(the features of MADE, the neighbouring words, the kind of path) of a candidate."""
    moves, known = model
    raw = np.frombuffer(found.encode(), np.uint8)
    kinds = _classes()[raw]
    steps = moves[kinds[:-1], kinds[1:]] if len(raw) > 1 else np.zeros(1)
    share = np.bincount(raw, minlength=256)
    share = share[share > 0] / len(raw)
    runs = [r.encode() for r in re.findall(r"[A-Za-z]{3,}", found.lower())]
    covered = longest = 0
    if runs:
        data, _ = joined(runs)
        start, end = word_ranges(data)
        sizes = (end - start)[known[(Hasher(data).ranges(start, end) % np.uint64(BUCKETS)).astype(np.int64)]]
        covered, longest = int(sizes.sum()), int(sizes.max(initial=0))
    words = re.findall(r"[^\W\d_]+|[=:(]$", before.lower().rstrip(" \t\"'`"))[-4:] + re.findall(r"[^\W\d_]+", after.lower())[:1]
    group = np.where(kinds < 26, 0, kinds)
    made = [len(raw), float((kinds == 26).mean()), float((kinds == 27).mean()), float((kinds < 26).mean()),
            float(np.isin(raw, list(b"0123456789abcdefABCDEF")).mean()), float((kinds == 29).mean()), len(share) / len(raw), float(-(share * np.log2(share)).sum()),
            float(steps.mean()), float(steps.min()), covered / len(raw), float(longest), float((np.diff(group) != 0).mean()) if len(raw) > 1 else 0.0,
            float(before[-1:] in ("'", '"', "`") and after[:1] in ("'", '"', "`")), float(path.count("/")), float(len(words))]
    return made, words, path.rpartition("/")[2].rpartition(".")[2].lower()


def candidates(docs: DataFrame, model, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """(id, start, end, found, made, words, kind, evidence): every candidate of every whole text, in code points. Null texts and paths are
    empty. A text is read by a pattern once, and candidates are few, so nothing is shuffled."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()
    path = F.col(f"`{path_col}`").cast("string") if path_col else F.lit("")

    def scan(batches):
        for batch in batches:
            row, start, end, found, made, words, kinds, told = [], [], [], [], [], [], [], []
            for i, (path, text) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                for a, b in spans(text or ""):
                    before = text[max(0, a - 60):a]
                    row.append(i), start.append(a), end.append(b), found.append(text[a:b])
                    m, w, k = describe(text[a:b], before, text[b:b + 20], path, held.value)
                    made.append(m), words.append(w), kinds.append(k)
                    told.append(evidence(text[a:b], before))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row, pa.int64())), pa.array(start, pa.int64()), pa.array(end, pa.int64()),
                                              pa.array(found, pa.string()), pa.array(made, pa.list_(pa.float64())), pa.array(words, pa.list_(pa.string())),
                                              pa.array(kinds, pa.string()), pa.array(told, pa.bool_())],
                                             names=["id", "start", "end", "found", "made", "words", "kind", "evidence"])

    return (docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(path, F.lit("")).alias("path"), F.col(f"`{text_col}`").cast("string").alias("text"))
            .mapInArrow(scan, f"id {kind}, start long, end long, found string, made array<double>, words array<string>, kind string, evidence boolean"))


def grow(x: np.ndarray, y: np.ndarray, rng, depth: int = 8, least: int = 2):
    """A tree: (feature, threshold, left, right), or the share of ones in a leaf."""
    if depth == 0 or len(y) < 2 * least or y.min() == y.max():
        return float(y.mean())
    best, cut = None, None
    for f in rng.choice(x.shape[1], max(1, int(np.sqrt(x.shape[1])) + 1), replace=False):
        for t in np.unique(np.quantile(x[:, f], np.linspace(0.05, 0.95, 15))):
            low = x[:, f] <= t
            n = int(low.sum())
            if least <= n <= len(y) - least:
                p, q = y[low].mean(), y[~low].mean()
                impurity = n * p * (1 - p) + (len(y) - n) * q * (1 - q)
                if best is None or impurity < best:
                    best, cut = impurity, (int(f), float(t), low)
    if cut is None:
        return float(y.mean())
    f, t, low = cut
    return f, t, grow(x[low], y[low], rng, depth - 1, least), grow(x[~low], y[~low], rng, depth - 1, least)


def train(x: np.ndarray, y: np.ndarray, trees: int = 40, seed: int = 5) -> list:
    """A random forest: each tree from a bootstrap sample, each cut from a random part of the features."""
    rng = np.random.default_rng(seed)
    return [grow(x[k], y[k], rng) for k in (rng.integers(0, len(y), len(y)) for _ in range(trees))]


def vote(forest: list, x: np.ndarray) -> np.ndarray:
    def walk(tree, rows, out):
        if isinstance(tree, float):
            out[rows] += tree
            return
        f, t, left, right = tree
        low = x[rows, f] <= t
        walk(left, rows[low], out)
        walk(right, rows[~low], out)

    out = np.zeros(len(x))
    for tree in forest:
        walk(tree, np.arange(len(x)), out)
    return out / max(len(forest), 1)


def tell(words: list, kinds: list, y: np.ndarray) -> tuple[dict, dict, float]:
    """What each word and each kind of path tells: (secrets, others) among labelled findings; and the general share of secrets."""
    by_word, by_kind = {}, {}
    for w, k, label in zip(words, kinds, y):
        for x in set(w):
            by_word.setdefault(x, [0, 0])[0 if label else 1] += 1
        by_kind.setdefault(k, [0, 0])[0 if label else 1] += 1
    return by_word, by_kind, float(y.mean()) if len(y) else 0.5


def features(made: list, words: list, kinds: list, told, y: np.ndarray | None = None) -> np.ndarray:
    """The features of NAMES. For findings that ``told`` was learned from (labels ``y``), their own label is left out of
    what their words and path tell."""
    by_word, by_kind, share = told

    def odds(counts, own):
        yes, no = counts if counts else (0, 0)
        if own is not None:
            yes, no = yes - own, no - (1 - own)
        return np.log((yes + PRIOR * share + 1e-3) / (no + PRIOR * (1 - share) + 1e-3))

    out = np.zeros((len(made), len(NAMES)))
    for i, (m, w, k) in enumerate(zip(made, words, kinds)):
        own = None if y is None else int(y[i])
        # a word or path that none but the finding itself has tells nothing
        telling = [odds(by_word.get(x), own if x in by_word else None) for x in set(w)] or [odds(None, None)]
        out[i] = [*m, max(telling), min(telling), sum(telling), odds(by_kind.get(k), own if k in by_kind else None)]
    return out


def examples(model, each: int = 40, seed: int = 9) -> tuple[list, list, list, np.ndarray]:
    """(made, words, kinds, labels) of made-up findings: secrets of many forms where secrets are written, hashes, names and numbers
    where those are. A corpus whose findings are all of one form does not tell the forest of the others."""
    rng = np.random.default_rng(seed)
    draw = lambda chars, n: "".join(rng.choice(list(chars), n))                                             # noqa: E731
    hexa, letters, digits = "0123456789abcdef", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    word = lambda: draw(letters[:26], int(rng.integers(4, 9)))                                             # noqa: E731
    values = [lambda n=n: draw(hexa, n) for n in (18, 32, 40, 64)] + [
        lambda: draw(letters + digits + "+/", 42) + "==", lambda: draw(letters + digits, int(rng.integers(16, 33))),
        lambda: draw(letters[:26] + digits, 24), lambda: draw(letters + digits + "!@$%#.-_", int(rng.integers(8, 17))),
        lambda: word().title() + draw(digits, 3) + draw("!@$.", 1), lambda: draw(letters + digits + "!@#$%&*", int(rng.integers(4, 9))),
        lambda: word() + draw(digits, int(rng.integers(1, 4))) + word() + draw(digits, int(rng.integers(0, 3))),
        lambda: draw(letters + digits + "+/. ", int(rng.integers(60, 500))).strip()]
    places = ["{} pwd: ", '{} passphrase = "', "{} client_secret=", '{} token = "', "{} password=", "{} api_key: ", '{} "secret": "', "{} Authorization: Bearer ", "{} DB_PASSWORD='", "{} auth_token="]
    plain = [(lambda n=n: draw(hexa, n), c) for n in (32, 40, 64) for c in ("{} commit ", "{} sha256: ", "{} {} {} ", '{} checksum = "', "{} revision ", "{} (")] + [
        (lambda: draw(digits, int(rng.integers(8, 17))), "{} {} "), (lambda: f"20{draw(digits, 2)}-0{draw(digits, 1)}-1{draw(digits, 1)}", "{} on "),
        (lambda: f"{word()}/{word()}{draw(digits, 1)}.{word()[:3]}", "{} in "), (lambda: f"{word()}{draw(digits, 2)}@{word()}.com", "{} by "),
        (lambda: f"{word()}_{word()}_{draw(digits, 2)}", "{} = "), (lambda: f"{word()}.{word()}", "{} password = "), (lambda: word() + word(), "{} token: "),
        (word, "{} pwd: "), (word, "{} passphrase = "), (lambda: draw(digits, int(rng.integers(1, 4))), "{} key: "),
        (lambda: word() + word() + word() + word(), "{} the ")]
    made, words, kinds, y = [], [], [], []
    for kind, pairs in ((1.0, [(v, c) for v in values for c in places]), (0.0, plain)):
        for v, c in pairs:
            for _ in range(each if not kind else max(1, each * len(plain) // (len(values) * len(places)))):
                before = c.format(word(), word(), word())
                m, w, k = describe(v(), before, before[-1] + " " if before[-1] in "'\"" else " " + word(), "", model)
                made.append(m), words.append(w), kinds.append(k), y.append(kind)
    return made, words, kinds, np.array(y)


def fit(findings: DataFrame, labelled: DataFrame, known: tuple | None = None):
    """(forest, what words and paths tell) from findings (id, start, made, words, kind) and their labels (id, start, is_secret): the
    first SAMPLE of each kind in the order of a hash of their place; and from ``known`` (as ``examples`` gives it) if given. None
    without labels of both kinds. Findings that agree in id and start are labelled alike."""
    rows = findings.select("id", "start", "made", "words", "kind").join(labelled.where("is_secret is not null").dropDuplicates(["id", "start"]), ["id", "start"])
    first = lambda kind: rows.where(F.col("is_secret") == kind).orderBy(F.xxhash64("id", "start")).limit(SAMPLE)
    got = first(True).unionAll(first(False)).select("made", "words", "kind", F.col("is_secret").cast("int").alias("y")).toArrow()
    made, words, kinds, y = (got[c].to_pylist() for c in ("made", "words", "kind", "y"))
    y = np.array(y, float)
    if known is not None:
        made, words, kinds, y = made + known[0], words + known[1], kinds + known[2], np.concatenate([y, known[3]])
    if not len(y) or y.min() == y.max():
        return None
    told = tell(words, kinds, y)
    return train(features(made, words, kinds, told, y), y), told


def judge(findings: DataFrame, model) -> DataFrame:
    """``findings`` with ``score``, the share of votes for a secret, and ``is_secret``. Without a model every candidate
    stays, with score 1."""
    if model is None:
        return findings.withColumn("score", F.lit(1.0)).withColumn("is_secret", F.lit(True))
    held = findings.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(made: pd.Series, words: pd.Series, kind: pd.Series) -> pd.Series:
        forest, told = held.value
        return pd.Series(vote(forest, features(made.tolist(), words.tolist(), kind.tolist(), told)) if len(made) else np.zeros(0))

    return findings.withColumn("score", score("made", "words", "kind")).withColumn("is_secret", F.col("score") >= 0.5)


def find_secrets(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """Judged findings of all documents, with ``held_out``. Those in documents of ``labels`` of which format or context
    tells what they are train the forest, beside the made-up ones; those of which nothing tells have no label. A fifth of
    all documents (by crc32 of the id) is held out."""
    model = corpus_model(docs, text_col)
    found = stored(candidates(docs, model, id_col, text_col, path_col), "candidates")
    held_out = F.pmod(F.crc32(F.col("id").cast("string")), F.lit(5)) == 2
    known = (found.join(labels.select(F.col(f"`{id_col}`").alias("id")).distinct(), "id", "left_semi").where(~held_out)
             .where("evidence is not null").select("id", "start", F.col("evidence").alias("is_secret")))
    return judge(found, fit(found, known, examples(model))).withColumn("held_out", held_out)


def query(spark, sf):
    out = find_secrets(table(spark, sf, "documents"), table(spark, sf, "labels"))
    return out.select(F.col("id").alias("doc_id"), "start", "end", F.sha2("found", 256).alias("found_sha256"), "held_out", "score", "is_secret")


SQL = None
