"""The training-data operators on small tables: hand-made cases and brute force."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitchcast.llm import (decontaminate, fingerprints, jaccard_join, langid, line_dedup, packing, secrets,
                           suffix_dedup, toxicity, warc)
from pitchcast.llm.components import components

SCHEMA = "doc_id long, text string, row int, id string, tag string, score double"   # names the operators use inside


def docs(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x", "y", 0.5) for i, t in rows], SCHEMA)


def text(seed, words, vocabulary=400):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}é" if r.random() < .1 else f"w{r.randrange(vocabulary)}" for _ in range(words))


LONG = "The same long line of more than forty code points, É"
ODD = [(None, text(1, 60)), (1, None), (2, ""), (3, text(2, 9000)), (4, text(1, 60)), (4, text(1, 60)), (4, text(3, 50))]


def test_line_dedup(spark):
    rows = [(k, f"start {k}\n \t{LONG if k % 2 else LONG.upper().replace('É', 'É')}\x0b\n{LONG}\nend") for k in range(5)]
    out = {r["id"]: r for r in line_dedup.dedup_lines(docs(spark, rows + [(9, "a\n\nb\n"), (10, None)])).selectExpr("row.doc_id as id", "kept", "n_lines", "n_dropped").collect()}
    assert [out[k]["n_dropped"] for k in range(5)] == [2, 2, 2, 2, 0]
    assert out[0]["kept"] == "start 0\nend" and out[4]["kept"] == rows[4][1]
    assert (out[9]["kept"], out[9]["n_lines"]) == ("a\n\nb\n", 4) and (out[10]["kept"], out[10]["n_lines"]) == ("", 1)
    four = line_dedup.drop_repeated_lines(docs(spark, rows[:4]))
    assert four.columns == SCHEMA.replace(" long", "").replace(" string", "").replace(" int", "").replace(" double", "").split(", ")
    assert {r["text"] for r in four.collect()} == {t for _, t in rows[:4]}
    assert line_dedup.dedup_lines(docs(spark, [])).count() == 0
    assert line_dedup.dedup_lines(docs(spark, ODD)).count() == len(ODD)


def test_fingerprints(spark):
    rows = [(k, f"{text(k, 50)}\n{text(k + 100, 50)}") for k in range(20)]
    out = {r["id"]: r for r in fingerprints.fingerprint_edits(docs(spark, rows)).collect()}
    for k, t in rows:
        after = rows[(k - 1) % 20][1]
        half = len(t) // 2
        assert out[k]["edited"] == t[:len(t) - half] + after[:half]
    assert 0.3 < np.mean([r["near_edited"] for r in out.values()]) < 0.7 and np.mean([r["near_next"] for r in out.values()]) < 0.15
    assert fingerprints.fingerprint_edits(docs(spark, ODD)).count() == len(ODD)
    assert fingerprints.fingerprint_edits(docs(spark, [])).count() == 0
    one = fingerprints.fingerprint_edits(docs(spark, [(1, "a b c")])).first()
    assert one["near_next"] == 1.0


def test_fingerprints_are_homomorphic(spark):
    a, b = text(1, 30), text(2, 30)
    df = spark.createDataFrame([(a, b, f"{b}\n{a}", f"{a}\n{b}")], "a string, b string, ba string, ab string")
    for c in ("a", "b", "ba", "ab"):
        df = fingerprints.with_fingerprint(df, c, f"{c}_fp")
    r = df.select((F.col("ab_fp") == F.col("ba_fp")).alias("order"),
                  (fingerprints.add(F.col("a_fp"), F.col("b_fp"))["v"] == F.col("ab_fp.v")).alias("insert"),
                  (fingerprints.subtract(F.col("ab_fp"), F.col("b_fp"))["v"] == F.col("a_fp.v")).alias("delete")).first()
    assert all(r)


def test_decontaminate(spark):
    item = text(5, 14)
    words = item.upper().replace("É", "é").split()
    bench = spark.createDataFrame([(7, item), (8, "Tiny Item!"), (9, None), (10, "..."), (None, text(6, 12))], "item_id long, text string")
    rows = [(1, f"{text(8, 20)} {', '.join(words)} tail"), (2, "so tiny, item"), (3, " ".join(words[:9])), (4, None), (5, text(6, 12))]
    out = {r["d"]: r for r in decontaminate.find_leaks(docs(spark, rows), bench).select("row.doc_id", "*").withColumnRenamed("doc_id", "d").collect()}
    assert (len(out[1]["hit_words"]), out[1]["items"]) == (14, ["7"])
    assert (len(out[2]["hit_words"]), out[2]["items"], out[2]["n_words"]) == (2, ["8"], 3)
    assert not out[3]["hits"] and not out[4]["hits"] and out[4]["n_words"] == 0
    assert len(out[5]["hit_words"]) == 12 and out[5]["items"] == []
    assert {r["doc_id"] for r in decontaminate.drop_leaked(docs(spark, rows), bench).collect()} == {3, 4}
    assert decontaminate.drop_leaked(docs(spark, ODD), bench.limit(0)).count() == len(ODD)
    assert decontaminate.find_leaks(docs(spark, []), bench).count() == 0


def test_warc_round_trip(spark, tmp_path):
    big = "<p>\r\n\r\nWARC/1.1\r\nWARC-Boundary: x\r\n</p>" + "é" * 100
    rows = [(3, "u3", big), (1, "u1", big), (2, None, "small"), (5, "u\r\n5", "small"), (6, "u6", None), (None, "n", big)]
    path = str(tmp_path / "a")
    boundary = warc.write_archive(spark.createDataFrame(rows, "page_id long, url string, html string"), path)
    out = {r["page_id"]: r for r in warc.read_records(spark, path, boundary).collect()}
    assert {k: (r["record_type"], r["refers_to"]) for k, r in out.items()} == {
        "3": ("revisit", "1"), "1": ("response", None), "2": ("response", None), "5": ("response", None), "6": ("response", None), None: ("revisit", "1")}
    for i, _, t in rows:
        assert bytes(out[None if i is None else str(i)]["payload"]) == (t or "").encode()
    assert warc.read_payloads(spark, path, boundary).count() == 3
    empty = str(tmp_path / "b")
    assert warc.read_records(spark, empty, warc.write_archive(spark.createDataFrame([], "page_id long, url string, html string"), empty)).count() == 0


@pytest.mark.parametrize("crowd", [20_000, 2])
def test_suffix_dedup_brute_force(spark, monkeypatch, crowd):
    monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
    common = text(11, 120)
    rows = [(k, f"{text(k, 40)} {common[k:400 + 17 * k]} {text(k + 50, 40)}") for k in range(12)] + [(20, "ab" * 300), (21, common), (22, common), *ODD]
    raw = [(t or "").encode() for _, t in rows]
    seen = {}
    for t in raw:
        for p in range(len(t) - 199):
            seen[t[p:p + 200]] = seen.get(t[p:p + 200], 0) + 1
    expected = []
    for (i, _), t in zip(rows, raw):
        gone = np.zeros(len(t) + 1, int)
        for p in range(len(t) - 199):
            if seen[t[p:p + 200]] > 1:
                gone[p] += 1 if p == 0 else 1
                gone[min(p + 200, len(t))] -= 1
        gone = np.cumsum(gone)[:-1] > 0
        expected.append((str(i), len(t), bytes(np.frombuffer(t, np.uint8)[~gone]), int((np.diff(gone.astype(int), prepend=0) == 1).sum())))
    got = [(str(r["doc_id"]), r["n_bytes"], bytes(r["kept"]), len(r["removed"])) for r in suffix_dedup.remove_repeats(docs(spark, rows)).select("row.doc_id", "*").collect()]
    assert sorted(got) == sorted(expected)


def test_suffix_dedup_empty(spark):
    assert suffix_dedup.remove_repeats(docs(spark, [])).count() == 0


def test_packing(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    full = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    full.encode_special_tokens = True
    rows = [(1, text(1, 3000)), (2, None), (3, ""), (4, "<|endoftext|> x" + " " * 50 + "中文"), (5, "a" * 5000)]
    by = {}
    for r in sorted(packing.pack(docs(spark, rows)).collect(), key=lambda r: (r["doc_id"], r["start"])):
        assert r["length"] == len(r["ids"]) <= 2048 and r["length"] & (r["length"] - 1) == 0 and r["offset"] == 0
        by.setdefault(r["doc_id"], []).extend(r["ids"])
        assert r["start"] + r["length"] == len(by[r["doc_id"]])
    assert by == {i: full.encode(t or "", add_special_tokens=False).ids + [1] for i, t in rows}
    ids = [r[0] for r in packing.pack(docs(spark, ODD), with_ids=False).select("sequence_id").collect()]
    assert len(ids) == len(set(ids))
    assert packing.pack(docs(spark, [])).count() == 0


def test_language_id(spark):
    rows = [(k, " ".join(random.Random(k).choices(("der", "und", "nicht") if k % 2 else ("the", "of", "with"), k=30)), "de" if k % 2 else "en") for k in range(120)]
    df = spark.createDataFrame(rows + [(500, None, "en"), (501, "12 34", None), (None, "the of", None)], "doc_id long, text string, lang string")
    out = [(r["row"]["doc_id"], r["row"]["lang"], r["lang_pred"], r["score"]) for r in langid.identify(df, langid.fit(df)).collect()]
    assert all(p == l and s > 0.5 for i, l, p, s in out if i is not None and i < 500)
    assert {(i, p) for i, _, p, _ in out if i in (500, 501)} == {(500, "und"), (501, "und")}
    assert langid.fit(df.limit(0)) is None and langid.identify(df, None).where("lang_pred <> 'und'").count() == 0


def test_toxicity(spark):
    rows = [(k, text(k, 60) + (" Blockhead!" if k % 6 == 0 else "")) for k in range(3000)] + [(9000, None), (9001, ""), (None, "x")]
    labels = spark.createDataFrame([(k, int(k % 6 == 0)) for k in range(1500)] + [(1, None), (0, 1), (None, 1)], "doc_id long, toxic int")
    df = docs(spark, rows)
    scored = {r["doc_id"]: r["s"] for r in toxicity.toxic_score(df, toxicity.fit(df, labels), name="s").collect()}
    hits = [scored[k] >= 0.3 for k in range(1500, 3000)]
    assert np.mean([h == (k % 6 == 0) for h, k in zip(hits, range(1500, 3000))]) > 0.95
    assert 0 <= scored[9000] < 0.3 and scored[9000] == scored[9001]
    kept = toxicity.drop_toxic(df, labels)
    assert kept.columns == df.columns and kept.count() < len(rows) - 400
    assert toxicity.drop_toxic(df, labels.limit(0)).count() == len(rows)
    assert toxicity.drop_toxic(docs(spark, []), labels).count() == 0


@pytest.mark.parametrize("block", [1000, 3])
def test_jaccard_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    r = random.Random(3)
    rows = []
    for k in range(60):
        base = text(k // 6, r.choice((3, 8, 12, 20, 60)) if k % 6 == 0 else 40, 5000).split()
        for _ in range(r.randrange(3)):
            base[r.randrange(len(base))] = "changed"
        rows.append((k, " ".join(base)))
    rows += [(70, "A b C"), (71, "a B c"), (72, "a b c d e"), (73, None), (74, " \n"), (75, text(2, 9000)), (76, text(2, 9000) + " more words here")]
    sets = {}
    for i, t in rows:
        w = (t or "").lower().split()
        sets[i] = {tuple(w[k:k + 4]) for k in range(len(w) - 3)} or ({tuple(w)} if w else set())
    label = {i: i for i, _ in rows}
    for _ in rows:
        for a in sets:
            for b in sets:
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
    out = {x["id"]: x for x in jaccard_join.jaccard_components(docs(spark, rows)).collect()}
    assert {i: (out[i]["n_shingles"], out[i]["component_id"]) for i in out} == {i: (len(sets[i]), label[i]) for i in sets}


def test_jaccard_odd_rows(spark):
    out = jaccard_join.jaccard_components(docs(spark, ODD)).collect()
    assert len(out) == len(ODD) and {x["component_id"] for x in out if x["id"] is None} == {4}
    kept = jaccard_join.one_of_each(docs(spark, ODD))
    assert kept.columns == docs(spark, []).columns and {x["doc_id"] for x in kept.collect()} == {1, 2, 3, 4}
    assert jaccard_join.one_of_each(docs(spark, [])).count() == 0


def test_subsets_and_prefixes_meet():
    """Any two similar sets are listed under one token, whatever the boundary."""
    rng = np.random.default_rng(1)
    for light in (0, 6, 12):
        for _ in range(300):
            n = int(rng.integers(1, 30))
            a = np.unique(rng.integers(0, 1 << 62, n, dtype=np.uint64))
            b = np.unique(np.append(a[rng.random(len(a)) > 0.08], rng.integers(0, 1 << 62, int(rng.integers(0, 3)), dtype=np.uint64)))
            common = len(np.intersect1d(a, b))
            if len(b) and 100 * common >= 85 * (len(a) + len(b) - common):
                counts = np.zeros(jaccard_join.SKETCH, np.int64)
                assert np.intersect1d(jaccard_join.tokens_of(a, counts, light, 85), jaccard_join.tokens_of(b, counts, light, 85)).size


def test_components(spark):
    edges = [(k, k + 1) for k in range(1, 40)] + [(100, 90), (90, 95), (7, 7)]
    out = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert out == {**{k: 1 for k in range(1, 41)}, 90: 90, 95: 90, 100: 90}


def test_secrets(spark):
    rows = []
    for k in range(200):
        h = hashlib.sha1(str(k).encode()).hexdigest()
        rows.append((k, f'{text(k, 20)} token = "{h}" {text(k + 500, 10)}' if k % 2 else f"{text(k, 20)} {int(h[:14], 16):016d} {text(k, 5)}"))
    df = docs(spark, rows + [(900, None), (901, "")]).withColumn("source", F.lit("src"))
    found = secrets.candidates(df, secrets.corpus_model(df))
    labels = found.where("id < 120").selectExpr("id", "start", "length(found) = 40 as is_secret")
    out = secrets.judge(found, secrets.fit(found, labels)).where("id >= 120").collect()
    assert len(out) == 80 and np.mean([r["is_secret"] == (len(r["found"]) == 40) for r in out]) > 0.95
    assert secrets.judge(found, secrets.fit(found, labels.limit(0))).where("not is_secret").count() == 0
    assert secrets.candidates(df.limit(0), secrets.corpus_model(df.limit(0))).count() == 0


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    rows = [(k, text(k, 60) + (" Blockhead!" if k % 6 == 0 else "")) for k in range(3000)] + [(4000, text(1, 60)), (4001, None), (None, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(k, int(k % 6 == 0)) for k in range(1500)], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, text(7, 12))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    left = {r[0] for r in corpus_pipeline.run(spark, str(tmp_path)).select("doc_id").distinct().collect()}
    assert 4000 not in left and 7 not in left and {4001, None} <= left
    assert len([k for k in range(0, 3000, 6) if k in left]) <= 25 and len([k for k in range(3000) if k % 6 and k in left]) >= 2375


@pytest.mark.parametrize("name", ["op1_line_dedup", "op2_fingerprints", "op3_decontaminate"])
def test_native_queries_have_no_python_or_nested_loops(spark, name):
    from pitchcast.llm import queries as Q

    text = Q.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not [f for f in ("ArrowEvalPython", "BatchEvalPython", "MapInArrow", "MapInPandas", "NestedLoopJoin",
                            "CartesianProduct") if f in text]


def test_secrets_of_other_forms(spark):
    r = random.Random(4)
    draw = lambda chars, n: "".join(r.choices(chars, k=n))
    alnum = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    made = {
        "ghp": (lambda: "ghp_" + draw(alnum, 36), "pushed with {} today"),
        "stripe": (lambda: "sk_live_" + draw(alnum, 24), "charge {} now"),
        "jwt": (lambda: f"eyJhbGciOiJIUzI1NiJ9.eyJ{draw(alnum, 30)}.{draw(alnum, 43)}", "Authorization: Bearer {}"),
        "md5": (lambda: draw("0123456789abcdef", 32), 'api_key = "{}"'),
        "hex64": (lambda: draw("0123456789abcdef", 64), "SECRET_KEY={}"),
        "base64": (lambda: draw(alnum + "+/", 42) + "==", 'private_key: "{}"'),
        "short": (lambda: "Hun" + draw("0123456789", 4) + "!", "password: {}"),
        "symbols": (lambda: "p@" + draw(alnum, 5) + ".x$" + draw(alnum, 3), "password='{}'"),
        "letters": (lambda: draw("bcdfghjklmnpqrstvwxzBCDFGHJKLMN", 16), 'token = "{}"'),
    }
    hashes = {"commit": "commit {}", "bare": "merged as {} yesterday", "sum": "sha256: {}"}
    rows, expected = [], {}
    for k in range(600):
        kind = r.choice([*made, *hashes])
        value = made[kind][0]() if kind in made else draw("0123456789abcdef", 40)
        rows.append((k, f"{text(k, 20)} {made[kind][1] if kind in made else hashes[kind]} ".replace("{}", value) + text(k + 900, 10)))
        expected[k] = (kind, value)
    df = docs(spark, rows).withColumn("source", F.lit("src"))
    out = {}
    for x in secrets.find_secrets(df, df.where("doc_id < 300").select("doc_id")).collect():
        out.setdefault(x["id"], {})[x["found"]] = x["is_secret"]
    for kind in [*made, *hashes]:
        got = [out.get(k, {}).get(v) for k, (n, v) in expected.items() if n == kind]
        assert None not in got, kind
        assert np.mean([g == (kind in made) for g in got]) > 0.9, (kind, np.mean(got))
