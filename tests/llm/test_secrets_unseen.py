"""Secrets of forms and false positives that no training finding has; what the forest adds to the rule that labels."""

import random

import numpy as np
from pyspark.sql import functions as F

from pitchcast.llm import secrets as S

HEX, LOWER = "0123456789abcdef", "abcdefghijklmnopqrstuvwxyz"
ALNUM = LOWER + LOWER.upper() + "0123456789"


def corpus():
    r = random.Random(12)
    draw = lambda chars, n: "".join(r.choices(chars, k=n))                                  # noqa: E731
    text = lambda n: " ".join(r.choices([f"{a}{b}" for a in ("re", "con", "pro", "sub") for b in ("port", "text", "vide", "mit", "late")], k=n))
    seen = {"hex40": (lambda: draw(HEX, 40), 'token = "{}"', True), "stripe": (lambda: "sk_live_" + draw(ALNUM, 24), "charge {} now", True),
            "password": (lambda: draw(ALNUM, 9) + "!", "password: {}", True), "commit": (lambda: draw(HEX, 40), "commit {}", False),
            "number": (lambda: draw("0123456789", 12), "order {} is", False), "file": (lambda: f"src/{draw(LOWER, 6)}1.py", "in {} we", False)}
    unseen = {"uuid key": (lambda: "-".join(draw(HEX, n) for n in (8, 4, 4, 4, 12)), "api_key: {}", True),
              "groups": (lambda: "-".join(draw("ABCDEFGHJKMNPQRSTVWXYZ23456789", 5) for _ in range(5)), 'secret = "{}"', True),
              "slack": (lambda: f"xoxb-{draw('0123456789', 11)}-{draw(ALNUM, 24)}", "token={} set", True),
              "random 24": (lambda: draw(ALNUM, 24), "auth_token: {}", True), "words and digits": (lambda: f"hunter{draw('0123456789', 1)}secret{draw('0123456789', 2)}", "password: {}", True),
              "short": (lambda: draw(LOWER, 2) + draw("0123456789", 1) + "!" + draw(LOWER, 1), "pwd: {}", True),
              "long": (lambda: draw(ALNUM + "+/. ", 300).strip(), 'passphrase = "{}"', True),
              "request": (lambda: "-".join(draw(HEX, n) for n in (8, 4, 4, 4, 12)), "revision {} of", False),
              "digest": (lambda: draw(HEX, 96), "checksum: {}", False), "time": (lambda: f"2024-0{draw('123456789', 1)}-1{draw('0123456789', 1)}T0{draw('0123456789', 1)}:15:00.{draw('0123456789', 6)}", "on {} the", False),
              "path": (lambda: f"lib/{draw(LOWER, 7)}/{draw(LOWER, 5)}2/{draw(LOWER, 6)}.so.1", "in {} by", False)}
    rows, truth = [], {}
    for k in range(900):
        name = r.choice([*seen] if k < 400 else [*unseen])
        make, place, secret = {**seen, **unseen}[name]
        value = make()
        rows.append((k, f"{text(20)} {place.replace('{}', value)} {text(9)}", "src"))
        truth[k] = (name, value, secret)
    return rows, truth


def test_unseen_forms(spark):
    rows, truth = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = {}
    for x in S.find_secrets(docs, docs.where("doc_id < 400").select("doc_id")).where("id >= 400").collect():
        out.setdefault(x["id"], {})[x["found"]] = x
    told = {k: out.get(k, {}).get(v) for k, (_, v, _) in truth.items() if k >= 400}
    hit = {k: bool(x and x["is_secret"]) for k, x in told.items()}
    yes = [k for k in told if truth[k][2]]
    recall, precision = np.mean([hit[k] for k in yes]), np.mean([truth[k][2] for k in told if hit[k]])
    by_form = {n: float(np.mean([hit[k] == truth[k][2] for k in told if truth[k][0] == n])) for n in {truth[k][0] for k in told}}
    assert recall >= 0.9 and precision >= 0.9, (recall, precision, by_form)
    assert [k for k in yes if told[k] is None] == []                       # of any length, each is offered whole
    differ = [k for k, x in told.items() if x and (x["evidence"] is True) != x["is_secret"]]
    assert differ                                                         # the forest is not the rule


def test_no_part_of_the_rule_is_a_feature():
    assert not {"issued", "plain", "named", "hash_before", "assigned", "cue_before", "cue_inside"} & set(S.NAMES)


def test_private_keys_are_offered_whole(spark):
    key = "-----BEGIN RSA PRIVATE KEY-----\n" + "\n".join("MIIEow" + "Ab1/+" * 11 for _ in range(6)) + "\n-----END RSA PRIVATE KEY-----"
    text = f"key = '{key}' and password: \"{'x1 ' * 200}\" then token: a1"
    assert [text[a:b] for a, b in S.spans(text)] == [key, "x1 " * 200, "a1"]


def test_odd_rows(spark):
    rows = [(None, "token = 'abc123def456'", None), (1, None, "a"), (2, "", "a"), (3, "word " * 200_000 + "password=Qw3rty!zz", "b/c.py"), (4, "api_key: 12ab34cd56ef", "a"),
            (4, "api_key: 12ab34cd56ef", "a")]
    docs = spark.createDataFrame([(*r, "x", 1.0) for r in rows], "doc_id long, text string, source string, words string, score double")
    found = S.find_secrets(docs, docs.select("doc_id").limit(0)).collect()
    assert sorted((r["id"] is None, r["id"], r["found"]) for r in found) == [
        (False, 3, "Qw3rty!zz"), (False, 4, "12ab34cd56ef"), (False, 4, "12ab34cd56ef"), (True, None, "abc123def456")]
    assert all(0 <= r["score"] <= 1 for r in found) and S.find_secrets(docs.limit(0), docs.limit(0)).count() == 0
