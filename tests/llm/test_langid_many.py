"""Languages beyond any round number, held-out accuracy on the documents given, and odd rows."""

import random

import numpy as np

from pitchcast.llm import langid

SF = "/root/testdata/sf0.1"


def test_three_hundred_languages(spark):
    r = random.Random(1)
    rows, i = [], 0
    for k in range(300):
        letters = [chr(0x4E00 + 40 * k + j) for j in range(8)]
        for _ in range(12):
            rows.append((i, " ".join("".join(r.choices(letters, k=4)) for _ in range(6)), f"l{k:03d}"))
            i += 1
    rows += [(i, None, "l001"), (i + 1, "", "l002"), (i + 2, "123 !", "l003"), (None, rows[0][1], "l000"), (5, rows[5][1], "l000"), (5, rows[5][1], "l000"),
             (i + 3, rows[0][1] * 20000, None)]
    df = spark.createDataFrame([(*x, "s") for x in rows], "doc_id long, text string, lang string, score string")
    out = [r for r in langid.identify(df, langid.fit(df)).selectExpr("row.doc_id as id", "row.text as text", "row.lang as lang", "lang_pred", "score").collect()]
    assert len(out) == len(rows)
    told = [r for r in out if r["id"] is not None and r["id"] < i]
    assert np.mean([r["lang"] == r["lang_pred"] for r in told]) > 0.97 and len({r["lang_pred"] for r in told}) == 300
    odd = {r["id"]: r for r in out if r["id"] is not None and r["id"] >= i}
    assert [odd[i + k]["lang_pred"] for k in range(3)] == ["und"] * 3 and odd[i + 3]["lang_pred"] == "l000"
    assert all(0 <= r["score"] <= 1 for r in out)


def test_held_out_accuracy(spark):
    out = langid.query(spark, SF).where("held_out").join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").where("lang is not null and lang_pred <> 'und'")
    hits, n = out.selectExpr("sum(int(lang = lang_pred))", "count(*)").first()
    assert n > 3000 and hits / n > 0.99
