"""Toxicity where every document has a label, with repeated ids, very long texts and ties."""

import random

from pitchcast.llm import toxicity


def table(spark, n, labelled):
    r = random.Random(6)
    words = [f"w{k}" for k in range(300)]
    rows = [(k, " ".join(r.choices(words, k=40)) + (" vile insult" if k % 5 == 0 else "")) for k in range(n)]
    rows += [(n, "vile insult " * 30000), (n + 1, None), (n + 2, ""), (3, rows[3][1]), (3, rows[3][1]), (3, "another text"), (None, "no id")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(k, int(k % 5 == 0)) for k in range(n) if labelled or k % 2] + [(5, 0), (None, 1), (7, None)], "doc_id long, toxic int")
    return docs, labels, len(rows)


def test_fully_labelled_and_half_labelled_tables_give_a_model(spark):
    for labelled in (True, False):
        docs, labels, n = table(spark, 600, labelled)
        model = toxicity.fit(docs, labels)
        assert model is not None
        out = toxicity.toxic_score(docs, model, name="p").select("doc_id", "text", "p").collect()
        assert len(out) == n and all(0 <= r["p"] <= 1 for r in out)
        toxic = [r["p"] for r in out if r["text"] and "vile" in r["text"]]
        clean = [r["p"] for r in out if r["text"] and "vile" not in r["text"]]
        assert sum(p >= toxicity.THRESHOLD for p in toxic) > 0.9 * len(toxic) and sum(p >= toxicity.THRESHOLD for p in clean) < 0.05 * len(clean)
        kept = toxicity.drop_toxic(docs, labels)
        assert kept.columns == docs.columns and kept.where("text is null or text = ''").count() == 2
