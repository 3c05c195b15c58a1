"""Toxicity by compression distance: held-out accuracy, and odd rows."""

from __future__ import annotations

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from lakeload.llm import toxicity as T

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
MARKS = ["blighter", "scoundrel", "wretch", "knave", "varlet", "dunderhead", "nincompoop", "poltroon"]


def corpus(n=1500, seed=4):
    rnd = random.Random(seed)
    parts = ["tion", "the", "re", "an", "ver", "lo", "mi", "ka", "sen", "dor", "el", "un", "sta", "qui"]
    docs, toxic = [], {}
    for i in range(n):
        words = ["".join(rnd.choice(parts) for _ in range(rnd.randint(1, 4))) for _ in range(rnd.randint(20, 300))]
        toxic[i] = int(i % 4 == 0)
        if toxic[i]:
            for _ in range(max(2, len(words) // 25)):
                words[rnd.randrange(len(words))] = rnd.choice(MARKS)
        docs.append((i, " ".join(words), "en", "s", 1))
    return docs, toxic


def test_held_out_documents_are_told_apart_and_odd_rows_have_scores(spark):
    docs, toxic = corpus()
    odd = [(None, "varlet knave", None, None, None), (9000, None, "en", "s", 0), (9001, "", "en", "s", 0), (9002, "one two " * 200_000, "en", "s", 0),
           docs[8], docs[8]]
    frame = spark.createDataFrame(docs + odd, DOCS).withColumns({"toxic": F.lit(0), "features": F.lit("x"), "fold": F.lit(9)})
    labels = spark.createDataFrame([*toxic.items(), (None, 1), (3, 7), (5, None)], "doc_id long, toxic int").withColumn("text", F.lit("no"))
    rows = T.score(frame, labels).collect()
    assert len(rows) == len(docs) + len(odd)
    for r in rows:
        held = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
        assert r["held_out"] == held and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
    by = {r["doc_id"]: r for r in rows}
    assert by[9000]["score"] == by[9001]["score"]
    assert len({r["score"] for r in rows if r["doc_id"] == 8}) == 1
    held = [r for r in rows if r["held_out"] and r["doc_id"] in toxic]
    hit = np.mean([r["predicted"] for r in held if toxic[r["doc_id"]]])
    clean = np.mean([1 - r["predicted"] for r in held if not toxic[r["doc_id"]]])
    assert hit >= 0.9 and clean >= 0.9, (hit, clean)


def test_scores_follow_the_text_alone(spark):
    docs, toxic = corpus(400)
    labels = spark.createDataFrame(list(toxic.items()), "doc_id long, toxic int")
    a = T.fit(spark.createDataFrame(docs, DOCS), labels)
    # labels of held-out documents change nothing
    other = {i: 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t for i, t in toxic.items()}
    b = T.fit(spark.createDataFrame(docs, DOCS).withColumns({"lang": F.lit("xx"), "source": F.lit("yy")}),
              spark.createDataFrame(list(other.items()), "doc_id long, toxic int"))
    assert a[0] == b[0] and np.allclose(a[1], b[1])


def test_without_both_classes(spark):
    docs, _ = corpus(20)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r["score"] for r in T.score(spark.createDataFrame(docs, DOCS), none).collect()} == {0.0}
    assert T.score(spark.createDataFrame([], DOCS), none).count() == 0
    one = spark.createDataFrame([(i, 1) for i in range(20)], "doc_id long, toxic int")
    assert {r["predicted"] for r in T.score(spark.createDataFrame(docs, DOCS), one).collect()} == {1}


def test_windows_cover_the_whole_text_at_every_length():
    for text in ["", " ", "A b\tC", "word " * 100, "é漢 " * 300_000]:
        found = list(T.windows(text))
        assert b" ".join(w.strip() for w in found).decode() == " ".join(text.lower().split())
