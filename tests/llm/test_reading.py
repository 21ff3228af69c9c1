"""Problem 10: reading level."""

from __future__ import annotations

import random

from millrace.llm import reading as R


def corpus(spark, n=400, seed=1):
    rng = random.Random(seed)
    vocab = {level: [f"{'abcde'[level - 1] * (level + 1)}{chr(97 + i)}" for i in range(20)] for level in range(1, 6)}
    docs, labels = [], []
    for i in range(n):
        level = 1 + i % 5
        ws = [rng.choice(vocab[min(5, max(1, level + rng.choice((-1, 0, 0, 0, 1))))]) for _ in range(60)]
        docs.append((i, " ".join(ws) + ".", 0))
        labels += [(i, "r1", level), (i, "r2", level if rng.random() > 0.2 else max(1, level - 1))]
    labels += [(0, "r3", None), (1, None, 9), (None, "r1", 3)]
    return spark.createDataFrame(docs, "doc_id long, text string, level int"), spark.createDataFrame(labels, "doc_id long, rater string, reading_level int")


def test_held_out_accuracy(spark):
    rows = R.held_out(*corpus(spark)).collect()
    assert len(rows) > 40
    assert sum(abs(r.reading_level - r.level) for r in rows) / len(rows) < 0.5


def test_every_text_gets_an_estimate(spark):
    docs, labels = corpus(spark)
    more = spark.createDataFrame([(900, None, 1), (901, "", 1), (902, "...", 1), (903, "palabras desconocidas sin nivel alguno", 1), (904, "aab " * 100_000, 1), (900, None, 1)], "doc_id long, text string, level int")
    got = {r.doc_id: r for r in R.reading_levels(docs.unionByName(more), labels).collect()}
    assert [got[i].basis for i in (900, 901, 902, 903, 904)] == ["no_text", "no_text", "no_text", "shape", "words"]
    assert got[900].reading_level is None
    assert 1 <= got[903].reading_level <= 5
    assert got[904].reading_level < 2


def test_no_labels(spark):
    docs, labels = corpus(spark, 20)
    rows = R.reading_levels(docs, labels.where("doc_id < 0")).collect()
    assert {r.basis for r in rows} == {"none"}
    assert R.reading_levels(docs.where("doc_id < 0"), labels).count() == 0


def test_on_judgements(spark, sf):
    sf = sf.replace("sf0.001", "sf0.1")
    rows = R.held_out(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/reading_labels.parquet")).collect()
    error = sum(abs(r.reading_level - r.level) for r in rows) / len(rows)
    exact = sum(abs(r.level_class - r.level) <= 0.5 for r in rows) / len(rows)
    print(f"held out: {len(rows)} documents, mean error {error:.3f}, class within half a level {exact:.3f}")
    assert error < 0.6
