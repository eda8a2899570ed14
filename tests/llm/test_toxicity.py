import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from stewardry.llm import toxicity as tx


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = tx.fit_toxicity(docs, labels)
    told = tx.score_toxicity(docs, model).join(labels, "doc_id").where(tx.held_out())
    rows = told.select("toxic", "score", tx.toxic_by_language(F.col("score"), F.col("lang"), model).alias("cut")).collect()
    truth = np.array([r["toxic"] for r in rows])
    for said in (np.array([r["score"] >= tx.THRESHOLD for r in rows]), np.array([r["cut"] for r in rows])):
        assert (said[truth == 1]).mean() >= 0.92
        assert (said[truth == 0]).mean() <= 0.02


@pytest.fixture
def small(spark, docs_of):
    rnd = random.Random(2)
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(rnd.choices(words, k=30) + (["scum"] if i % 4 == 0 else []))) for i in range(400)]
    odd = [(900, None), (901, ""), (902, "  "), (903, "w1 " * 300_000 + "SCUM!"), (903, "w2"), (None, "scum")]
    labels = [(i, int(i % 4 == 0)) for i in range(400)] + [(0, 0), (900, 1), (901, 0), (None, 1), (5, None), (77777, 1)]
    return docs_of(rows + odd), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_odd_rows(small):
    docs, labels = small
    model = tx.fit_toxicity(docs, labels)
    rows = tx.score_toxicity(docs, model, output="s").select("doc_id", "text", "s").collect()
    assert len(rows) == 406 and all(0 <= r["s"] <= 1 for r in rows)
    score = {(r["doc_id"], r["text"] is None or len(r["text"]) < 10): r["s"] for r in rows}
    assert score[(900, True)] == score[(901, True)] == score[(902, True)] < 0.3
    assert score[(903, False)] > 0.3 > score[(903, True)]


def test_nothing_to_learn_from(small):
    docs, labels = small
    for few in (labels.where("false"), labels.where("toxic = 0")):
        scored = tx.score_toxicity(docs, tx.fit_toxicity(docs, few), output="s")
        assert scored.count() == 406
    model = tx.fit_toxicity(docs.where("false"), labels)
    assert tx.score_toxicity(docs.where("false"), model, output="s").collect() == []


def test_the_driver_does_not_fit(small, monkeypatch):
    docs, labels = small
    want = tx.fit_toxicity(docs, labels)
    monkeypatch.setattr(tx.TextCnn, "fit", lambda *_, **__: pytest.fail("the driver holds the documents"))
    got = tx.fit_toxicity(docs, labels)
    assert (got.net.table == want.net.table).all() and got.net.bias == want.net.bias and got.thresholds == want.thresholds
    assert (got.net.table != tx.TextCnn().table).any()


def test_split(spark):
    ids = spark.range(200).select(F.col("id").alias("doc_id"))
    got = {r["doc_id"]: r["h"] for r in ids.select("doc_id", tx.held_out().alias("h")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in range(200)}


def test_long_texts_in_pieces(monkeypatch):
    net = tx.TextCnn()
    rng = np.random.default_rng(1)
    docs = [rng.integers(1, 1000, n) << 20 | rng.integers(1, 1000, n) for n in (0, 1, 2, 50, 333)]
    whole = net.scores(docs)
    monkeypatch.setattr(tx, "STEP_WORDS", 7)
    assert np.allclose(net.scores(docs), whole, rtol=1e-5)
    assert len(whole) == 5


def test_thresholds_at_the_labels_own_prevalence(spark):
    """A tenth is toxic: all with "vile", a quarter of those with "rude". Taking "rude" only pays where half is toxic."""
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(6000):
        word, toxic = ("vile", 1) if i % 20 == 0 else ("rude", int(i % 20 == 1)) if i % 20 < 5 else ("fine", 0)
        rows.append((i, " ".join(rnd.choices(words, k=20) + [word]), ("en", "de")[i // 20 % 2], word, toxic))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, word string, toxic int")
    for sample in (300, 6000):
        model = tx.fit_toxicity(docs.drop("toxic"), docs.select("doc_id", "toxic"), sample_docs=sample)
        assert set(model.thresholds) == {"en", "de"}
        scored = tx.score_toxicity(docs, model)
        cut = tx.toxic_by_language(F.col("score"), F.col("lang"), model).cast("int")
        flagged = {r["word"]: r["f"] for r in scored.groupBy("word").agg(F.avg(cut).alias("f")).collect()}
        assert flagged["vile"] > 0.9 and flagged["rude"] < 0.3 and flagged["fine"] < 0.05, (sample, flagged)


def test_every_unfitted_label_calibrates(spark, docs_of):
    """Counts of all ids that were not fitted, weighed back to all ids; repeated documents count once."""
    net = tx.TextCnn()
    net.bias = np.float32(0)
    docs = docs_of([(i, "w" if i % 10 else "scum") for i in range(1000)] + [(7, "w")] * 500)
    ids = spark.range(1000).where(~tx.held_out("id")).select(F.col("id").alias("doc_id"), (F.col("id") % 10 == 0).cast("int").alias("toxic"))
    seen = []

    class Spy:
        def __call__(self, counts):
            seen.append(counts.sum(axis=1))
            return 0.4

    before, tx._best_threshold = tx._best_threshold, Spy()
    try:
        model = tx.calibrate(docs, ids, ids.where("doc_id % 20 = 0"), net)
    finally:
        tx._best_threshold = before
    sizes = [ids.where(f"toxic = {k}").count() for k in (0, 1)]
    assert model.default == 0.4 and set(model.thresholds) == {"en"}
    assert all(np.allclose(s, sizes) for s in seen) and len(seen) == 2


def test_a_repeated_id_is_fitted_on_once(small, docs_of, monkeypatch):
    docs, labels = small
    copies = docs_of([(i, f"scum copy{k}") for i in (0, 4, 8, 12) for k in range(300)])
    sizes = []
    fit = tx.TextCnn.fit
    monkeypatch.setattr(tx.TextCnn, "fit", lambda net, words, toxic: sizes.append(len(words)) or fit(net, words, toxic, steps=1))
    tx.fit_toxicity(docs, labels)
    tx.fit_toxicity(docs.union(copies), labels)
    assert sizes[0] == sizes[1]
