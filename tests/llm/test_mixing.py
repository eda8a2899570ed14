import math

import pytest
from pyspark.sql import functions as F

from stewardry.llm import mixing


def text(n):
    return " ".join(["w"] * n)


@pytest.fixture
def corpus(docs_of):
    rows = [(i, text(50), "big") for i in range(80)] + [(100 + i, text(10), "small") for i in range(10)]
    rows += [(200, None, "small"), (201, "", None), (202, text(30), None), (203, text(30), None), (203, text(30), None)]
    return docs_of(rows)


def test_quotas_and_repetition(corpus):
    sources = {r["_s"]: r for r in mixing.source_weights(corpus, 1.0, max_repeats=4.0).collect()}
    total = 80 * 50 + 100 + 90
    assert sum(r["tokens"] for r in sources.values()) == total
    assert abs(sum(r["weight"] for r in sources.values()) - 1) < 1e-6
    assert max(r["quota"] / r["tokens"] for r in sources.values()) == pytest.approx(4, abs=0.05)
    drawn = mixing.mix(corpus, 1.0, max_repeats=4.0)
    got = drawn.groupBy(mixing._key("source")).agg(F.sum(mixing.tokens_of("text")).alias("n"))
    for r in got.collect():
        quota = sources[r["_s"]]["quota"]
        assert quota - 100 <= r["n"] <= quota
    assert drawn.columns == corpus.columns + ["epoch", "block", "block_key", "doc_key"]


def test_entropy_is_met(corpus):
    rows = mixing.source_weights(corpus, 1.0, target_entropy=0.8).collect()
    entropy = -sum(r["weight"] * math.log(r["weight"]) for r in rows)
    assert entropy == pytest.approx(0.8, abs=1e-5)


def test_no_budget_keeps_every_row(corpus):
    drawn = mixing.mix(corpus, max_repeats=2.0)
    assert {r[0] for r in drawn.select("doc_id").collect()} == {r[0] for r in corpus.select("doc_id").collect()}
    most = drawn.groupBy("doc_id").count().where("doc_id != 203").agg(F.max("count")).first()[0]
    assert most <= 3


def test_blocks_cover_a_source_in_order(corpus, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_TOKENS", 200)
    drawn = mixing.mix(corpus, 0.5, target_entropy=0.1).where("source = 'big'").collect()
    assert len({r["block"] for r in drawn}) > 5
    assert len({r["doc_id"] for r in drawn}) == len(drawn)


def test_empty_table(corpus):
    assert mixing.mix(corpus.where("false"), 1.0, max_repeats=2.0).collect() == []
    assert mixing.mix(corpus.where("doc_id = 200"), max_repeats=2.0).collect() == []


def test_a_wordless_source_beside_others_is_drawn_once(corpus, docs_of):
    docs = corpus.union(docs_of([(300, None, "mute"), (301, "", "mute"), (302, "  ", "mute")]))
    epochs = {r["doc_id"]: r["epoch"] for r in mixing.mix(docs, max_repeats=2.0).where("source = 'mute'").collect()}
    assert epochs == {300: 0, 301: 0, 302: 0}
    assert mixing.mix(docs, 1.0, max_repeats=4.0).where("source = 'mute'").count() == 0


def test_no_python_in_the_plan(corpus, capsys):
    mixing.mix(corpus, 1.0, max_repeats=4.0).explain()
    plan = capsys.readouterr().out
    assert not any(x in plan for x in ("EvalPython", "InPandas", "InArrow", "Cartesian"))
