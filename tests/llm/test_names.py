"""Columns of any name, keys beyond the broadcast, and rows that must not move or be lost."""

import random

import corpus_pipeline
from pyspark.sql import functions as F

from stewardry.llm import common, mixing, near_docs, queries, secret_scan, url_filter, warc
from tests.llm.conftest import FOLDER

CLASH = (
    "rest", "blocks", "epochs", "cut_doc", "cut_block", "_s", "_d", "row", "_rank", "_n", "stays", "n", "a.b", "with `tick`", "_toxic_score",
    "h", "segment", "bands", "id", "grp", "class_id", "kept", "n_words", "kept_text",
)


def clashing(docs):
    return docs.withColumns({c: F.lit(f"own {c}") for c in CLASH})


def corpus(docs_of):
    rnd = random.Random(1)
    texts = [" ".join(rnd.choices([f"w{i}" for i in range(300)], k=80)) for _ in range(30)]
    rows = [(i, texts[i % 30], f"s{i % 3}") for i in range(60)] + [(60, None, "s0"), (61, "", None), (None, texts[0], "s1"), (3, texts[3], "s0")]
    return docs_of(rows)


def kept_whole(rows, docs):
    assert rows.columns == docs.columns
    for r in rows.collect():
        assert all(r[c] == f"own {c}" for c in CLASH)


def test_mix_and_keep_one_under_clashing_names(docs_of):
    docs = clashing(corpus(docs_of))
    drawn = mixing.mix(docs, 1.0, max_repeats=4.0)
    assert drawn.count() > 0
    kept_whole(drawn.drop("epoch", "block", "block_key", "doc_key"), docs)
    left = near_docs.keep_one(docs, near_docs.near_documents(docs))
    kept_whole(left, docs)
    assert sorted(r["doc_id"] for r in left.where("doc_id is not null").select("doc_id").collect()) == [*range(30), 60, 61]


def test_stages_under_clashing_names(spark):
    docs = clashing(spark.read.parquet(f"{FOLDER}/documents.parquet").limit(60))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs, before = stage(spark, docs, FOLDER), docs
        kept_whole(docs, before)


def test_keys_beyond_the_broadcast(spark, docs_of, monkeypatch):
    """A filter of fixed size in place of a broadcast of the keys: the same rows, nulls included."""
    monkeypatch.setattr(common, "BROADCAST_KEYS", 0)
    docs = corpus(docs_of)
    found = near_docs.near_documents(docs)
    left = near_docs.keep_one(docs, found)
    assert sorted(str(r["doc_id"]) for r in left.select("doc_id").collect()) == sorted([*map(str, [*range(30), 60, 61]), "None"])
    names = spark.range(0, 5000, 7).select(F.col("id").alias("k"))
    some = spark.range(5000).select(F.col("id").alias("k"), F.lit("x").alias("text")).union(spark.sql("select cast(null as bigint), 'n'"))
    wanted, others = common.named_rows(some, names.where("k < 100"), names, "k")
    assert sorted(r["k"] for r in wanted.collect()) == list(range(0, 100, 7))
    assert sorted(str(r["k"]) for r in others.collect()) == sorted([*(str(k) for k in range(5000) if k % 7), "None"])


def chains(n):
    rnd = random.Random(n)
    edges = [(i, i + 1) for i in range(0, 40)] + [(1000, 1000 + i) for i in range(1, 80)] + [(1079, 5), (2000, 2001), (7, 7)]
    return rnd.sample(edges, len(edges))


def test_components_by_either_join(spark, monkeypatch):
    want = {i: 0 for i in [*range(41), *range(1000, 1080)]} | {2000: 2000, 2001: 2000}
    for limit in (500_000, 0):
        monkeypatch.setattr(common, "BROADCAST_KEYS", limit)
        got = common.components(spark.createDataFrame(chains(3), "a long, b long"), "test-parts").collect()
        assert {r["id"]: r["component"] for r in got} == want and len(got) == len(want)


def test_rounds_over_few_edges_take_few_tasks(spark, monkeypatch):
    files, write = [], common.materialize

    def counted(df, label):
        table = write(df, label)
        files.append(len(table.inputFiles()))
        return table

    monkeypatch.setattr(common, "materialize", counted)
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "24"}
    was = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        got = common.components(spark.createDataFrame(chains(4), "a long, b long"), "test-few").collect()
    finally:
        for k, v in was.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    assert {r["id"]: r["component"] for r in got} == {i: 0 for i in [*range(41), *range(1000, 1080)]} | {2000: 2000, 2001: 2000}
    assert len(files) > 2 and max(files[1:]) == 1


def test_urls_that_look_like_marks(spark):
    urls = ["http://com/\0rule", "http://com/\0parts/x", "http://example.com/en/\0rule", "http://\0rule.com/", "http://a..com/en", "http://.com/"]
    pages = spark.createDataFrame([(i, u, "mine", "own") for i, u in enumerate(urls)], "page_id long, url string, _m string, _match string")
    got = url_filter.filter_urls(pages, [*queries.URL_RULES, ("com", "/par", "block")]).orderBy("page_id").collect()
    assert [r["rule"] for r in got] == ["com/", "com/", "example.com/en/", "com/", "com/", "com/"]
    assert {(r["_m"], r["_match"]) for r in got} == {("mine", "own")}


def test_a_record_per_page_row(spark, tmp_path):
    rows = [(1, "http://a/", "x" * 2_000)] * 3 + [(2, "http://b/", "x" * 2_000), (2, "http://b/", "x" * 2_000), (3, None, None), (3, None, None)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    got = sorted(map(tuple, queries.QUERIES["op4_warc"](spark, str(tmp_path)).select("page_id", "payload_bytes", "record_type", "refers_to").collect()), key=str)
    assert got == sorted([(1, 2000, "revisit", 2)] * 3 + [(2, 2000, "response", None)] * 2 + [(3, 0, "response", None)] * 2, key=str)
    whole = warc.archive_pages(spark.read.parquet(str(tmp_path / "pages.parquet"))).where("copies = 2 and refers_to is null").collect()
    assert sorted(len(r["response"]["payload"]) for r in whole) == [0, 2000]


def test_ranks_by_sizes(spark, docs_of):
    rnd = random.Random(4)
    words = {"".join(rnd.choices("abcdefgh", k=7)): n for n in range(1, 200)}
    docs = docs_of([(i, f"{w} " * n) for i, (w, n) in enumerate(words.items())])
    best = sorted(words, key=lambda w: (-words[w], w))
    assert [w for w in secret_scan.ranked_words(docs, limit=50) if w not in secret_scan.STAND_INS] == best[:50]
