import corpus_pipeline
from pyspark.sql import functions as F

from tests.llm.conftest import FOLDER
from tests.llm.test_near_docs import brute as near_classes
from tests.llm.test_substrings import brute as cut_words


def test_stages_one_by_one(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    seen = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, FOLDER)
        out.write.parquet(str(tmp_path / str(k)))
        seen[name] = docs, spark.read.parquet(str(tmp_path / str(k)))
        if k < 4:
            assert out.dtypes == docs.dtypes
        docs = seen[name][1]
    before, after = seen["minhash_near_dedup"]
    classes = near_classes([(r["doc_id"], r["text"]) for r in before.collect()])
    assert {r["doc_id"] for r in after.collect()} == {i for i, c in classes.items() if i == c}
    before, after = seen["substring_dedup"]
    want = cut_words([(r["doc_id"], r["text"]) for r in before.collect()])
    texts = {r["doc_id"]: r["text"] for r in before.collect()}
    got = {r["doc_id"]: r["text"] for r in after.collect()}
    assert got == {i: (kept if gone else texts[i]) for i, _, gone, kept in want}
    before, after = seen["mix_sources"]
    assert {r["doc_id"] for r in before.collect()} == {r["doc_id"] for r in after.collect()}
    assert after.count() > before.count()
    before, after = seen["sentencepiece"]
    assert before.count() == after.count()
    rows = corpus_pipeline.run(spark, FOLDER)
    assert rows.columns == after.columns
    assert sorted(map(str, rows.collect())) == sorted(map(str, after.collect()))


def test_odd_documents(spark, tmp_path):
    schema = spark.read.parquet(f"{FOLDER}/documents.parquet").schema
    rows = [(None, "nobody", None, None, None), (1, None, "en", "s", 0), (2, "", "en", None, 0), (2, "", "en", None, 0), (3, "a " * 90, "xx", "s", 180)]
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for table in (rows, []):
        docs = spark.createDataFrame(table, schema)
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, str(tmp_path))
            if name != "sentencepiece":
                assert docs.columns == [f.name for f in schema]
        assert docs.agg(F.count("*")).first()[0] == 0 if not table else docs.count() >= 1
