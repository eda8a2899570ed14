import numpy as np
import pytest

from stewardry.llm import collision_search as cs
from tests.llm.conftest import FOLDER


def exact(rows, queries, k):
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], np.float64)
    out = {}
    for q, v in queries:
        d = np.sqrt(((x - np.array(v, np.float64)) ** 2).sum(axis=1))
        at = np.lexsort((ids, d))
        out[q] = [(float(d[i]), int(ids[i])) for i in at if ids[i] != q][:k]
    return out


def test_recall_on_the_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in table.select("vec_id", "embedding").collect()]
    want = exact(rows, [r for r in rows if r[0] % 100 == 0], 10)
    got = {}
    for r in cs.nearest_vectors(table.where("vec_id % 100 = 0"), table).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["score"], r["vec_id"])
    hits = sum(len({i for _, i in v} & {i for _, i in got[q].values()}) for q, v in want.items())
    total = sum(map(len, want.values()))
    assert hits >= 0.95 * total
    for q, found in got.items():
        scores = [found[r] for r in sorted(found)]
        assert sorted(found) == list(range(1, len(found) + 1)) and scores == sorted(scores)
        truth = dict((i, d) for d, i in want[q])
        assert all(d == pytest.approx(truth.get(i, d), rel=1e-12) for d, i in scores)


def test_small_and_odd_tables(spark):
    schema = "vec_id long, embedding array<float>"
    rows = [(0, [0.0, 1.0]), (1, [0.0, 2.0]), (2, [0.0, 2.0]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]), (None, [1.0, 1.0]), (6, [1.0])]
    df = spark.createDataFrame(rows, schema)
    got = [tuple(r) for r in cs.nearest_vectors(df.where("vec_id % 100 = 0"), df, k=10).orderBy("rank").collect()]
    assert got == [(0, 1, 1, 1.0), (0, 2, 2, 1.0)]
    assert cs.nearest_vectors(df.where("false"), df).collect() == []
    assert cs.nearest_vectors(df, df.where("false")).collect() == []
    assert FOLDER


def test_windows_reach_everything():
    x = np.random.default_rng(2).normal(size=(40, 8))
    index = cs.CollisionIndex(x)
    score, ids = index.nearest(x[3], 39, np.arange(40), 3)
    assert len(ids) == 39 and list(score) == sorted(score)


def test_the_number_of_shuffle_tasks_changes_nothing(spark):
    rows = np.random.default_rng(5).normal(size=(3_000, 16))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], "vec_id long, embedding array<double>")
    found, before = [], spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for tasks in ("4", "31"):
            spark.conf.set("spark.sql.shuffle.partitions", tasks)
            found.append(sorted(map(tuple, cs.nearest_vectors(table.where("vec_id % 100 = 0"), table).collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1] and len(found[0]) == 300


def test_many_equal_vectors_are_told_apart_by_id(spark):
    rows = [(i, [1.0, 0.5]) for i in range(60)] + [(100, [1.0, 0.5]), (200, None), (60, [9.0, 9.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = cs.nearest_vectors(df.where("vec_id % 100 = 0"), df, k=10).collect()
    by_query = {q: [(r["rank"], r["vec_id"], r["score"]) for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q] for q in (0, 100)}
    assert by_query[0] == [(n, n, 0.0) for n in range(1, 11)]
    assert by_query[100] == [(n + 1, n, 0.0) for n in range(10)]


def test_few_rows_are_counted_and_the_first_radius_with_enough_is_found(monkeypatch):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(600, 24))
    index = cs.CollisionIndex(x)
    values, counted, plain = x @ index.projection, [], np.bincount
    monkeypatch.setattr(cs.np, "bincount", lambda rows, **kw: counted.append(len(rows)) or plain(rows, **kw))
    queries = [*x[:30], *rng.normal(size=(10, 24)), 50 + x[0], *x[30:40]]
    for query in queries:
        apart, radius = np.abs(values - query @ index.projection), cs.WIDTH * index.spread
        while ((apart <= radius).sum(axis=1) >= cs.CROWD).sum() < index.need:
            radius *= cs.GROWTH
        assert index.candidates(query, 10).tolist() == np.flatnonzero((apart <= radius).sum(axis=1) >= cs.CROWD).tolist()
    # the windows hold most of the block; what is counted is the smaller rest
    assert sum(counted) < 0.55 * len(queries) * x.shape[0] * cs.PROJECTIONS
