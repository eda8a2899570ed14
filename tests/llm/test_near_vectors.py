import numpy as np
import pytest

from stewardry.llm import near_vectors as nv


def brute(rows):
    good = [(i, v) for i, v in rows if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    x = nv.units([v for _, v in good])
    linked = x @ x.T >= nv.COSINE
    np.fill_diagonal(linked, False)
    label = nv.join_labels(linked)
    least = {k: min(good[i][0] for i in np.flatnonzero(label == k)) for k in set(label)}
    out = {i: (0, i) for i, _ in rows}
    for at, (i, _) in enumerate(good):
        out[i] = (int(linked[at].sum()), least[label[at]])
    return out


@pytest.mark.parametrize("block", [nv.BLOCK, 16])
def test_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(nv, "BLOCK", block)
    rng = np.random.default_rng(1)
    base = rng.normal(size=(12, 16))
    rows = []
    for i in range(300):
        b = base[i % 12 if i % 3 else 0]
        rows.append((i, (b + rng.normal(size=16) * 0.12).astype(np.float32).tolist()))
    rows += [(400 + i, rows[5][1]) for i in range(30)] + [(500, [x * 7 for x in rows[5][1]])]
    rows += [(600, None), (601, []), (602, [0.0] * 16), (603, [float("nan")] + [1.0] * 15), (604, [None] + [1.0] * 15), (605, [float("inf")] * 16)]
    rows += [(700 + i, rng.normal(size=16).astype(np.float32).tolist()) for i in range(50)]
    df = spark.createDataFrame([(i, v, 3) for i, v in rows], "vec_id long, embedding array<float>, copies int")
    got = {r["vec_id"]: r for r in nv.near_vectors(df).collect()}
    want = brute(rows)
    assert set(got) == set(want)
    links = sum(n for n, _ in want.values())
    found = sum(r["n_links"] for r in got.values())
    assert 0.985 * links <= found <= links
    assert sum(got[i]["component_id"] == c for i, (_, c) in want.items()) >= 0.98 * len(want)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())


def test_odd_tables(spark):
    schema = "vec_id long, embedding array<float>"
    assert nv.near_vectors(spark.createDataFrame([], schema)).collect() == []
    rows = [(None, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.0, 0.0])]
    got = sorted(map(tuple, nv.near_vectors(spark.createDataFrame(rows, schema)).collect()), key=str)
    assert got == sorted([(None, 0, None, True), (1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 0, 3, True)], key=str)
