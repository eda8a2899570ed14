"""The generalisation lattice against all its nodes counted in plain Python."""

import random
from collections import Counter
from itertools import product

import pytest
from pyspark.sql import functions as F

from stewardry.operators import lattice


def ladders():
    return {
        "age": [F.col("age"), F.floor(F.col("age") / 10).cast("int"), F.lit(None).cast("int")],
        "place": [F.col("town"), F.substring("town", 1, 1), F.lit("*")],
    }


PLAIN = {
    "age": [lambda r: r[1], lambda r: None if r[1] is None else r[1] // 10, lambda r: None],
    "place": [lambda r: r[2], lambda r: None if r[2] is None else r[2][:1], lambda r: "*"],
}


def people(seed, n):
    rnd = random.Random(seed)
    towns = ["ab", "ac", "ad", "ba", "bb", "ca", None]
    rows = [(i, rnd.choice([None, *range(20, 60)]), rnd.choice(towns), rnd.random()) for i in range(n)]
    return rows + [(n + i, 31, "ab", 0.5) for i in range(n // 2)]  # one group holds a third


def brute(rows, k):
    out = {}
    for node in product(range(3), range(3)):
        key = lambda r, node=node: tuple(steps[level](r) for steps, level in zip(PLAIN.values(), node))
        groups = Counter(map(key, rows))
        out[node] = (len(groups), sum(n for n in groups.values() if n < k), key)
    return out


@pytest.mark.parametrize("seed,n,k,allowed", [(1, 40, 3, 0), (2, 200, 5, 0), (3, 200, 5, 30), (4, 9, 50, 0), (5, 60, 1, 0)])
def test_fewest_rows_lost_at_the_lowest_node(spark, seed, n, k, allowed):
    rows = people(seed, n)
    df = spark.createDataFrame(rows, "id int, age int, town string, pay double")
    expect = brute(rows, k)
    losses = lattice.node_losses(lattice.finest_groups(df, ladders()), ladders(), k)
    got = {(r["age_level"], r["place_level"]): (r["n_groups"], r["n_lost"]) for r in losses.collect()}
    assert got == {node: v[:2] for node, v in expect.items()}
    fine = [node for node, v in expect.items() if v[1] <= allowed]
    best = min(fine, key=lambda x: (sum(x), expect[x][1], x)) if fine else min(expect, key=lambda x: (expect[x][1], sum(x), x))
    assert lattice.choose(losses, ladders(), allowed) == (best, sum(best), expect[best][1])

    key = expect[best][2]
    sizes = Counter(map(key, rows))
    stay = Counter((*key(r), r[3]) for r in rows if sizes[key(r)] >= k)
    out = lattice.generalise(df, ["id", "town"], ladders(), k, allowed)
    assert set(out.columns) == {"age", "place", "pay"}
    assert Counter((r["age"], r["place"], r["pay"]) for r in out.collect()) == stay


def test_empty_table_stays_empty_at_the_finest_level(spark):
    df = spark.createDataFrame([], "id int, age int, town string, pay double")
    losses = lattice.node_losses(lattice.finest_groups(df, ladders()), ladders(), 5)
    assert losses.count() == 9 and lattice.choose(losses, ladders()) == ((0, 0), 0, 0)
    assert lattice.generalise(df, ["id"], ladders(), 5).count() == 0


def test_the_table_is_read_once_for_all_nodes(spark):
    df = spark.createDataFrame(people(6, 50), "id int, age int, town string, pay double")
    finest = lattice.finest_groups(df, ladders())
    text = lattice.node_losses(finest, ladders(), 5)._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and "Expand" in text
