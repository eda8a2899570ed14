"""Near duplicates of vectors: p-stable Euclidean hashing of unit vectors, exact cosine checks."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from stewardry.llm.common import block_tasks, components, join_labels, mix, per_task
from stewardry.session import materialize

COSINE = 0.95
# TABLES tables of HASHES quantised projections of width WIDTH. Unit vectors at cosine 0.95
# lie 0.316 apart and agree in one projection with probability 0.83, in a table with 0.16:
# a link at the threshold is found with probability 0.99, one at cosine 0.98 with 0.9999.
TABLES, HASHES, WIDTH = 30, 10, 1.5
BLOCK = 1_024


def _projection(dims, seed=5):
    rng = np.random.default_rng([seed, dims])
    return rng.normal(size=(dims, TABLES * HASHES)), rng.uniform(0, WIDTH, TABLES * HASHES)


def units(lists):
    """A matrix of unit vectors in double precision; extreme lengths are scaled first."""
    x = np.array(lists, np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def bucket_keys(unit):
    """The bucket of each vector in each table, as 64-bit names of (dimension, table, cells)."""
    a, b = _projection(unit.shape[1])
    cells = np.floor((unit @ a + b) / WIDTH).astype(np.int64).view(np.uint64).reshape(len(unit), TABLES, HASHES)
    key = mix(np.arange(TABLES, dtype=np.uint64)[None, :] + np.uint64(1000 * unit.shape[1]))
    key = np.repeat(key, len(unit), axis=0)
    for k in range(HASHES):
        key = mix(key * np.uint64(31) + cells[:, :, k])
    return key


def usable(embedding):
    """True for vectors with a direction: not null or empty, all components finite, not all zero."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return embedding.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(embedding, lambda x: x != 0)


def _by_dimension(lists):
    """Row numbers per vector length."""
    sizes = np.array([len(v) for v in lists])
    return [np.flatnonzero(sizes == d) for d in np.unique(sizes)]


def _hash(batches):
    for b in batches:
        lists = b.column(1).to_pylist()
        keys = np.zeros((len(lists), TABLES), np.uint64)
        for rows in _by_dimension(lists) if lists else ():
            keys[rows] = bucket_keys(units([lists[i] for i in rows]))
        owner = [np.repeat(b.column(c).to_numpy(), TABLES) for c in (0, 2)]
        columns = [*map(pa.array, owner), pa.array(keys.ravel().view(np.int64))]
        yield pa.RecordBatch.from_arrays(columns, names=["id", "h1", "grp"])


def _link(table, bounds):
    """Links of each block task: weights of new neighbours per vector, and a spanning forest."""
    ids, weights = table.column("id").to_numpy(), table.column("copies").to_numpy()
    chunk, i, j = (table.column(c).to_numpy() for c in ("chunk", "i", "j"))
    groups = table.column("grp").to_numpy().view(np.uint64)
    vectors = table.column("embedding").combine_chunks()
    out = ([], [], [])
    for a, z in zip(bounds, bounds[1:]):
        if z - a < 2:
            continue
        unit = units(vectors.slice(a, z - a).flatten().to_numpy().reshape(z - a, -1))
        linked = unit @ unit.T >= COSINE
        np.fill_diagonal(linked, False)
        if i[a] != j[a]:
            linked &= chunk[a:z, None] != chunk[None, a:z]
        left, right = np.nonzero(linked)
        if not len(left):
            continue
        # a pair counts in the first table in which its two vectors share a bucket
        keys = bucket_keys(unit)
        own = np.argmax((keys == groups[a]).any(axis=0))
        new = linked.copy()
        for t in range(own):
            new &= keys[:, t][:, None] != keys[:, t][None, :]
        found = new @ weights[a:z]
        label = join_labels(linked)
        some = np.flatnonzero(linked.any(axis=1))
        out[0].append(ids[a:z][some])
        out[1].append(ids[a:z][label[some]])
        out[2].append(found[some])
    if out[0]:
        columns = [pa.array(np.concatenate(c), pa.int64()) for c in out]
        yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "n"])


def near_vectors(vectors, vec_id="vec_id", embedding="embedding"):
    """(vec_id, n_links, component_id, kept) of every row.

    Links are pairs with cosine >= 0.95 in double precision that share a bucket. Equal vectors
    are one vector with a weight throughout, so any number of copies costs one
    row; buckets of one vector are dropped before vectors move; a large bucket is
    spread over block tasks and its pairs are counted there, never emitted. Vectors that are
    null, empty, zero or not finite, and rows with a null id, link with nothing (a null id has a
    null component and is kept). A repeated row counts as another vector; different
    vectors under one id share their links. Vectors of different lengths never link.
    """
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("embedding"))
    good = rows.where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    good = good.withColumn("h1", F.xxhash64("embedding")).withColumn("h2", F.xxhash64(F.lit("second"), "embedding"))
    same = good.groupBy("h1", "h2").agg(
        F.min("vec_id").alias("id"), F.count("*").alias("copies"), F.any_value("embedding").alias("embedding")
    )
    same = materialize(same, "vector-classes")

    hashed = same.select("id", "embedding", "h1").mapInArrow(_hash, "id long, h1 long, grp long")
    hashed = materialize(hashed, "vector-buckets")
    sizes = hashed.groupBy("grp").agg(F.count("*").alias("size")).where("size > 1")
    sizes = materialize(sizes, "vector-sizes")
    members = hashed.join(sizes, "grp").join(same.select("id", "h1", "copies", "embedding"), ["id", "h1"])
    links = materialize(per_task(block_tasks(members, BLOCK), _link, "a long, b long, n long"), "vector-links")
    counts = links.groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("n"))
    comps = components(links.select("a", "b"), "vector-components")
    of_class = same.select("h1", "h2", "id", "copies").join(counts, "id", "left").join(comps, "id", "left")
    of_class = of_class.select(
        "h1", "h2", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("component", "id").alias("component_id")
    )
    linked = good.select("vec_id", "h1", "h2").join(of_class, ["h1", "h2"]).drop("h1", "h2")
    rest = rows.where(~(F.col("vec_id").isNotNull() & F.coalesce(usable(F.col("embedding")), F.lit(False))))
    rest = rest.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    both = linked.unionByName(rest)
    return both.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
