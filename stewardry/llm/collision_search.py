"""Approximate nearest neighbours by counting collisions in single-projection sorted arrays."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stewardry.llm.common import shuffle_tasks, whole_groups
from stewardry.llm.near_vectors import usable

# Projections (sorted arrays) of a block; a vector is verified once it lies in the query's
# window in CROWD of them. Windows start WIDTH wide on either side and grow by GROWTH until
# FRACTION of the block, and at least SPARE times k vectors, are verified.
PROJECTIONS, CROWD = 96, 80
WIDTH, GROWTH = 0.5, 1.4
FRACTION, SPARE = 0.08, 3
# Vectors of one block and queries of one pass over it; both bound a task.
BLOCK, QUERIES = 8_192, 1_024
# A table of up to SPREAD * SMALL_BLOCK vectors is cut into smaller blocks, for as many tasks.
SMALL_BLOCK, SPREAD = 1_024, 64


def _unit_projections(dims, seed=3):
    rng = np.random.default_rng([seed, dims])
    a = rng.normal(size=(dims, PROJECTIONS))
    return a / np.sqrt((a * a).sum(axis=0))


class CollisionIndex:
    """Sorted arrays of one block of vectors of one length."""

    def __init__(self, vectors):
        self.vectors = vectors
        self.projection = _unit_projections(vectors.shape[1])
        values = vectors @ self.projection
        self.spread = float(values.std()) or 1.0
        self.order = np.argsort(values, axis=0, kind="stable").T.copy()
        # all arrays end to end, each moved into its own range, so that one search finds all ends of a window
        self.low, top = values.min(axis=0), values.max(axis=0)
        self.step = 3 * max(float((top - self.low).max()), 1e-300)
        self.shift = np.arange(PROJECTIONS) * self.step - self.low
        self.length = top - self.low
        self.flat = (np.sort(values, axis=0) + self.shift).T.ravel()
        self.first = np.arange(PROJECTIONS) * len(vectors)
        self.need = max(int(FRACTION * len(vectors)), 1)
        # widths of the windows so far, and the step at which the last query had enough rows
        self.radii, self.usual = [WIDTH * self.spread], 0

    def _rank(self, values, side):
        """Where values stand in their own arrays."""
        inside = np.clip(values - self.low, -self.step / 3, self.length + self.step / 3)
        return np.searchsorted(self.flat, inside + self.low + self.shift, side) - self.first

    def _reach(self, at, step):
        """Ends of the windows ``step`` widenings wide around ``at`` in all arrays."""
        while len(self.radii) <= step:
            self.radii.append(self.radii[-1] * GROWTH)
        return self._rank(at - self.radii[step], "left"), self._rank(at + self.radii[step], "right")

    def _tally(self, *spans):
        """How often each row lies between the given ends, over all arrays."""
        rows = [o[a:b] for low, high in spans for o, a, b in zip(self.order, low.tolist(), high.tolist())]
        return np.bincount(np.concatenate(rows), minlength=len(self.vectors))

    def candidates(self, query, k):
        """Rows that collide with the query in at least CROWD arrays, at the first radius with enough of them.

        Virtual rehashing: windows widen step by step. A wider one only adds rows, so the search starts at the step
        where the last query ended and moves from there. At that width most rows lie in most windows, so it
        counts the arrays in which a row lies outside: the counter changes by the rows between two widths.
        """
        n, need = len(self.vectors), min(len(self.vectors), max(self.need, SPARE * k))
        at, step = query @ self.projection, self.usual
        left, right = self._reach(at, step)
        missed = self._tally((np.zeros_like(left), left), (right, np.full_like(right, n)))
        found = np.flatnonzero(missed <= PROJECTIONS - CROWD)
        narrow = len(found) >= need
        while len(found) < need:
            step += 1
            low, high = self._reach(at, step)
            missed -= self._tally((low, left), (right, high))
            left, right, found = low, high, np.flatnonzero(missed <= PROJECTIONS - CROWD)
        while narrow and step:
            low, high = self._reach(at, step - 1)
            missed += self._tally((left, low), (high, right))
            fewer = np.flatnonzero(missed <= PROJECTIONS - CROWD)
            narrow = len(fewer) >= need
            if narrow:
                step, left, right, found = step - 1, low, high, fewer
        self.usual = step
        return found

    def nearest(self, query, k, ids, own):
        """The k nearest verified rows but those whose id is ``own``: (distance, id) in order."""
        found = self.candidates(query, k + int((ids == own).sum()))
        found = found[ids[found] != own]
        apart = self.vectors[found] - query
        score = np.sqrt((apart * apart).sum(axis=1))
        best = np.lexsort((ids[found], score))[:k]
        return score[best], ids[found][best]


def _search(k):
    schema = ["query_id", "vec_id", "score"]

    def run(batches):
        for table, bounds in whole_groups(batches, ("block", "part", "dims")):
            ids, is_query = table.column("id").to_numpy(), table.column("is_query").to_numpy(zero_copy_only=False)
            vectors = table.column("embedding").combine_chunks()
            out = ([], [], [])
            for a, z in zip(bounds, bounds[1:]):
                x = vectors.slice(a, z - a).flatten().to_numpy().reshape(z - a, -1).astype(np.float64)
                asked = is_query[a:z]
                if asked.all() or not asked.any():
                    continue
                index, own = CollisionIndex(x[~asked]), ids[a:z][~asked]
                for q, query in zip(ids[a:z][asked], x[asked]):
                    score, best = index.nearest(query, k, own, q)
                    out[0].append(np.full(len(best), q))
                    out[1].append(best)
                    out[2].append(score)
            if out[0]:
                columns = [pa.array(np.concatenate(c)) for c in out]
                yield pa.RecordBatch.from_arrays(columns, names=schema)

    return run


def nearest_vectors(queries, vectors, k=10, vec_id="vec_id", embedding="embedding"):
    """(query_id, rank, vec_id, score): for each query the k nearest of ``vectors`` but its own id.

    The rows are dealt by a hash into blocks, the queries into parts; each block and part meet in
    one task, which indexes the block and answers the part. A task holds one block and one part, so
    neither side is ever broadcast or whole anywhere. Every block returns k rows per query and
    the best k of all blocks are kept, nearest first, ties to the smaller id.

    Vectors that are null, empty, zero or not finite and rows with a null id take no part, nor do
    vectors of another length than the query's. With fewer than k candidates all are
    returned. Equal rows of the index are returned once each; a repeated query once.
    """
    spark = vectors.sparkSession
    pick = lambda df: df.select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).alias("embedding")).where(
        F.col("id").isNotNull() & usable(F.col("embedding"))
    )
    rows, asked = pick(vectors), pick(queries).dropDuplicates(["id"])
    # small tables are spread over tasks, large ones cut into blocks of bounded size; the rows alone decide
    n, q = rows.count(), asked.count()
    blocks = max(-(-n // BLOCK), min(-(-n // SMALL_BLOCK), SPREAD), 1)
    parts = max(-(-q // QUERIES), 1)
    dealt = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    rows = rows.select("id", "embedding", F.lit(False).alias("is_query"), dealt(blocks).alias("block"), every(parts).alias("part"))
    asked = asked.withColumn("part", dealt(parts))
    asked = asked.select("id", "embedding", F.lit(True).alias("is_query"), every(blocks).alias("block"), "part")
    both = rows.unionByName(asked).withColumn("dims", F.size("embedding"))
    tasks = both.repartition(max(shuffle_tasks(spark), 1), "block", "part").sortWithinPartitions("block", "part", "dims")
    found = tasks.mapInArrow(_search(k), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
