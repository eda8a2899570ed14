"""Generalisation lattice: the least coarsening of quasi-identifiers under which no group is smaller than k."""

from itertools import product

from pyspark.sql import functions as F

from stewardry.functions.scale import reference_join
from stewardry.session import materialize


def _key(column, level):
    return f"q{column}_{level}"


def _keys(ladders):
    return [_key(c, level) for c, steps in enumerate(ladders.values()) for level in range(len(steps))]


def _node_keys(node):
    return [_key(c, level) for c, level in enumerate(node)]


def nodes(ladders):
    """Every choice of one level per column, as tuples of level numbers; 0 is the finest."""
    return list(product(*(range(len(steps)) for steps in ladders.values())))


def finest_groups(df, ladders):
    """Rows per combination of all levels: one partial aggregate over the table, from which every node is counted.

    Each value stands in a struct, which is never null, so that rows without a value are a group of their own.
    """
    levels = [
        F.struct(step.alias("v")).alias(_key(c, level))
        for c, steps in enumerate(ladders.values())
        for level, step in enumerate(steps)
    ]
    return materialize(df.select(*levels).groupBy(*_keys(ladders)).agg(F.count("*").alias("n")), "finest-groups")


def node_losses(finest, ladders, k):
    """(one level per column, height, n_groups, n_lost) of every node: how many rows stand in groups smaller than ``k``.

    One grouping-sets aggregate over the finest groups counts all nodes, so the table itself is read once
    whatever the size of the lattice. A table without rows loses none at any node.
    """
    keys, every = _keys(ladders), nodes(ladders)
    groups = finest.groupingSets([_node_keys(node) for node in every], *keys).agg(
        F.grouping_id().alias("node_id"), F.sum("n").alias("n")
    )
    lost = F.sum(F.when(F.col("n") < k, F.col("n")).otherwise(0))
    counted = groups.groupBy("node_id").agg(F.count("*").alias("n_groups"), lost.alias("n_lost"))
    # a set bit of the grouping id is a key the node does not use, the first key in the highest place
    ids = [int("".join("0" if key in _node_keys(node) else "1" for key in keys), 2) for node in every]
    names = [f"{name}_level" for name in ladders]
    known = finest.sparkSession.createDataFrame(
        [(i, *node, sum(node)) for i, node in zip(ids, every)],
        "node_id long, " + ", ".join(f"`{n}` int" for n in names) + ", height int",
    )
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return counted.join(F.broadcast(known), "node_id", "right").select(*names, "height", zero("n_groups"), zero("n_lost"))


def choose(losses, ladders, allowed=0):
    """The node to use, from one row per node.

    Of the nodes that lose at most ``allowed`` rows the lowest; else the one that loses the fewest. Ties go to
    fewer rows lost or to the lower node, then to the finer levels of the columns in their order.
    """
    rows = [(tuple(r[f"{name}_level"] for name in ladders), r["height"], r["n_lost"]) for r in losses.collect()]
    enough = [r for r in rows if r[2] <= allowed]
    if enough:
        return min(enough, key=lambda r: (r[1], r[2], r[0]))
    return min(rows, key=lambda r: (r[2], r[1], r[0]))


def generalise(df, drop, ladders, k, allowed=0):
    """Anonymized rows: identifiers dropped, each quasi-identifier at the level of the chosen node.

    ``ladders`` lists for each output column its expressions from fine to coarse; they may read any column of
    ``df``, those dropped too. Groups still smaller than ``k`` at the chosen node are suppressed; where the node
    loses none, no row is moved or looked up.
    """
    finest = finest_groups(df, ladders)
    node, _, n_lost = choose(node_losses(finest, ladders, k), ladders, allowed)
    levels = {name: steps[level] for (name, steps), level in zip(ladders.items(), node)}
    coarse = df.withColumns(levels).drop(*[c for c in drop if c not in levels])
    if not n_lost:
        return coarse
    own = F.struct(*[F.struct(F.col(name).alias("v")).alias(key) for name, key in zip(levels, _node_keys(node))])
    small = finest.groupBy(*_node_keys(node)).agg(F.sum("n").alias("n")).where(F.col("n") < k)
    small = small.select(F.struct(*_node_keys(node)).alias("_group"))
    return reference_join(coarse.withColumn("_group", own), small, ["_group"], "left_anti", derived="small-groups").drop("_group")
