"""Join helpers that check sizes and spread hot keys."""

from pyspark.sql import functions as F

from stewardry.session import materialize

# A side is broadcast only when it is known to hold no more rows than this.
BROADCAST_ROWS = 100_000
SALTS = 32
# A key is hot when it holds more than this share of a sample; so at most 200 keys are.
HOT_SHARE = 1 / 200
SAMPLE = 0.02
MIN_HITS = 50


def fits(df, limit=BROADCAST_ROWS):
    """True when ``df`` holds at most ``limit`` rows.

    Partitions are read a few at a time until the limit is passed, so a large table
    is not scanned to learn that it is large.
    """
    return not df.select(F.lit(1)).offset(limit).limit(1).collect()


def hot_hashes(df, keys):
    """Hashes of the keys that hold a large share of ``df``, from a sample.

    The list only steers the salting: a key missed or named in vain changes the
    balance of the tasks, never the result. Its length is bounded by 1 / HOT_SHARE.
    """
    sampled = df.select(F.xxhash64(*keys).alias("h")).sample(fraction=SAMPLE, seed=17)
    # the rollup's grand total (no hash) comes back beside the largest keys, in one pass
    counts = sampled.rollup("h").agg(F.count("*").alias("n"))
    top = counts.orderBy(F.col("n").desc()).limit(1 + int(1 / HOT_SHARE)).collect()
    total = max((r["n"] for r in top if r["h"] is None), default=0)
    return [r["h"] for r in top if r["h"] is not None and r["n"] >= MIN_HITS and r["n"] > HOT_SHARE * total]


def salted_join(big, small, keys, how="inner", spread_by=None, salts=SALTS):
    """Equi join whose hot keys are spread over ``salts`` tasks.

    Rows of ``big`` under a hot key get a salt from a hash of ``spread_by`` (all
    columns when not given); the matching rows of ``small`` are repeated once per
    salt. All other rows join as usual. Only joins that keep or drop rows of
    ``big`` stay right under a salt.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"a salted join cannot be {how}")
    hot = hot_hashes(big, keys)
    if not hot:
        return big.join(small, keys, how)
    is_hot = F.xxhash64(*keys).isin(hot)
    spread = F.pmod(F.xxhash64(*(spread_by or big.columns)), F.lit(salts)).cast("int")
    left = big.withColumn("_salt", F.when(is_hot, spread).otherwise(0))
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    right = small.withColumn("_salt", F.explode(F.when(is_hot, every).otherwise(F.array(F.lit(0)))))
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


def reference_join(big, small, keys, how="inner", spread_by=None, limit=BROADCAST_ROWS, derived=None):
    """Join a fact to a reference table: broadcast when it fits, salted when not.

    ``derived`` labels a small side that is itself the result of an aggregation; it
    is computed once into the shared folder instead of once to measure and once to
    join.
    """
    if derived:
        small = materialize(small, derived)
    if fits(small, limit):
        return big.join(F.broadcast(small), keys, how)
    return salted_join(big, small, keys, how, spread_by)
