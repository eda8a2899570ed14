"""As-of joins: for each record the last version that began before it, by one sort of both sides."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from stewardry.session import materialize


def asof_join(records, versions, keys, at, start, payload, largest=False):
    """``records`` with ``found``: ``payload`` of the version of the same keys with the largest ``start`` not after ``at``.

    Both sides are put in one order by keys and time, range-partitioned, so that a key with most of the records or
    versions is spread over tasks and no row holds more than one version. Inside a partition the last version is
    carried along; what came before the partition is carried in from the last version of each earlier one, a row per
    partition and key. A version without a start begins before all time; of equal starts the largest payload counts.
    Records with a null key or time find nothing. Rows and other columns stay as they are. With ``largest``, ``found``
    is the largest payload of all versions that began, not that of the last one.
    """
    fold = F.max if largest else lambda c: F.last(c, ignorenulls=True)
    kept = F.struct(*[F.col(c) for c in records.columns]).alias("_record")
    time = F.col(at).cast("timestamp_ntz")
    left = records.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], time.alias("_t"), F.lit(1).alias("_side"), kept)
    found = F.struct(*[F.col(c) for c in payload]).alias("_found")
    right = versions.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(start).cast("timestamp_ntz").alias("_t"), F.lit(0).alias("_side"), found)
    names = [f"_k{i}" for i in range(len(keys))]
    both = left.unionByName(right.where(F.expr(" and ".join(f"{n} is not null" for n in names))), allowMissingColumns=True)
    # at equal times versions come first, so that one which begins at a record's instant counts
    order = [*names, F.col("_t").asc_nulls_first(), "_side"]
    spread = F.monotonically_increasing_id()
    parts = both.withColumn("_row", spread).repartitionByRange(*order, "_row").withColumn("_part", F.spark_partition_id())
    pinned = materialize(parts, "asof-sorted")
    inside = Window.partitionBy("_part", *names).orderBy(F.col("_t").asc_nulls_first(), "_side", "_found")
    carried = pinned.withColumn("_last", fold(F.col("_found")).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    began = F.lit(True) if largest else F.struct(F.col("_t").isNotNull(), F.col("_t"))
    last = F.max(F.when(F.col("_side") == 0, F.struct(began.alias("began"), F.col("_found"))))
    tails = pinned.groupBy("_part", *names).agg(last.alias("_tail"))
    earlier = Window.partitionBy(*names).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    tails = tails.select("_part", *names, fold(F.col("_tail")["_found"]).over(earlier).alias("_before"))
    tails = materialize(tails.where("_before is not null"), "asof-tails")
    joined = carried.where("_side = 1").join(tails, ["_part", *names], "left")
    hit = F.greatest("_last", "_before") if largest else F.coalesce("_last", "_before")
    hit = F.when(F.col("_t").isNotNull(), hit)
    return joined.select("_record.*", hit.alias("found"))


def in_force_at(records, versions, keys, at, start="effective_from", until="effective_until"):
    """Each record with the version in force at its own date, NULL where none is.

    Versions of a key follow each other: the one that began last counts, and none if that one has ended.
    """
    payload = [c for c in versions.columns if c not in keys]
    joined = asof_join(records, versions, keys, at, start, payload)
    ended = F.col("found")[until].isNotNull() & (F.col(at) >= F.col("found")[until])
    return joined.withColumn("in_force", F.when(~ended, F.col("found"))).drop("found")
