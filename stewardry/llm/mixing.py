"""Mixing sources to target weights by temperature, drawn as block permutations. Native only."""

import math

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stewardry.functions.scale import reference_join
from stewardry.llm.common import quoted
from stewardry.session import materialize

# Words of one block; a source has at most MAX_BLOCKS blocks, beyond which blocks grow.
BLOCK_TOKENS = 65_536
MAX_BLOCKS = 4_096
# Halvings of the exponent's interval, done in passes of SECTIONS points each.
PASSES, SECTIONS = 4, 64
WORD = r"[^\x20\x09-\x0D]+"


def tokens_of(text):
    """Words of a text: runs without ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(*parts):
    """A reproducible 60-bit number from the text of ``parts``."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def fit_exponent(sources, budget=None, max_repeats=None, target_entropy=None):
    """The least exponent in [0, 1] that keeps both bounds; 1 where none does.

    ``sources`` has ``share``. An exponent a gives weights share^a / sum(share^a): entropy
    and repetition of the smallest source both fall as it rises. The interval is halved 24
    times, six halvings a pass: a pass evaluates its 64 points over all sources in one
    aggregate and brings 64 rows to the driver, however many sources there are.
    """
    low, high = 0.0, 1.0
    for _ in range(PASSES):
        step = (high - low) / SECTIONS
        points = [low + step * i for i in range(SECTIONS + 1)]
        a = F.explode(F.array(*map(F.lit, points))).alias("a")
        powers = sources.where("share > 0").select("share", "rest_share", a)
        power = F.pow("share", F.col("a"))
        rows = (
            powers.groupBy("a")
            .agg(
                F.sum(power).alias("z"),
                F.sum(power * F.log("share")).alias("s"),
                F.min("share").alias("least"),
                F.max("share").alias("most"),
                F.max("rest_share").alias("budget_share"),
            )
            .orderBy("a")
            .collect()
        )
        kept = [r["a"] for r in rows if _keeps(r, budget, max_repeats, target_entropy)]
        if not kept:
            return 1.0
        high = min(kept)
        low = max((p for p in points if p < high), default=high)
        if low == high:
            break
    return high


def _keeps(row, budget, max_repeats, target_entropy):
    a, z = row["a"], row["z"]
    if max_repeats is not None:
        if budget is None:
            repeats = math.pow(row["most"] / row["least"], 1 - a)
        else:
            repeats = row["budget_share"] * math.pow(row["least"], a - 1) / z
        if repeats > max_repeats:
            return False
    return target_entropy is None or math.log(z) - a * row["s"] / z <= target_entropy


def source_weights(docs, budget=None, max_repeats=None, target_entropy=None, source="source"):
    """One row per source: tokens, share, weight, quota, whole epochs, rest and blocks.

    ``budget`` counts tokens; a fraction is given as a float of all tokens. Without a
    budget the mix is the smallest one that draws every source at least once whole.
    A null source is a source of its own; one without tokens gets weight 0 and, without a
    budget and beside sources with tokens, one whole epoch.
    """
    counted = docs.select(_key(source), tokens_of("text").alias("n"))
    sources = materialize(counted.groupBy("_s").agg(F.sum("n").alias("tokens")), "mix-sources")
    total = sources.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    drawn = round(budget * total) if isinstance(budget, float) else budget
    sources = sources.withColumns(
        {
            "share": F.col("tokens") / F.lit(float(max(total, 1))),
            "rest_share": F.lit(float(drawn or 0)) / F.lit(float(max(total, 1))),
        }
    )
    a = fit_exponent(sources, drawn, max_repeats, target_entropy)
    z = sources.where("share > 0").agg(F.sum(F.pow("share", F.lit(a))), F.max("share")).first()
    z, most = z[0] or 1.0, z[1] or 1.0
    weight = F.when(F.col("share") > 0, F.round(F.pow("share", F.lit(a)) / F.lit(z), 9)).otherwise(0.0)
    if drawn is None:
        quota = F.when(
            F.col("share") > 0,
            F.greatest("tokens", F.floor(F.col("tokens") * F.round(F.pow(F.lit(most) / F.col("share"), F.lit(1 - a)), 9))),
        ).otherwise(0)
    else:
        quota = F.floor(F.lit(float(drawn)) * F.col("weight"))
    sources = sources.withColumn("weight", weight).withColumn("quota", quota.cast("long"))
    wordless = F.lit(int(drawn is None and total > 0))
    whole = F.when(F.col("tokens") > 0, F.floor(F.col("quota") / F.col("tokens"))).otherwise(wordless).cast("int")
    sources = sources.withColumn("epochs", whole)
    sources = sources.withColumn("rest", F.col("quota") - F.col("epochs") * F.col("tokens"))
    blocks = F.greatest(F.lit(1), F.least(F.lit(MAX_BLOCKS), F.ceil(F.col("tokens") / BLOCK_TOKENS))).cast("int")
    return sources.withColumn("blocks", blocks).drop("rest_share")


def _key(source):
    """Null and every name as distinct non-null keys."""
    c = F.col(source) if isinstance(source, str) else source
    return F.when(c.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), c)).alias("_s")


def mix(docs, budget=None, max_repeats=None, target_entropy=None, seed="mix", source="source", doc_id="doc_id"):
    """Rows of ``docs`` as often as the mix draws them, with ``epoch``, ``block``, ``block_key``, ``doc_key``.

    Every source is cut into hashed blocks. An epoch visits the blocks of a source in the
    order of ``block_key`` and their documents in that of ``doc_key``, both new hashes in each epoch.
    Whole epochs come first; the last one ends inside one block, at the last document
    with which the source's quota is not passed. Repeated rows share their keys and
    stay or go together.

    The row travels in one struct, so its columns may have any name; those named like a result are replaced.

    Documents are neither shuffled nor sorted: block sums and the documents of the one
    cut block per source give two thresholds per source, and a document compares its own
    keys with them. The text is read twice, once to count and once to draw.
    """
    sources = materialize(source_weights(docs, budget, max_repeats, target_entropy, source), "mix-weights")
    new = ("epoch", "block", "block_key", "doc_key")
    kept = [c for c in docs.columns if c not in new]
    keyed = docs.select(F.struct(*[F.col(quoted(c)) for c in kept]).alias("row"), _key(source), F.col(doc_id).alias("_d"))
    narrow = reference_join(
        docs.select(_key(source), F.col(doc_id).alias("_d"), tokens_of("text").alias("n")),
        sources.select("_s", "epochs", "rest", "blocks").where("quota > 0 or epochs > 0"),
        ["_s"],
        spread_by=["_d"],
    )
    block = F.pmod(uniform(F.lit(seed), F.col("_d")), F.col("blocks")).cast("int")
    block_key = uniform(F.lit(seed), F.col("epoch"), F.col("_s"), F.col("block"))
    doc_key = uniform(F.lit(seed), F.col("epoch"), F.col("_d"))
    narrow = narrow.where("rest > 0").withColumn("block", block).withColumnRenamed("epochs", "epoch")

    sums = narrow.groupBy("_s", "epoch", "block").agg(F.sum("n").alias("n"), F.first("rest").alias("rest"))
    sums = materialize(sums.withColumn("block_key", block_key), "mix-blocks")
    upto = Window.partitionBy("_s").orderBy("block_key").rangeBetween(Window.unboundedPreceding, 0)
    cuts = sums.withColumn("sofar", F.sum("n").over(upto)).where("sofar > rest")
    cuts = cuts.groupBy("_s").agg(
        F.min("block_key").alias("cut_block"),
        F.min_by(F.col("rest") - F.col("sofar") + F.col("n"), "block_key").alias("room"),
        F.min_by("block", "block_key").alias("block"),
    )
    cuts = materialize(cuts, "mix-cuts")
    inside = reference_join(narrow, cuts, ["_s", "block"], spread_by=["_d"]).withColumn("doc_key", doc_key)
    ordered = Window.partitionBy("_s").orderBy("doc_key").rangeBetween(Window.unboundedPreceding, 0)
    inside = inside.withColumn("sofar", F.sum("n").over(ordered)).where("sofar <= room")
    last = materialize(inside.groupBy("_s").agg(F.max("doc_key").alias("cut_doc")), "mix-last")

    limits = sources.where("quota > 0 or epochs > 0").join(cuts.drop("room", "block"), "_s", "left").join(last, "_s", "left")
    limits = materialize(limits.select("_s", "epochs", "rest", "blocks", "cut_block", "cut_doc"), "mix-limits")
    drawn = reference_join(keyed, limits, ["_s"], spread_by=["_d"]).withColumn("block", block)
    drawn = drawn.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("epochs"))))
    drawn = drawn.withColumns({"block_key": block_key, "doc_key": doc_key})
    in_cut = (F.col("block_key") == F.col("cut_block")) & (F.col("doc_key") <= F.col("cut_doc"))
    partial = (F.col("rest") > 0) & (F.col("cut_block").isNull() | (F.col("block_key") < F.col("cut_block")) | in_cut)
    drawn = drawn.where((F.col("epoch") < F.col("epochs")) | F.coalesce(partial, F.lit(False)))
    return drawn.select(*[F.col(f"row.{quoted(c)}").alias(c) for c in kept], *new)
