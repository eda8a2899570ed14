"""Word hashes, streamed groups, block tasks and connected components shared by the operators."""

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import functions as F

from stewardry.functions.scale import fits
from stewardry.session import materialize

# Keys (a few longs each) that a broadcast may hold.
BROADCAST_KEYS = 500_000
# Edges a task holds at least in the rounds over few of them, however many partitions a shuffle has.
EDGES_PER_TASK = 50_000
# Bytes of texts that a task turns into Python objects at a time.
SLICE_BYTES = 2 << 20
# Bytes of a batch between the JVM and a Python worker.
BATCH_BYTES = 8 << 20
_BYTES_PER_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
# Entries of a per-worker word cache; it is emptied when full. Longer words are not kept, so that it is bounded in bytes too.
CACHE_WORDS, CACHED_LENGTH = 200_000, 64

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)


def mix(x):
    """A bijective scrambling of 64-bit words (the finaliser of a splitmix generator)."""
    x = x + _GOLDEN
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


class Memo(dict):
    """A bounded memo of a function of one argument, kept until its Python worker uses another one.

    Words over CACHED_LENGTH are worked out anew each time. When full it is emptied; with ``keep`` one older generation stays, whose entries come back with use.
    """

    _used = None

    def __init__(self, function, limit=CACHE_WORDS, keep=False):
        super().__init__()
        self.function, self.limit, self.keep, self.older = function, limit, keep, {}

    def all(self, keys):
        """The values of many keys; only the memo used last holds any, so that memos don't add up in a worker."""
        if Memo._used is not self:
            if Memo._used is not None:
                Memo._used.clear()
                Memo._used.older = {}
            Memo._used = self
        return map(self.__getitem__, keys)

    def __missing__(self, key):
        if len(key) > CACHED_LENGTH:
            return self.function(key)
        if len(self) >= self.limit:
            self.older = dict(self) if self.keep else {}
            self.clear()
        value = self.older.pop(key, None)
        if value is None:
            value = self.function(key)
        self[key] = value
        return value


_word_hashes = Memo(xxhash.xxh64_intdigest)


def split_words(text):
    """Words of UTF-8 bytes: maximal runs without ASCII white space. None has no words."""
    return text.split() if text else []


def hash_words(words):
    return np.fromiter(_word_hashes.all(words), np.uint64, len(words))


def binary(column):
    """A string column of an Arrow batch as a list of UTF-8 bytes."""
    return column.cast(pa.binary()).to_pylist()


def slices(batches, column):
    """The batches cut so that no cut holds more than SLICE_BYTES of the texts in ``column``, or one text."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(size)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + SLICE_BYTES, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def bound_batches(spark):
    """Let no Arrow batch pass BATCH_BYTES, however long its texts are, unless the session has its own bound."""
    if spark.conf.get(_BYTES_PER_BATCH, None) in (None, str(2**31 - 1)):
        spark.conf.set(_BYTES_PER_BATCH, str(BATCH_BYTES))


def shuffle_tasks(spark):
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# --- wide rows against narrow keys ------------------------------------------------


def few_rows(rows, side, keys):
    """``rows`` without those that ``side`` does not name, where the keys are few enough to send; else all of them.

    For use before an inner join with ``side``, so that rows without a partner are not shuffled.
    """
    names = side.select(*keys).distinct()
    return rows.join(F.broadcast(names), keys, "left_semi") if fits(names, BROADCAST_KEYS) else rows


def split_rows(rows, side, keys):
    """[rows that ``side`` may name] or [rows that it names, the others], which are read apart and need no shuffle."""
    names = side.select(*keys).distinct()
    if not fits(names, BROADCAST_KEYS):
        return [rows]
    names = F.broadcast(names)
    return [rows.join(names, keys, "left_semi"), rows.join(names, keys, "left_anti")]


# Segments of a filter of keys, 64 KB each, so that it is 32 MB however many keys it holds.
FILTER_SEGMENTS, SEGMENT_BYTES = 512, 1 << 16
_FILTER_HASHES = 4


def quoted(name):
    """A column name that may hold dots or quotes."""
    return f"`{name.replace('`', '``')}`"


def _filter_places(h):
    """Byte and bit in its segment of each of a hash's bits; all lie in one block of 512 bits."""
    block = (h >> np.uint64(45)) & np.uint64(1023)
    for k in range(_FILTER_HASHES):
        bit = (h >> np.uint64(9 * k)) & np.uint64(511)
        yield block * np.uint64(64) + (bit >> np.uint64(3)), np.uint8(1) << (bit & np.uint64(7)).astype(np.uint8)


def _fill_segments(batches):
    for table, bounds in whole_groups(batches, ["segment"]):
        h, segment = table.column("h").to_numpy().view(np.uint64), table.column("segment").to_numpy()
        for s, e in zip(bounds[:-1], bounds[1:]):
            bits = np.zeros(SEGMENT_BYTES, np.uint8)
            for at, bit in _filter_places(h[s:e]):
                np.bitwise_or.at(bits, at.astype(np.int64), bit)
            yield pa.RecordBatch.from_pydict({"segment": [int(segment[s])], "bits": [bits.tobytes()]})


def key_filter(names, key):
    """A test of ``key`` against a broadcast Bloom filter of ``names``: no named row fails it."""
    spark = names.sparkSession
    h = F.xxhash64(key)
    rows = names.select(h.alias("h"), F.shiftrightunsigned(h, 55).alias("segment"))
    rows = rows.repartition(shuffle_tasks(spark), "segment").sortWithinPartitions("segment")
    whole = np.zeros(FILTER_SEGMENTS * SEGMENT_BYTES, np.uint8)
    for r in rows.mapInArrow(_fill_segments, "segment long, bits binary").toLocalIterator():
        whole[r["segment"] * SEGMENT_BYTES :][:SEGMENT_BYTES] = np.frombuffer(r["bits"], np.uint8)
    sent = spark.sparkContext.broadcast(whole)

    @F.pandas_udf("boolean")
    def held(hashes: pd.Series) -> pd.Series:
        x = hashes.to_numpy(np.int64).view(np.uint64)
        start = (x >> np.uint64(55)) * np.uint64(SEGMENT_BYTES)
        found = np.ones(len(x), bool)
        for at, bit in _filter_places(x):
            found &= (sent.value[(start + at).astype(np.int64)] & bit) != 0
        return pd.Series(found)

    return held(h)


def named_rows(rows, wanted, known, key):
    """(rows that ``wanted`` names, rows that ``known``, which holds all of wanted, does not name).

    Wide rows stay in place where the keys are few enough to send. Beyond that a filter of the keys, of one
    size, tells the rows that may be named; only these are shuffled.
    """
    if fits(known, BROADCAST_KEYS):
        return rows.join(F.broadcast(wanted), key, "left_semi"), rows.join(F.broadcast(known), key, "left_anti")
    maybe = key_filter(known, key) & F.col(key).isNotNull()
    suspects = rows.where(maybe)
    return suspects.join(wanted, key, "left_semi"), rows.where(~maybe).unionByName(suspects.join(known, key, "left_anti"))


# --- groups that arrive sorted ----------------------------------------------------


def _starts(table, keys):
    change = np.zeros(table.num_rows, bool)
    change[0] = True
    for key in keys:
        values = table.column(key).to_numpy()
        change[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(change)


def whole_groups(batches, keys):
    """Tables that hold whole groups only, with the bounds of their groups.

    ``batches`` are those of a partition sorted by the integer columns ``keys``. Held at
    once: one batch and one group.
    """
    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table])
        starts = _starts(table, keys)
        if len(starts) > 1:
            yield table.slice(0, starts[-1]).combine_chunks(), starts
        rest = table.slice(starts[-1])
    if rest is not None:
        yield rest.combine_chunks(), np.append(_starts(rest, keys), rest.num_rows)


def block_tasks(members, block):
    """Spread groups of any size over tasks of at most two blocks.

    ``members`` has ``grp``, ``size`` (rows of the group) and ``id``. A group is dealt into
    ``ceil(size / block)`` chunks by a hash of the id; task (i, j) gets chunks i and j, so
    every pair of members meets in exactly one task (a pair of one chunk meets in (i, i)).
    ``chunk`` is the row's own chunk.
    """
    chunks = F.ceil(F.col("size") / block).cast("int")
    members = members.withColumn("chunk", F.pmod(F.xxhash64("id"), chunks).cast("int"))
    partner = F.explode(F.sequence(F.lit(0), chunks - 1))
    return (
        members.withColumn("_p", partner)
        .withColumn("i", F.least("chunk", "_p"))
        .withColumn("j", F.greatest("chunk", "_p"))
        .drop("_p")
    )


def per_task(tasks, function, schema, keys=("grp", "i", "j")):
    """Run ``function(table, bounds)`` over streams of whole block tasks."""

    def run(batches):
        for table, bounds in whole_groups(batches, keys):
            yield from function(table, bounds)

    n = shuffle_tasks(tasks.sparkSession)
    dealt = tasks.repartition(n, *keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(run, schema)


def join_labels(linked):
    """Least index reachable from each index of a symmetric link matrix."""
    label = np.arange(len(linked))
    while True:
        least = np.minimum(label, np.where(linked, label, len(label)).min(axis=1, initial=len(label)))
        least = least[least]
        if (least == label).all():
            return label
        label = least


# --- connected components ----------------------------------------------------------


def _print(edges):
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges, label):
    """(id, component) of every id in ``edges`` (a, b); a component is its smallest id.

    Alternating large and small stars: every round joins each id to the least id it
    knows, with a map-side minimum before each shuffle, and is written to the shared
    folder. Rounds end when the edges stay the same, after about the logarithm of
    the longest chain. The minima are sent to the edges where these are few; else they are
    written first, so that both sides of the join are plain shuffles whose hubs the skew join splits.
    The tasks of a round over few edges follow their number, as the driver keeps a record of each task.
    """
    edges = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = materialize(edges.distinct(), label)
    seen = _print(edges)
    while seen[0]:
        both = edges.union(edges.select("b", "a"))
        few = seen[0] <= BROADCAST_KEYS
        n_tasks = 1 + seen[0] // EDGES_PER_TASK
        tight = lambda rows: rows.coalesce(n_tasks) if few else rows  # noqa: E731, B023
        side = lambda minima: F.broadcast(tight(minima)) if few else materialize(minima, label)  # noqa: E731, B023
        least = side(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = tight(large) if few else materialize(large, label)
        least = side(large.groupBy("a").agg(F.min("b").alias("m")))
        small = large.join(least, "a")
        small = small.select("a", F.col("m").alias("b")).union(
            small.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        )
        edges = materialize(tight(small.distinct()), label)
        now = _print(edges)
        if now == seen:
            break
        seen = now
    tops = edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).union(tops)
