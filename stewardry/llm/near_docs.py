"""Near duplicates of documents: BagMinHash of word shingles, banding, exact multiset overlap."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from stewardry.llm.common import (
    binary,
    block_tasks,
    bound_batches,
    components,
    few_rows,
    hash_words,
    join_labels,
    mix,
    named_rows,
    per_task,
    quoted,
    slices,
    split_words,
)
from stewardry.session import materialize

SHINGLE, SIMILARITY = 5, 0.8
# BANDS bands of ROWS registers: a pair at similarity 0.8 shares a band with probability
# 0.9986, one at 0.9 almost surely, one at 0.3 with 0.006.
BANDS, ROWS = 28, 7
REGISTERS = BANDS * ROWS
BLOCK = 1_024
# Members of a larger group are first compared with this many of its own, which join most of them.
PIVOTS = 16
# Words sketched at a time.
STEP_WORDS = 300_000

_ONE = np.uint64(1)
_LEVEL = np.uint64(0xD1B54A32D192ED03)
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def shingles(words):
    """64-bit names of the runs of five words; of a shorter text the one run of all its words."""
    if not len(words):
        return words
    width = min(SHINGLE, len(words))
    n = len(words) - width + 1
    total = np.full(n, np.uint64(width))
    for k in range(width):
        total += words[k : k + n] * _FACTORS[k]
    return mix(total)


def bag(names):
    """A multiset as a sorted set: the i-th copy of a shingle is an element of its own."""
    names = np.sort(names)
    first = np.concatenate([[True], names[1:] != names[:-1]]) if len(names) else np.zeros(0, bool)
    starts = np.flatnonzero(first)
    copy = np.arange(len(names)) - np.repeat(starts, np.diff(np.append(starts, len(names))))
    return np.sort(mix(names + copy.astype(np.uint64) * _LEVEL))


def bag_minhash(names, counts, owner, docs):
    """BagMinHash signatures (docs x REGISTERS) of weighted elements.

    Every element has one Poisson process per dyadic range of weight, [0,1), [1,2), [2,4), ...: the points
    of a range come in order of time at the range's rate and carry a register and a unit of weight;
    those above the element's own weight are passed over. A register keeps its earliest
    point, so two registers agree with the probability of the weighted Jaccard similarity. All
    elements step through their points together and stop at a time by which every
    register of the document is almost surely met; where one isn't, the time is doubled.
    """
    weight = np.bincount(owner, weights=counts, minlength=docs)
    until = (np.log(REGISTERS) + 5) / np.maximum(weight, 1)
    best = np.full(docs * REGISTERS, np.inf)
    todo = np.ones(docs, bool)
    todo[weight == 0] = False
    while todo.any():
        chosen = todo[owner]
        level, start = 0, 0
        while True:
            has = np.flatnonzero(chosen & (counts > start))
            if not len(has):
                break
            length = max(start, 1)
            _points(best, names[has], counts[has], owner[has], until, level, start, length)
            start += length
            level += 1
        todo &= np.isinf(best.reshape(docs, REGISTERS)).any(axis=1)
        until[todo] *= 2
    return mix(best.view(np.uint64).reshape(docs, REGISTERS))


def _points(best, names, counts, owner, until, level, start, length):
    state = mix(names + np.uint64((level + 1) * int(_LEVEL) & (2**64 - 1)))
    time = np.zeros(len(state))
    rate = REGISTERS * float(length)
    limit = until[owner]
    while len(state):
        state = mix(state)
        time = time - np.log1p(-(state >> np.uint64(11)).astype(np.float64) * 2.0**-53) / rate
        alive = time <= limit
        state, time, owner, limit, counts = state[alive], time[alive], owner[alive], limit[alive], counts[alive]
        place = mix(state ^ _LEVEL)
        register = ((place >> np.uint64(32)) * np.uint64(REGISTERS)) >> np.uint64(32)
        unit = start + (((place & np.uint64(0xFFFFFFFF)) * np.uint64(length)) >> np.uint64(32)).astype(np.int64)
        hit = unit < counts
        np.minimum.at(best, owner[hit] * REGISTERS + register[hit].astype(np.int64), time[hit])


def band_keys(signature):
    """One 64-bit name per band."""
    rows = signature.reshape(len(signature), BANDS, ROWS)
    key = np.repeat(mix(np.arange(BANDS, dtype=np.uint64))[None, :], len(signature), axis=0)
    for r in range(ROWS):
        key = mix(key * np.uint64(31) + rows[:, :, r])
    return key


def _sketch(texts):
    """Per text: bands (none without words) and two names of its word sequence."""
    words = [hash_words(split_words(t)) for t in texts]
    bands, names = [None] * len(texts), np.zeros((len(texts), 2), np.uint64)
    held, part = 0, []
    for i, w in enumerate(words):
        if len(w):
            place = np.arange(1, len(w) + 1, dtype=np.uint64)
            names[i] = mix(w + place * _LEVEL).sum(), mix(w ^ mix(place)).sum()
            part.append(i)
            held += len(w)
        if part and (held >= STEP_WORDS or i + 1 == len(words)):
            _sketch_part(words, part, bands)
            held, part = 0, []
    if part:
        _sketch_part(words, part, bands)
    return bands, names


def _sketch_part(words, part, bands):
    owned = []
    for at, i in enumerate(part):
        value, count = np.unique(shingles(words[i]), return_counts=True)
        owned.append((value, count, np.full(len(value), at)))
    names, counts, owner = (np.concatenate(x) for x in zip(*owned))
    for i, row in zip(part, band_keys(bag_minhash(names, counts, owner, len(part)))):
        bands[i] = row.view(np.int64)


def _sketches(batches):
    for b in slices(batches, 1):
        bands, names = _sketch(binary(b.column(1)))
        names = names.view(np.int64)
        columns = [b.column(0), pa.array(names[:, 0]), pa.array(names[:, 1]), pa.array(bands, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "h1", "h2", "bands"])


def _bags(batches):
    for b in slices(batches, 1):
        bags = [bag(shingles(hash_words(split_words(t)))).tobytes() for t in binary(b.column(1))]
        columns = [b.column(0), pa.array(bags, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["id", "bag"])


def overlaps(bags):
    """Shared elements of every two bags (sorted sets), as a matrix.

    Rare elements add one to each of their few pairs; common ones are multiplied in slabs.
    """
    n = len(bags)
    owner = np.repeat(np.arange(n), [len(b) for b in bags])
    value, column, times = np.unique(np.concatenate(bags), return_inverse=True, return_counts=True)
    shared = np.zeros((n, n), np.float32)
    order = np.argsort(column, kind="stable")
    starts = np.concatenate([[0], np.cumsum(times)])[:-1]
    flat = shared.reshape(-1)
    few = 4
    for k in range(2, few + 1):
        at = starts[times == k]
        if len(at):
            holders = owner[order[at[:, None] + np.arange(k)]]
            for x in range(k):
                for y in range(x + 1, k):
                    np.add.at(flat, holders[:, x] * n + holders[:, y], 1)
    shared += shared.T
    common = np.flatnonzero(times > few)
    for a in range(0, len(common), 4_096):
        slab = common[a : a + 4_096]
        place = np.full(len(value), -1)
        place[slab] = np.arange(len(slab))
        there = place[column]
        rows = np.flatnonzero(there >= 0)
        dense = np.zeros((n, len(slab)), np.float32)
        dense[owner[rows], there[rows]] = 1
        shared += dense @ dense.T
    return shared


def similar(bags):
    """Which two bags have a weighted Jaccard similarity of SIMILARITY or more."""
    size = np.array([len(b) for b in bags], np.float64)
    shared = overlaps(bags).astype(np.float64)
    linked = shared >= SIMILARITY * (size[:, None] + size[None, :] - shared) - 1e-9
    np.fill_diagonal(linked, False)
    return linked


def _link(table, bounds):
    ids, chunk, i, j = (table.column(c).to_numpy() for c in ("id", "chunk", "i", "j"))
    data = table.column("bag").to_pylist()
    out = ([], [])
    for a, z in zip(bounds, bounds[1:]):
        if z - a < 2:
            continue
        linked = similar([np.frombuffer(x, np.uint64) for x in data[a:z]])
        if i[a] != j[a]:
            linked &= chunk[a:z, None] != chunk[None, a:z]
        some = np.flatnonzero(linked.any(axis=1))
        out[0].append(ids[a:z][some])
        out[1].append(ids[a:z][join_labels(linked)[some]])
    if out[0]:
        columns = [pa.array(np.concatenate(c), pa.int64()) for c in out]
        yield pa.RecordBatch.from_arrays(columns, names=["a", "b"])


def _with_sizes(members):
    return members.join(members.groupBy("grp").agg(F.count("*").alias("size")), "grp")


def _links(members, texts):
    """Links inside candidate groups (id, grp, size), as forests per task; written once.

    A group of up to BLOCK members is one task. A larger one is compared with PIVOTS of its
    members first; what these do not join is then compared with the whole group, block by block.
    """
    small = members.where(F.col("size") <= BLOCK)
    links = per_task(block_tasks(small, BLOCK).join(texts, "id"), _link, "a long, b long")
    links = materialize(links, "doc-links")
    large = materialize(members.where(F.col("size") > BLOCK), "doc-large")
    if large.isEmpty():
        return links
    # about 4 * PIVOTS ids per group are looked at; the group's least id is always one
    drawn = F.collect_set(F.when(F.pmod(F.xxhash64("id"), F.col("size")) < 4 * PIVOTS, F.col("id")))
    ranked = large.groupBy("grp").agg(F.slice(F.array_sort(drawn), 1, PIVOTS).alias("p"))
    pivots = ranked.select("grp", F.explode(F.array_union(F.array("grp"), "p")).alias("id")).withColumn("pivot", F.lit(True))
    dealt = F.pmod(F.xxhash64("id"), F.ceil(F.col("size") / BLOCK)).cast("int")
    marked = large.join(pivots, ["grp", "id"], "left")
    rest = marked.where("pivot is null").select("grp", "id", dealt.alias("i"), F.lit(0).alias("j"), F.lit(1).alias("chunk"))
    every = F.explode(F.sequence(F.lit(0), F.ceil(F.col("size") / BLOCK).cast("int") - 1)).alias("i")
    asked = marked.where("pivot").select("grp", "id", every, F.lit(0).alias("j"), F.lit(1).alias("chunk"))
    # one chunk of non-pivots with all pivots per task, as if they were one block
    first = rest.unionByName(asked).withColumn("j", F.col("i"))
    joined = materialize(per_task(first.join(texts, "id"), _link, "a long, b long"), "doc-pivots")

    # what hangs together now needs no further comparison inside; the largest part of a group stays out
    parts = components(joined, "doc-parts")
    placed = large.join(parts, "id", "left").withColumn("part", F.coalesce("component", "id"))
    sizes = placed.groupBy("grp", "part").agg(F.count("*").alias("n"))
    main = sizes.groupBy("grp").agg(F.max_by("part", F.struct("n", F.col("part"))).alias("main"))
    placed = materialize(placed.join(main, "grp").select("grp", "id", "size", (F.col("part") == F.col("main")).alias("settled")), "doc-placed")
    open_ones = placed.where("not settled")
    open_sizes = open_ones.groupBy("grp").agg(F.count("*").alias("size"))
    within = block_tasks(open_ones.drop("size", "settled").join(open_sizes, "grp"), BLOCK)
    second = per_task(within.join(texts, "id"), _link, "a long, b long")
    across = _across(placed, open_sizes)
    third = per_task(across.join(texts, "id"), _link, "a long, b long")
    more = materialize(second.unionByName(third), "doc-more")
    return links.unionByName(joined).unionByName(more)


def _across(placed, open_sizes):
    """Open members against settled ones: chunk c of the open with chunk d of the settled is task (c, -1 - d)."""
    count = open_sizes.withColumnRenamed("size", "n_open").withColumn("open_chunks", F.ceil(F.col("n_open") / BLOCK).cast("int"))
    rows = placed.join(count, "grp").withColumn("chunks", F.greatest(F.lit(1), F.ceil((F.col("size") - F.col("n_open")) / BLOCK)).cast("int"))
    rows = rows.where("size > n_open")
    own = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    asked = rows.where("not settled").select("grp", "id", own("open_chunks").alias("i"), every("chunks").alias("j"), F.lit(0).alias("chunk"))
    told = rows.where("settled").select("grp", "id", every("open_chunks").alias("i"), own("chunks").alias("j"), F.lit(1).alias("chunk"))
    return asked.unionByName(told).withColumn("j", -1 - F.col("j"))


def near_documents(docs, text="text", doc_id="doc_id"):
    """(doc_id, class_id, kept, copies) of every row: classes of documents linked by similarity 0.8 or more.

    The similarity is the weighted Jaccard of the multisets of five-word runs (words: runs without
    ASCII white space, unchanged; a shorter text is one run). ``class_id`` is the smallest doc_id that
    links reach; ``kept`` marks the one row that stays: that with doc_id = class_id. ``copies``
    counts the rows with the same word sequence.

    Equal word sequences are one document from the start. Shared bands give candidate groups of
    ids alone, by one minimum per bucket; only members of such groups move their shingles, and every pair
    of a group is compared exactly inside block tasks that emit forests, not pairs. Null, empty and blank texts
    and null ids are classes of their own (a null id has a null class and stays). Repeated rows of
    one id and text are copies; of these ``kept`` marks all, see ``keep_one``. Different texts
    under one id share their links.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    bound_batches(docs.sparkSession)
    sketches = rows.where("doc_id is not null").mapInArrow(
        _sketches, "doc_id long, h1 long, h2 long, bands array<long>"
    )
    sketches = materialize(sketches, "doc-sketches")
    worded = sketches.where("bands is not null")
    same = worded.groupBy("h1", "h2").agg(F.min("doc_id").alias("id"), F.count("*").alias("copies"))
    same = materialize(same, "doc-classes")
    # bands are equal within a class, so any row of the class may speak for it
    spoken = worded.join(same, (worded.h1 == same.h1) & (worded.h2 == same.h2) & (worded.doc_id == same.id), "left_semi")
    banded = spoken.select(F.col("doc_id").alias("id"), F.explode("bands").alias("band"))
    buckets = banded.groupBy("band").agg(F.min("id").alias("b"), F.max("id").alias("most")).where("b < most").drop("most")
    buckets = materialize(buckets, "doc-buckets")
    near = banded.join(buckets, "band").where("id != b").select(F.col("id").alias("a"), "b")
    groups = components(near, "doc-groups").withColumnRenamed("component", "grp")
    members = materialize(_with_sizes(groups), "doc-members")
    wanted = members.select(F.col("id").alias("doc_id"))
    wanted = few_rows(rows, wanted, ["doc_id"]).join(wanted, "doc_id", "left_semi")
    bags = materialize(wanted.mapInArrow(_bags, "id long, bag binary").dropDuplicates(["id", "bag"]), "doc-bags")
    classes = components(_links(members, bags), "doc-near")
    of_class = same.join(classes, "id", "left").select("h1", "h2", "copies", F.coalesce("component", "id").alias("class_id"))
    found = worded.select("doc_id", "h1", "h2").join(of_class, ["h1", "h2"]).select("doc_id", "class_id", "copies")
    alone = sketches.where("bands is null").select("doc_id").unionByName(rows.where("doc_id is null").select("doc_id"))
    alone = alone.select("doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("copies"))
    found = found.unionByName(alone)
    kept = F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True))
    return found.select("doc_id", "class_id", kept.alias("kept"), "copies")


def keep_one(docs, found, text="text", doc_id="doc_id"):
    """The documents that stay: one row of each class, all columns unchanged.

    Rows without an id stay. Of several rows of a kept id the one with the least text hash stays.
    """
    of_id = found.where("doc_id is not null").groupBy(F.col("doc_id").alias(doc_id))
    odd = of_id.agg(F.max("kept").alias("stays"), F.count("*").alias("n"))
    odd = materialize(odd.where("n > 1 or not stays").select(doc_id, "stays"), "doc-odd")
    once, others = named_rows(docs, odd.where("stays").select(doc_id), odd.select(doc_id), doc_id)
    row = F.struct(*[F.col(quoted(c)) for c in docs.columns])
    once = once.groupBy(doc_id).agg(F.min_by(row, F.xxhash64(text)).alias("row"))
    return others.unionByName(once.select(*[F.col(f"row.{quoted(c)}").alias(c) for c in docs.columns]))
