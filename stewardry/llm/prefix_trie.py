"""Conversation prefix trie: ROLLUP over positional turn columns, in blocks of ``BLOCK`` turns.

A turn is known by the MD5 of its role and text (two longs). Every conversation is cut into blocks of
``BLOCK`` turns, one row each, and one ROLLUP over the turn columns of a block, keyed by the node at which the
block before ended, aggregates all prefixes of all conversations together, however long they are: no round per
block. What a node needs of its subtree is a sum over its members, so the same ROLLUP gives it:

- leaves: every childless node is counted by its smallest member only;
- saved bytes: if ``shared`` of a conversation are the bytes of its turns in nodes with a smaller member, a
  node whose parent's path has P bytes saves ``shared - P`` for each member but the smallest.

Both need the smallest member of every node, which a first, narrower ROLLUP gives.

Nulls: rows without a conv_id belong to no conversation and are left out; null turn numbers come first, null
role or text is empty. Turns of equal number are ordered by the MD5 of role and text; repeated rows are
turns of their own. Other columns are ignored. An empty table has no node.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from stewardry.llm.common import shuffle_tasks
from stewardry.session import materialize

# Turns of a column block.
BLOCK = 8
# Blocks of one conversation whose running keys one task adds up.
SEGMENT = 4_096
# Ids joined in one row before a node's ids are hashed.
IDS_PER_CHUNK = 4_096
_ROW_BITS = 33

_SLOTS = [f"t{i}" for i in range(BLOCK)]


# --- numbering ---------------------------------------------------------------------


def _half(start):
    return F.conv(F.substring("_md5", start, 16), 16, -10).cast("long")


def number_turns(conversations):
    """(turns, lengths): turns (conv_id, pos from 1, a, b, n_bytes, n_turns), lengths (conv_id, n_turns).

    A range partitioning by conversation and turn spreads a conversation of any length over tasks; a position is the
    place in its partition plus the sizes of the conversation's earlier pieces. Texts are digested before anything moves.
    """
    turns, pieces, lengths = _pieces(conversations)
    pieces = pieces.join(lengths, "conv_id")
    return _place(turns, pieces).select("conv_id", "pos", "a", "b", "n_bytes", "n_turns"), lengths


def _pieces(conversations):
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)).alias("_md5"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.monotonically_increasing_id().alias("_row"),
    )
    rows = rows.select("conv_id", "turn", "_md5", "n_bytes", "_row")
    # equal rows are told apart by their place, so that not even they must share a partition
    keys = ["conv_id", F.col("turn").asc_nulls_first(), "_md5", "_row"]
    ordered = rows.repartitionByRange(shuffle_tasks(rows.sparkSession), *keys).sortWithinPartitions(*keys)
    place = F.monotonically_increasing_id()
    turns = ordered.select("conv_id", _half(1).alias("a"), _half(17).alias("b"), "n_bytes", place.alias("_place"))
    turns = materialize(turns, "trie-turns")
    turns = turns.select(
        "conv_id",
        F.shiftright("_place", _ROW_BITS).alias("part"),
        F.col("_place").bitwiseAND((1 << _ROW_BITS) - 1).alias("idx"),
        "a",
        "b",
        "n_bytes",
    )
    pieces = turns.groupBy("conv_id", "part").agg(F.min("idx").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(earlier), F.lit(0))
    pieces = pieces.select("conv_id", "part", "n", (F.col("first") - before - 1).alias("offset"))
    pieces = materialize(pieces, "trie-pieces")
    lengths = pieces.groupBy("conv_id").agg(F.sum("n").alias("n_turns"))
    return turns, pieces.drop("n"), lengths


def _place(turns, pieces):
    return turns.join(pieces, ["conv_id", "part"]).withColumn("pos", F.col("idx") - F.col("offset")).drop("idx", "offset", "part")


# --- shared heads ------------------------------------------------------------------


def graft_heads(conversations, donor, n_head, most):
    """Like ``number_turns``, but each conversation begins with turns of another one.

    ``donor`` and ``n_head`` (0 to ``most``) are expressions over ``conv_id``: the first ``n_head`` turns of
    conversation ``donor`` (all if it has fewer, none if it is absent), then the conversation's own turns
    after its first ``n_head``. A conversation left without any turn stays in ``lengths`` with 0.
    """
    turns, pieces, lengths = _pieces(conversations)
    donors = lengths.select(F.col("conv_id").alias("donor"), F.col("n_turns").alias("has"))
    plan = lengths.select("conv_id", "n_turns", donor.alias("donor"), n_head.cast("long").alias("cut"))
    plan = plan.join(donors, "donor", "left").withColumn("given", F.least("cut", F.coalesce("has", F.lit(0))))
    own = F.greatest(F.col("n_turns") - F.col("cut"), F.lit(0))
    plan = plan.select("conv_id", "donor", "cut", "given", (F.col("given") + own).alias("n_turns"))
    plan = materialize(plan, "trie-plan")
    placed = materialize(_place(turns, pieces.join(plan, "conv_id")), "trie-placed")
    turn = F.struct("pos", "a", "b", "n_bytes")
    heads = placed.where(F.col("pos") <= most).groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("head"))
    heads = heads.withColumnRenamed("conv_id", "donor")
    given = plan.where("given > 0").join(heads, "donor")
    given = given.select("conv_id", "n_turns", F.explode(F.slice("head", F.lit(1), F.col("given").cast("int"))).alias("t"))
    names = ["conv_id", "pos", "a", "b", "n_bytes", "n_turns"]
    kept = placed.where(F.col("pos") > F.col("cut")).withColumn("pos", F.col("pos") - F.col("cut") + F.col("given"))
    rebuilt = kept.select(*names).union(given.select("conv_id", "t.pos", "t.a", "t.b", "t.n_bytes", "n_turns"))
    return rebuilt, plan.select("conv_id", "n_turns")


# --- the trie ----------------------------------------------------------------------


def _mark(pos, a, b):
    """Two hashes of a turn at its position; a node's key is their bitwise sum over its path."""
    return F.xxhash64(pos, a, b), F.xxhash64(b, a, pos)


def column_blocks(turns, lengths):
    """One row per conversation and block: prior node (p1, p2), bytes before it, turns t0.., the key it ends at.

    Keys of earlier blocks are added up in segments of ``SEGMENT`` blocks, so that no task holds one long conversation.
    """
    at = turns.select(
        "*",
        F.expr(f"(pos - 1) div {BLOCK}").alias("block"),
        F.expr(f"(pos - 1) div {BLOCK * SEGMENT}").alias("segment"),
        *[m.alias(n) for m, n in zip(_mark(F.col("pos"), F.col("a"), F.col("b")), ("k1", "k2"))],
    )
    sums = [F.bit_xor("k1").alias("k1"), F.bit_xor("k2").alias("k2"), F.sum("n_bytes").alias("bytes")]
    dealt = at.repartition(shuffle_tasks(at.sparkSession), "conv_id", "segment")
    blocks = dealt.groupBy("conv_id", "segment", "block").agg(
        *sums,
        F.max("n_turns").alias("n_turns"),
        F.array_sort(F.collect_list(F.struct("pos", "a", "b", "n_bytes"))).alias("turns"),
    )
    within = Window.partitionBy("conv_id", "segment").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = at.groupBy("conv_id", "segment").agg(*sums)
    across = Window.partitionBy("conv_id").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    whole = whole.select(
        "conv_id",
        "segment",
        F.bit_xor("k1").over(across).alias("s1"),
        F.bit_xor("k2").over(across).alias("s2"),
        F.sum("bytes").over(across).alias("s_bytes"),
    ).where("segment > 0")
    zero = F.lit(0).cast("long")
    blocks = blocks.select(
        "*",
        F.coalesce(F.bit_xor("k1").over(within), zero).alias("w1"),
        F.coalesce(F.bit_xor("k2").over(within), zero).alias("w2"),
        F.coalesce(F.sum("bytes").over(within), zero).alias("w_bytes"),
    ).join(whole, ["conv_id", "segment"], "left")
    p1 = F.col("w1").bitwiseXOR(F.coalesce("s1", zero))
    p2 = F.col("w2").bitwiseXOR(F.coalesce("s2", zero))
    before = F.col("w_bytes") + F.coalesce("s_bytes", zero)
    slot = [F.get("turns", F.lit(i)) for i in range(BLOCK)]
    blocks = blocks.select(
        "conv_id",
        "block",
        p1.alias("p1"),
        p2.alias("p2"),
        before.alias("before"),
        p1.bitwiseXOR(F.col("k1")).alias("e1"),
        p2.bitwiseXOR(F.col("k2")).alias("e2"),
        (before + F.col("bytes")).alias("upto"),
        # turns in this block, one more than fit if the conversation goes on
        F.least(F.col("n_turns") - F.col("block") * BLOCK, F.lit(BLOCK + 1)).alias("ends"),
        *[F.when(s.isNotNull(), F.struct(s["a"].alias("a"), s["b"].alias("b"), s["n_bytes"].alias("n"))).alias(t) for s, t in zip(slot, _SLOTS)],
    )
    bare = lengths.where("n_turns = 0").select(
        "conv_id", *[F.lit(0).cast("long").alias(c) for c in blocks.columns[1:9]], *[F.lit(None).cast(blocks.schema[t].dataType).alias(t) for t in _SLOTS]
    )
    return materialize(blocks.union(bare), "trie-blocks")


def _rollup(blocks, sums):
    """One row per node: its key and parent's key, depth, last turn, bytes of the path before it, and ``sums`` over members."""
    names = ", ".join(_SLOTS)
    nodes = blocks.sparkSession.sql(
        f"""SELECT block, p1, p2, {names}, {BLOCK} - bit_count(grouping_id()) AS level, min(before) AS before,
                   min(conv_id) AS conv_id, max(ends) = {BLOCK} - bit_count(grouping_id()) AS childless, {sums}
            FROM {{blocks}} GROUP BY block, p1, p2, ROLLUP ({names})""",
        blocks=blocks,
    )
    filled = sum(F.col(t).isNotNull().cast("int") for t in _SLOTS)
    # conversations that end above a level have no node there; a block's own root is the node the block before ended at
    nodes = nodes.where((filled == F.col("level")) & ((F.col("level") > 0) | (F.col("block") == 0)))
    path = F.slice(F.array(*_SLOTS), F.lit(1), F.col("level").cast("int"))
    up = F.slice(path, F.lit(1), F.greatest(F.size(path) - 1, F.lit(0)))
    place = lambda i: F.col("block") * BLOCK + i + 1

    def key(turns, which, start):
        marks = F.transform(turns, lambda t, i: _mark(place(i).cast("long"), t["a"], t["b"])[which])
        return F.aggregate(marks, start, lambda x, y: x.bitwiseXOR(y))

    return nodes.select(
        (F.col("block") * BLOCK + F.col("level")).alias("depth"),
        *[key(path, i, F.col(p)).alias(k) for i, p, k in ((0, "p1", "k1"), (1, "p2", "k2"))],
        *[key(up, i, F.col(p)).alias(k) for i, p, k in ((0, "p1", "up1"), (1, "p2", "up2"))],
        (F.col("before") + F.aggregate(up, F.lit(0).cast("long"), lambda x, t: x + t["n"])).alias("above"),
        F.try_element_at(path, F.lit(-1)).alias("turn"),
        "conv_id",
        "childless",
        *[c for c in nodes.columns if c in ("n_convs", "shared", "least_shared", "leaves")],
    )


def prefix_trie(turns, lengths):
    """One row per node of the trie over ``turns`` and ``lengths`` as ``number_turns`` or ``graft_heads`` give them.

    Returns conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
    (see ``hash_ends``), and the node's last turn: turn_a, turn_b (its digest), turn_bytes.
    """
    blocks = column_blocks(turns, lengths)
    last = blocks.where(F.col("ends") <= BLOCK)
    firsts = _rollup(blocks, "count(*) AS n_convs").select("conv_id", "above", F.col("childless").cast("int").alias("leaf"))
    own = firsts.union(last.select("conv_id", "upto", F.lit(0)))
    own = own.groupBy("conv_id").agg(F.min("above").alias("own_shared"), F.max("leaf").alias("leaf"))
    own = materialize(own, "trie-conversations")
    sums = "count(*) AS n_convs, sum(own_shared) AS shared, min_by(own_shared, conv_id) AS least_shared, sum(leaf) AS leaves"
    nodes = materialize(_rollup(blocks.join(own, "conv_id"), sums), "trie-nodes")
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("k1").alias("up1"), F.col("k2").alias("up2"), F.col("conv_id").alias("parent_conv_id")
    )
    below = nodes.where("depth > 0")
    kids = below.groupBy((F.col("depth") - 1).alias("depth"), F.col("up1").alias("k1"), F.col("up2").alias("k2"))
    kids = kids.agg(F.count("*").alias("n_children"))
    # both sides are read as written, so that the skew join can split the children of one node
    named = below.join(parents, ["depth", "up1", "up2"])
    named = named.union(nodes.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long")).select(named.columns))
    named = named.join(kids, ["depth", "k1", "k2"], "left").join(hash_ends(last), ["k1", "k2"], "left")
    return named.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        F.col("leaves").cast("long").alias("n_leaves"),
        (F.col("shared") - F.col("least_shared") - (F.col("n_convs") - 1) * F.col("above")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        F.col("turn.a").alias("turn_a"),
        F.col("turn.b").alias("turn_b"),
        F.col("turn.n").alias("turn_bytes"),
    )


def last_texts(nodes, conversations):
    """``nodes`` with the role and text of their last turn (null at the root)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    md5 = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    known = conversations.select(role.alias("turn_role"), text.alias("turn_text"), md5.alias("_md5"))
    known = known.groupBy(_half(1).alias("turn_a"), _half(17).alias("turn_b"))
    known = known.agg(F.any_value("turn_role").alias("turn_role"), F.any_value("turn_text").alias("turn_text"))
    return nodes.join(known, ["turn_a", "turn_b"], "left")


# --- ids that end at a node --------------------------------------------------------


def _chunks(batches):
    """Rows sorted by node and id to rows of joined ids, at most IDS_PER_CHUNK each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        k1, k2, ids = (batch.column(c).to_numpy() for c in ("k1", "k2", "conv_id"))
        new = np.flatnonzero(np.r_[True, (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])])
        ends = np.r_[new[1:], len(ids)]
        cuts = [(s, min(s + IDS_PER_CHUNK, e)) for b, e in zip(new, ends) for s in range(b, e, IDS_PER_CHUNK)]
        starts = [s for s, _ in cuts]
        texts = [",".join(map(str, ids[s:e].tolist())) for s, e in cuts]
        yield pa.RecordBatch.from_arrays(
            [pa.array(k1[starts]), pa.array(k2[starts]), pa.array(ids[starts]), pa.array(texts, pa.string())],
            names=["k1", "k2", "first", "ids"],
        )


def _digests(batches):
    """SHA-256 of each node's chunks in order, fed as they stream by."""
    key, state = None, None
    done = []

    def flush():
        return pa.RecordBatch.from_pydict(
            {"k1": [d[0] for d in done], "k2": [d[1] for d in done], "ends_sha256": [d[2] for d in done]},
            schema=pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("ends_sha256", pa.string())]),
        )

    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("k1", "k2", "ids"))
        for a, b, ids in zip(*columns):
            if (a, b) == key:
                state.update(b",")
            else:
                if key is not None:
                    done.append((*key, state.hexdigest()))
                key, state = (a, b), hashlib.sha256()
            state.update(ids.encode())
        if done:
            yield flush()
            done = []
    if key is not None:
        done.append((*key, state.hexdigest()))
        yield flush()


def hash_ends(last):
    """(k1, k2, ends_sha256): SHA-256 of the comma-joined ids of the conversations that end at a node, ascending.

    ``last`` holds the last block of each conversation. Ids are joined in chunks where the range partitioning put them,
    so one node's ids may be spread over tasks; only its chunks, a row for some thousand ids, meet and are streamed.
    """
    ends = last.select(F.col("e1").alias("k1"), F.col("e2").alias("k2"), "conv_id")
    n, keys = shuffle_tasks(ends.sparkSession), ["k1", "k2", "conv_id"]
    chunks = ends.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    chunks = chunks.mapInArrow(_chunks, "k1 long, k2 long, first long, ids string")
    dealt = chunks.repartition(n, "k1", "k2").sortWithinPartitions("k1", "k2", "first")
    return dealt.mapInArrow(_digests, "k1 long, k2 long, ends_sha256 string")
