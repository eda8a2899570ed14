import collections
import hashlib
import random
import zlib

from pyspark.sql import functions as F

from stewardry.llm import prefix_trie as p

NAMES = "conv_id long, turn long, role string, text string, a string, block string, t0 int, depth int, _row string"


def ordered(rows):
    found = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            md5 = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            found[conv].append((turn is not None, turn or 0, md5, role, text))
    return {c: [t[3:] for t in sorted(turns)] for c, turns in found.items()}


def graft(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        rest = c % 5 if c >= 0 else -(-c % 5)
        out[c] = convs.get(c - rest, [])[:h] + own[h:]
    return out


def brute(convs):
    members, ends, kids = (collections.defaultdict(list) for _ in range(3))
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    leaves, saved = collections.Counter(), collections.Counter()
    for node, inside in members.items():
        own = (len(inside) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += own
            leaves[node[:d]] += node not in kids
    return sorted(
        (
            (min(inside), len(node), min(members[node[:-1]]) if node else None, len(inside), len(kids.get(node, [])), leaves[node],
             saved[node], hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest())
            for node, inside in members.items()
        ),
        key=str,
    )


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1, 2, "z") for r in rows], NAMES)


def nodes_of(df):
    names = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted((tuple(r) for r in df.select(*names).collect()), key=str)


def odd_rows():
    """Shared starts of every length, long conversations, copies, ties, nulls, empty and negative ids."""
    rnd = random.Random(5)
    text = lambda: rnd.choice(["", "ä", "yes", "no", "word " * 4, None])
    rows = [(c, t, rnd.choice(["user", "", None]), text()) for c in range(-12, 60) for t in range(rnd.randint(1, 12))]
    rows += [(c, t, "user", "same") for c in range(100, 140) for t in range(5)]
    rows += [(c, t, "user", f"long {t if t < 30 or c % 2 else c}") for c in range(200, 206) for t in range(70)]
    rows += [(300, None, "b", "null turn"), (300, None, "a", "null turn"), (300, 1, "u", "x"), (300, 1, "u", "x"), (300, 1, "a", "y")]
    rows += [(None, 1, "user", "nobody"), (2**62, 0, "user", "far"), (7_000_001, 0, "u", "one turn, donor absent")]
    rnd.shuffle(rows)
    return rows


def test_against_all_prefixes(spark):
    rows = odd_rows()
    turns, lengths = p.number_turns(table(spark, rows))
    assert nodes_of(p.prefix_trie(turns, lengths)) == brute(ordered(rows))


def test_shared_heads(spark):
    rows = odd_rows()
    conv = F.col("conv_id")
    h = F.crc32(conv.cast("string").cast("binary")) % 9
    turns, lengths = p.graft_heads(table(spark, rows), conv - conv % 5, h, 8)
    rebuilt = graft(ordered(rows))
    assert any(not t for t in rebuilt.values())
    assert {r["conv_id"]: r["n_turns"] for r in lengths.collect()} == {c: len(t) for c, t in rebuilt.items()}
    nodes = p.prefix_trie(turns, lengths)
    assert nodes_of(nodes) == brute(rebuilt)
    named = p.last_texts(nodes.where("depth = 1"), table(spark, rows)).select("conv_id", "turn_role", "turn_text").collect()
    assert {tuple(r) for r in named} == {(min(c for c, t in rebuilt.items() if t[:1] == [x]), *x) for x in {t[0] for t in rebuilt.values() if t}}


def test_one_long_conversation_over_many_tasks(spark, monkeypatch):
    """One conversation holds nearly all rows: its positions and keys are put together from pieces."""
    monkeypatch.setattr(p, "SEGMENT", 3)
    monkeypatch.setattr(p, "IDS_PER_CHUNK", 2)
    rows = [(1, t, "u", f"{t % 7}") for t in range(900)] + [(c, t, "u", f"{t % 7}") for c in range(2, 9) for t in range(100 * c % 500)]
    rows += [(c, 0, "u", "copy") for c in range(20, 40)]
    turns, lengths = p.number_turns(table(spark, rows))
    assert nodes_of(p.prefix_trie(turns, lengths)) == brute(ordered(rows))


def test_empty(spark):
    empty = table(spark, [(None, 1, "u", "x")])
    turns, lengths = p.number_turns(empty)
    assert p.prefix_trie(turns, lengths).collect() == []
    turns, lengths = p.graft_heads(empty.where("false"), F.col("conv_id"), F.lit(2), 8)
    assert p.prefix_trie(turns, lengths).collect() == []
