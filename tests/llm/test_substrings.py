import random

import numpy as np
import pytest

from stewardry.llm import substrings as ss


def brute(rows):
    words = [(i, (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, w in words:
        if i is not None:
            for p in range(len(w) - ss.WINDOW + 1):
                g = tuple(w[p : p + ss.WINDOW])
                first[g] = min(first.get(g, i), i)
    out = []
    for i, w in words:
        gone = set()
        for p in range(len(w) - ss.WINDOW + 1 if i is not None else 0):
            if first[tuple(w[p : p + ss.WINDOW])] < i:
                gone |= set(range(p, p + ss.WINDOW))
        out.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return sorted(out, key=str)


def corpus(seed):
    rnd = random.Random(seed)
    vocab = [f"v{i}" for i in range(30)]
    text = lambda n: rnd.choices(vocab, k=n)
    passages = [text(rnd.choice([49, 50, 51, 60, 90])) for _ in range(6)] + [["a"] * 70, ["a", "b"] * 40, ["x", "y", "y"] * 25]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(rnd.randint(0, 4)):
            p = rnd.choice(passages)
            cut = rnd.randint(0, 8)
            parts += text(rnd.randint(0, 40)) + p[cut if rnd.random() < 0.3 else 0 :]
        rows.append((i, " ".join(parts)))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_all_windows(docs_of, seed):
    rows = corpus(seed)
    rows += [(100 + k, rows[k][1]) for k in range(0, 40, 3)] + [(7, rows[7][1]), (7, rows[8][1] + " " + rows[7][1])]
    rows += [(200, None), (201, ""), (202, " \t\n"), (None, rows[1][1]), (203, "é " * 120), (204, "é\n" * 110), (205, "  " * 60)]
    got = sorted(map(tuple, ss.cut_repeats(docs_of(rows)).collect()), key=str)
    assert got == brute(rows)


def test_rows_are_carried(docs_of):
    docs = docs_of([(1, "q " * 60, "s"), (2, "p " + "q " * 60, "s"), (3, None, "t")])
    got = ss.cut_repeats(docs, carry=True)
    assert got.select("row.*").columns == docs.columns
    assert {r["doc_id"]: r["kept_text"] for r in got.collect()} == {1: "q " * 59 + "q", 2: "p", 3: ""}
    assert ss.cut_repeats(docs.where("false")).collect() == []


def test_equal_stretches_are_named_alike():
    """A passage keeps its names whatever stands around it."""
    rng = np.random.default_rng(3)
    shared = rng.integers(0, 40, 80).astype(np.uint64)
    seen = []
    for k in (0, 5, 33):
        words = ss.mix(np.concatenate([rng.integers(50, 90, k).astype(np.uint64), shared, rng.integers(50, 90, 2 * k).astype(np.uint64)]))
        names = [[] for _ in range(31)]
        for low, high, key, served in ss.anchors(words, np.zeros(len(words), np.int64), ss.Spans(words, ss._B1)):
            for p in np.flatnonzero(served[k : k + 31]):
                inside = (low >= k + p) & (high <= k + p + ss.WINDOW)
                names[p] += sorted(zip((low[inside] - k).tolist(), (high[inside] - k).tolist(), key[inside].tolist()))
        seen.append(names)
    assert seen[0] == seen[1] == seen[2] and all(seen[0])
