import random
from collections import Counter

import numpy as np
import pytest

from stewardry.llm import near_docs as nd


def bag_of(text):
    w = (text or "").encode().split()
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def jaccard(a, b):
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def brute(rows):
    bags = [bag_of(t) for _, t in rows]
    top = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if bags[a] and bags[b] and rows[a][0] is not None and rows[b][0] is not None and jaccard(bags[a], bags[b]) >= nd.SIMILARITY:
                ra, rb = top[a], top[b]
                top = [min(ra, rb) if x in (ra, rb) else x for x in top]
    least = {}
    for (i, _), t in zip(rows, top):
        if i is not None:
            least[t] = min(least.get(t, i), i)
    return {i: least[t] for (i, _), t in zip(rows, top) if i is not None}


def corpus(seed, n=40, size=120, copies=6):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    rows = []
    for b in range(n):
        base = rnd.choices(vocab, k=size)
        rows.append(base)
        for _ in range(copies if b % 4 == 0 else 0):
            copy = list(base)
            for _ in range(rnd.choice([0, 1, 2, 2, 3, 6])):
                copy[rnd.randrange(size)] = rnd.choice(vocab)
            rows.append(copy)
    rnd.shuffle(rows)
    return [(i, " ".join(w)) for i, w in enumerate(rows)]


ODD = [(1000, None), (1001, ""), (1002, " \n"), (1003, "a b"), (1004, "a b"), (1005, "a  b"), (1006, "a c"), (1007, "x " * 5000), (1008, "x " * 4000), (None, "a b")]


@pytest.mark.parametrize("block", [nd.BLOCK, 4])
def test_against_all_pairs(docs_of, monkeypatch, block):
    monkeypatch.setattr(nd, "BLOCK", block)
    monkeypatch.setattr(nd, "PIVOTS", 2)
    rows = corpus(5) + ODD
    found = nd.near_documents(docs_of(rows)).collect()
    assert len(found) == len(rows)
    got = {r["doc_id"]: r["class_id"] for r in found if r["doc_id"] is not None}
    assert got == brute(rows)
    assert all(r["kept"] == (r["doc_id"] == r["class_id"] or r["doc_id"] is None) for r in found)


def test_keep_one(docs_of):
    docs = docs_of([(1, "a b c d e f g"), (1, "a b c d e f g"), (2, "a b c d e f g"), (3, "z"), (None, "z"), (4, None)])
    left = nd.keep_one(docs, nd.near_documents(docs))
    assert left.columns == docs.columns
    assert sorted((str(r["doc_id"]) for r in left.collect())) == ["1", "3", "4", "None"]
    none = docs.where("false")
    assert nd.near_documents(none).collect() == [] and nd.keep_one(none, nd.near_documents(none)).collect() == []


def test_registers_agree_like_the_weighted_jaccard():
    rng = np.random.default_rng(4)
    names = rng.integers(0, 2**63, 300).astype(np.uint64)
    a, b = rng.integers(1, 9, 300), rng.integers(1, 9, 300)
    truth = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    agree = []
    for k in range(12):
        shift = nd.mix(names + np.uint64(k))
        owner = np.repeat([0, 1], 300)
        sig = nd.bag_minhash(np.concatenate([shift, shift]), np.concatenate([a, b]), owner, 2)
        agree.append((sig[0] == sig[1]).mean())
    assert np.mean(agree) == pytest.approx(truth, abs=0.03)


def test_overlaps_are_exact():
    rnd = random.Random(1)
    bags = [np.unique(np.array(rnd.choices(range(60), k=40), np.uint64)) for _ in range(30)]
    shared = nd.overlaps(bags)
    for i in range(30):
        for j in range(30):
            if i != j:
                assert shared[i, j] == len(np.intersect1d(bags[i], bags[j]))
