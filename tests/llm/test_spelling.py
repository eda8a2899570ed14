import collections
import random
import re
import zlib

import numpy as np

from stewardry.llm import letters, spelling as sp


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute(vocab):
    rows = {}
    for w, n in vocab.items():
        near = [(-vocab[o], o) for o in vocab if one_edit(w, o)]
        best = min(near, default=None)
        rows[w] = [best[1] if best and -best[0] >= 2 * n else None, n, len(near), -best[0] if best and -best[0] >= 2 * n else None]
    out = set()
    for w, (form, n, near, form_n) in rows.items():
        root = w
        while rows[root][0]:
            root = rows[root][0]
        out.add((w, form, root, n, near, form_n))
    return out


def grouped(spark, vocab):
    rows = spark.createDataFrame(list(vocab.items()), "word string, n long")
    return [(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in sp.group_spellings(rows).collect()]


def words(seed, n, letters="abcé", least=5, most=9):
    rnd = random.Random(seed)
    return {"".join(rnd.choices(letters, k=rnd.randint(least, most))): int(3 * 1.6 ** rnd.randint(0, 12)) for _ in range(n)}


def test_against_all_pairs(spark):
    vocab = words(1, 700) | words(2, 60, "aÿ", 60, 70) | {"aaaaa": 3, "aaaaaa": 6, "aaaaaaa": 12, "aaaaaaaa": 24}
    got = grouped(spark, vocab)
    assert len(got) == len(vocab) and set(got) == brute(vocab)


def test_small_slices_and_many_passes(spark, monkeypatch):
    """Slices of a few letters and filters dealt into many passes change nothing."""
    monkeypatch.setattr(sp, "PASS_BYTES", 200)
    vocab = words(3, 300)
    assert sp.Plan({5: 300}).passes > 2
    assert set(grouped(spark, vocab)) == brute(vocab)


def test_every_pair_is_generated_once():
    rnd = random.Random(4)
    for length in (5, 7, 30):
        for size in (1 << 19, 40):
            old, sp.SLICE = sp.SLICE, size
            try:
                ws = [bytes(rnd.choices(b"ab\xe9", k=length)) for _ in range(9)]
                codes = np.frombuffer(b"".join(ws), np.uint8).reshape(9, length)
                alphabet = np.frombuffer(b"ab\xe9", np.uint8).astype(np.int64)
                made = collections.Counter()
                for rows, where, letter, keys, _ in sp.edits(codes, alphabet, True, True):
                    for r, i, c, k in zip(rows.tolist(), where.tolist(), letter.tolist(), keys.tolist()):
                        w = ws[r]
                        e = w[:i] + (b"" if c < 0 else bytes((c,))) + w[i + 1 :]
                        assert sp.word_keys(np.frombuffer(e, np.uint8).reshape(1, -1))[0] == k
                        made[r, e] += 1
                expected = {(r, w[:i] + w[i + 1 :]) for r, w in enumerate(ws) for i in range(length)}
                expected |= {(r, w[:i] + bytes((c,)) + w[i + 1 :]) for r, w in enumerate(ws) for i in range(length) for c in b"ab\xe9" if c > w[i]}
                assert set(made) == expected and set(made.values()) == {1}
            finally:
                sp.SLICE = old


def test_vocabulary_of_odd_texts(spark, docs_of, monkeypatch):
    monkeypatch.setattr(letters, "KEPT_RUNS", 50)
    rnd = random.Random(6)
    base = ["Straße", "ÉCOLE", "naïve×", "word_word", "größer", "x" * 300, "Ālatin", "emoji😀words", "ab1cdefg", "ÿÿÿÿÿ÷"]
    rows = [(i % 70, " ".join(rnd.choices(base, k=30)), None) for i in range(200)] + [(None, "Straße naive " * 5, None), (7, None, None), (8, "", None)]
    counts = collections.Counter()
    for doc_id, text, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    expected = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    docs = docs_of(rows)
    assert {r["word"]: r["n"] for r in sp.vocabulary(docs).collect()} == expected
    assert sp.group_spellings(sp.vocabulary(docs.where("false"))).collect() == []


def test_filters_hold_every_word(spark):
    vocab = spark.createDataFrame(list(words(9, 500, "abcdefgh").items()), "word string, n long")
    ws = [r["word"].encode("latin-1") for r in vocab.collect()]
    plan = sp.Plan(collections.Counter(sp.shard_of(len(w)) for w in ws))
    held = sp.build_filters(vocab, plan, 0)
    for part, codes in sp._by_length(ws):
        keys = sp.word_keys(codes)
        assert len(sp.contains(held, plan.place(keys, sp.shard_of(codes.shape[1]))[1], keys)) == len(part)
