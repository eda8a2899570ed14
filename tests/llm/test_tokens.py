import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from stewardry.llm import common, pieces, token_store
from stewardry.llm.queries import QUERIES
from tests.llm.conftest import FOLDER

WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD = [(5, None), (4, ""), (3, " \n\t"), (2, "It's a <|endoftext|>x é don't"), (2, "again"), (9, "word " * 40_000), (None, "nobody"), (1, "́mark  ÀÉ 🙂")]


def expected(rows):
    tool = token_store._load(WORDS)
    out, start = [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array(tool.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_whole_texts(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    want = expected([(r["doc_id"], r["text"]) for r in docs.collect()])
    got = QUERIES["op5_token_store"](spark, FOLDER).collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_odd_texts_and_direct_access(docs_of):
    rows = [r for r in ODD if r[1] != "again"]
    manifest, dictionary, read = token_store.store_tokens(docs_of(rows), WORDS)
    assert sorted(map(tuple, read.collect()), key=str) == sorted(expected(rows), key=str)
    shards = [token_store.ShardReader(r["path"], dictionary) for r in manifest.collect()]
    tool = token_store._load(WORDS)
    (ids,) = [x for x in (s.find(2) for s in shards) if x is not None]
    assert ids.tolist() == tool.encode(rows[3][1], add_special_tokens=False).ids + [1]
    assert all(s.find(77) is None for s in shards)
    with pytest.raises(ValueError):
        token_store.ShardReader(manifest.first()["path"], dictionary + b"x")


def test_repeated_ids_and_empty(docs_of):
    docs = docs_of([(2, "b c"), (2, "a"), (2, "a"), (1, "z")])
    got = sorted(map(tuple, token_store.store_tokens(docs, WORDS)[2].select("doc_id", "start", "n_tokens").collect()))
    assert [r[0] for r in got] == [1, 2, 2, 2] and [r[1] for r in got][:2] == [0, 2]
    assert token_store.store_tokens(docs.where("false"), WORDS)[2].collect() == []


def brute(known, fallback, data):
    """Best score of any segmentation, by trying every piece at every place."""
    best = {0: 0.0}
    for end in range(1, len(data) + 1):
        found = [best[end - len(p)] + s for p, (_, s) in known.items() if end - len(p) in best and data[:end].endswith(p)]
        for width in (1, 2, 3, 4):
            char = data[max(end - width, 0) : end]
            if end - width in best and char not in known and _one_character(char):
                found.append(best[end - width] + fallback)
        if found:
            best[end] = max(found)
    return best[len(data)]


def _one_character(data):
    try:
        return len(data.decode()) == 1
    except UnicodeDecodeError:
        return False


def test_viterbi_is_optimal():
    table, byte_ids = pieces.load_pieces(PIECES)
    small = [p for k, p in enumerate(table) if k % 40 == 0 or len(p[0]) <= 3 and k % 3 == 0]
    shared = pieces.Pieces(small, byte_ids)
    tool = pieces.Segmenter(shared)
    known = {p: (i, s) for p, i, s in small}
    score = {i: s for i, s in known.values()}
    for text in ("▁the▁internationalisation", "▁▁▁été▁über", "x\ny", "梦🙂", "a"):
        data = text.encode()
        path = tool.viterbi(data)
        spelt = b"".join(next((p for p, i, _ in small if i == x), None) or bytes([byte_ids.index(x)]) for x in path)
        assert spelt == data
        total, k = 0.0, 0
        while k < len(path):
            if path[k] in score:
                total, k = total + score[path[k]], k + 1
            else:
                lead = byte_ids.index(path[k])
                total, k = total + shared.fallback, k + (1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4)
        assert total == pytest.approx(brute(known, shared.fallback, data))
        # units may be cut apart without loss
        whole = [i for u in shared.units(text) for i in tool.viterbi(u.encode())]
        assert whole == path


def test_round_trip(docs_of):
    rows = [(1, "plain  text\n\nwith ▁ marks▁"), (2, None), (3, ""), (4, " lead"), (5, "é🙂\u0000x"), (5, "twice"), (None, "nobody"), (6, "ab " * 50_000)]
    got = pieces.encode_pieces(docs_of(rows), PIECES)
    assert {(r["doc_id"], r["decoded"]) for r in got.collect()} == {(i, t or "") for i, t in rows}
    assert all(r["n_pieces"] == len(r["ids"]) and r["n_bytes"] <= r["n_pieces"] for r in got.collect())
    assert pieces.encode_pieces(docs_of(rows).where("false"), PIECES).collect() == []


def test_double_array():
    keys = sorted({bytes(np.random.default_rng(s).integers(0, 256, 1 + s % 4).astype(np.uint8)) for s in range(600)})
    trie = pieces.DoubleArray(keys)

    def find(key):
        s = 0
        for c in key:
            t = trie.base[s] + c + 1
            if t >= len(trie.check) or trie.check[t] != s:
                return -1
            s = t
        return trie.leaf[s]

    assert [find(k) for k in keys] == list(range(len(keys)))
    assert find(b"\x00\x01\x02\x03\x04") == -1


def test_ids_of_odd_words_equal_the_tokenizer():
    texts = [
        None, "", "  a  b ", "\x0b\x0c\t\r\n", "\x1fa\x1c b", "foo's bar'S don't'' it'll, x'", "word.'s a'sb !'s 's",
        "a<|endoftext|>b <|startoftext|>. foo<|endoftext|>!", "ÀÉß ÿ÷× Ångstrom éa̸. ≠ ªº µ", "İI ΣΑΣ. ς ﬁ x​.",
        "x`~^_{|}@[]\\ café'll É'S ŒUVRE", "a b a\u0085c éé", "Ciónm### sur.***, 4.5,6",
    ]
    tool = token_store.WordIds(WORDS)
    expected = [tool.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    for _ in range(2):
        assert [ids.tolist() for ids in tool.encode_all(pa.array(texts, pa.string()))] == expected


def test_only_distinct_parts_of_words_leave_the_columns(monkeypatch):
    asked, known = [], token_store.Recent.all
    monkeypatch.setattr(token_store.Recent, "all", lambda memo, keys: asked.append(sorted(keys)) or known(memo, keys))
    tool = token_store.WordIds(WORDS)
    texts = pa.array(["skipped", "Word word. WORD, <b> <b>", None, "ÉTÉ été! 4.5 word", "x" * 70], pa.string())[1:]
    expected = [tool.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts.to_pylist()]
    for _ in range(2):
        assert [ids.tolist() for ids in tool.encode_all(texts)] == expected
    assert asked == [sorted(["word", "été", "<b>", "4.5", "x" * 70, "", ".", ",", "!"])] * 2
    for empty in ([], [None], ["", " \n"]):
        assert [ids.tolist() for ids in tool.encode_all(pa.array(empty, pa.string()))] == [[]] * len(empty)


def test_a_full_memo_forgets_nothing_it_returns():
    memo = token_store.Recent(3, lambda keys: [k.upper().encode() for k in keys])
    for keys in (["a", "b"], ["c", "d", "e"], ["a", "f"], ["e", "a", "g"], []):
        assert memo.all(keys) == [k.upper().encode() for k in keys]


def test_long_words_are_not_kept():
    memo = token_store.Recent(10, lambda keys: [k.encode() for k in keys])
    words = ["x" * n for n in (1, 64, 65, 5_000)]
    for _ in range(2):
        assert memo.all(words) == [w.encode() for w in words]
    assert set(memo.now) == set(words[:2])
    calls = []
    single = common.Memo(lambda w: calls.append(w) or len(w), keep=True)
    assert [list(single.all(words)) for _ in range(2)] == [[1, 64, 65, 5_000]] * 2
    assert set(single) == set(words[:2]) and calls.count(words[0]) == 1 and calls.count(words[3]) == 2


def test_the_sample_reaches_the_end_of_a_document():
    ids = np.arange(200_000, dtype="<u4")
    drawn = token_store._sampled(ids)
    assert len(drawn) == token_store.SAMPLE_RUNS * token_store.RUN_IDS and drawn.max() > 100_000
    assert token_store._sampled(ids[:50]).tolist() == list(range(50))


def test_units_are_segmented_together_and_none_is_kept(monkeypatch):
    shared = pieces.Pieces(*pieces.load_pieces(PIECES))
    single, tool = pieces.Segmenter(shared), pieces.Segmenter(shared)
    rng = np.random.default_rng(8)
    parts = ["the ", "ing", "é", "🙂", "\n", "  ", "▁", "中", "\u0000", "q", "zx", "w" * (pieces.LONG_UNIT + 3)]
    texts = [None, "", *("".join(rng.choice(parts, 25)) for _ in range(40)), " lead", "▁", "\n\n"]
    calls = []
    monkeypatch.setattr(tool, "viterbi", lambda data: calls.append(len(data)) or single.viterbi(data))
    ids, ends = tool.encode_all([t if t is None else t.encode() for t in texts])
    spelt = [shared.byte_ids[b] for b in pieces.MARK.encode()]
    for text, a, z in zip(texts, [0, *ends], ends):
        plain = (text or "").split(pieces.MARK)
        marked = [(pieces.MARK if k == 0 and text else "") + p.replace(" ", pieces.MARK) for k, p in enumerate(plain)]
        want = []
        for k, part in enumerate(marked):
            want += (spelt if k else []) + [i for u in shared.units(part) for i in single.viterbi(u.encode())]
        assert ids[a:z].tolist() == want
        assert tool.decode(want) == (text or "")
    # only long units go one by one, and a worker holds nothing of the texts it has seen
    assert calls and min(calls) > pieces.LONG_UNIT
    assert not any(isinstance(v, dict) and v is not shared.spelling for v in vars(tool).values())
