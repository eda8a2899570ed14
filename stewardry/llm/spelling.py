"""Spelling variants: words one edit apart, found by Bloom-guided neighbourhoods.

Every unordered pair of near words is generated once: from the longer word by deleting a letter, or from the one whose
differing letter is smaller by putting a larger one. The edits probe blocked Bloom filters, one shard per word length;
only positives move, to an exact join with the vocabulary that removes the false ones. A filter's size follows the
vocabulary, so words are dealt into as many passes as keep each broadcast under ``PASS_BYTES``.

Nulls: a null text has no word, a null doc_id is written as nothing; repeated rows count again. Ties of the most
frequent near word go to the smallest in code-point order. Words of any length are handled in slices of their letters.
Other columns are ignored. An empty table has no word.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from stewardry.llm import letters
from stewardry.llm.common import mix, shuffle_tasks, whole_groups
from stewardry.session import materialize

# Fewest letters and occurrences of a word; how many times more frequent a form must be.
MIN_LETTERS, MIN_COUNT, RATIO = 5, 3, 2
# One (document, run) in so many loses a letter.
SHORTENED = 97
# Bits per word of a filter, bits set per word, 64-bit words of a block, blocks that one task fills.
BITS, HASHES, BLOCK_WORDS, SEGMENT = 16, 6, 8, 4_096
# Bytes of the filters that one pass broadcasts.
PASS_BYTES = 32 << 20
# Words up to this length have a shard of their own; longer ones share as many more.
SHARDS = 64
# Edits that are probed at a time.
SLICE = 1 << 19

_U = np.uint64


def shorten(doc_id, runs):
    """The spelling that the word counts are taken over: of a (document, run) whose CRC-32 ``SHORTENED`` divides, one letter goes."""
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in runs.items():
        h = zlib.crc32(run if run.isascii() else letters.as_text(run).encode(), start)
        if h % SHORTENED == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        yield run, n


def vocabulary(docs, spell=shorten):
    """(word, n) of all words of at least MIN_LETTERS letters that occur at least MIN_COUNT times."""
    return letters.count_words(docs, spell, MIN_LETTERS).where(F.col("n") >= MIN_COUNT)


# --- filters -----------------------------------------------------------------------


def shard_of(length):
    return length if length <= SHARDS else SHARDS + 1 + length % SHARDS


def _mark(position, code):
    return mix((position << _U(8)) | code)


def _finish(total, length):
    return mix(total + _U(length * 0x9E3779B97F4A7C15 % 2**64))


class Plan:
    """Where each shard's blocks lie. ``counts`` holds the words per shard; a pass has the keys whose hash it is dealt."""

    def __init__(self, counts):
        size = sum(counts.values()) * BITS // 8
        self.passes = 1 + size // PASS_BYTES
        self.blocks, self.start, at = {}, {}, 0
        for shard, n in sorted(counts.items()):
            self.blocks[shard] = 1 + n * BITS // (64 * BLOCK_WORDS * self.passes)
            self.start[shard], at = at, at + self.blocks[shard]
        self.total, self.counts = at, counts

    def place(self, keys, shard):
        """(pass, block) of each key."""
        block = ((keys >> _U(32)) * _U(self.blocks[shard])) >> _U(32)
        return mix(keys ^ _U(0x5851F42D4C957F2D)) % _U(self.passes), block + _U(self.start[shard])


def _bits(keys):
    """HASHES bit places of a block per key, one array after the other."""
    h = mix(keys)
    for k in range(HASHES):
        bit = (h >> _U(9 * k)) & _U(64 * BLOCK_WORDS - 1)
        yield bit >> _U(6), _U(1) << (bit & _U(63))


def contains(filters, blocks, keys):
    """Indices of the keys that may be in the filters."""
    left = np.arange(len(keys))
    base = blocks * _U(BLOCK_WORDS)
    for word, bit in _bits(keys):
        left = left[(filters[base[left] + word[left]] & bit[left]) != 0]
        if not len(left):
            break
    return left


# --- words as matrices -------------------------------------------------------------


def _by_length(words):
    """(indices, codes) of words of equal length, at most SLICE letters at a time."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    for length in np.unique(sizes):
        same = np.flatnonzero(sizes == length)
        step = max(1, SLICE // int(length))
        for s in range(0, len(same), step):
            part = same[s : s + step]
            yield part, np.frombuffer(b"".join(words[i] for i in part), np.uint8).reshape(len(part), int(length))


def _spans(length, width):
    """Slices of the positions of a word, so that ``width`` values per position stay within SLICE."""
    step = max(1, SLICE // width)
    return [(s, min(s + step, length)) for s in range(0, length, step)]


def _sums(codes):
    """Hash sums of whole words, and of their letters from the second on moved one place to the left."""
    m, length = codes.shape
    whole, moved = np.zeros(m, _U), np.zeros(m, _U)
    for s, e in _spans(length, m):
        part, at = codes[:, s:e].astype(_U), np.arange(s, e, dtype=_U)
        whole += _mark(at, part).sum(axis=1, dtype=_U)
        first = 1 if s == 0 else 0
        moved += _mark(at[first:] - _U(1), part[:, first:]).sum(axis=1, dtype=_U)
    return whole, moved


def word_keys(codes):
    return _finish(_sums(codes)[0], codes.shape[1])


def edits(codes, alphabet, deletes, replaces):
    """Yields (rows, positions, letters, keys, length) of the edits of a matrix of words of one length.

    A letter of -1 deletes. Of equal letters side by side only the first is deleted; a letter is replaced by larger ones only.
    """
    m, length = codes.shape
    whole, moved = _sums(codes)
    left, left_moved = np.zeros(m, _U), np.zeros(m, _U)
    for s, e in _spans(length, m * (1 + len(alphabet))):
        part, at = codes[:, s:e].astype(_U), np.arange(s, e, dtype=_U)
        marks = _mark(at, part)
        if deletes:
            shifted = _mark(at - _U(1), part)
            if s == 0:
                shifted[:, 0] = 0
            before = left[:, None] + np.cumsum(marks, axis=1, dtype=_U) - marks
            gone = left_moved[:, None] + np.cumsum(shifted, axis=1, dtype=_U)
            total = before + (moved[:, None] - gone)
            fresh = np.ones(part.shape, bool)
            fresh[:, 1:] = part[:, 1:] != part[:, :-1]
            if s:
                fresh[:, 0] = codes[:, s] != codes[:, s - 1]
            rows, where = np.nonzero(fresh)
            yield rows, where + s, np.full(len(rows), -1), _finish(total[rows, where], length - 1), length - 1
            left += marks.sum(axis=1, dtype=_U)
            left_moved += shifted.sum(axis=1, dtype=_U)
        if replaces:
            put = _mark(at[:, None], alphabet[None, :].astype(_U))
            larger = part[:, :, None] < alphabet[None, None, :]
            rows, where, which = np.nonzero(larger)
            total = whole[rows] - marks[rows, where] + put[where, which]
            yield rows, where + s, alphabet[which].astype(np.int64), _finish(total, length), length


# --- pairs -------------------------------------------------------------------------


def _encoded(column):
    return [w.encode("latin-1") for w in column.to_pylist()]


def _fill(plan, number):
    """Words to (segment, block, key), and sorted segments of those to filter pieces."""

    def keyed(batches):
        for batch in batches:
            words = _encoded(batch.column("word"))
            for _, codes in _by_length(words):
                keys = word_keys(codes)
                dealt, block = plan.place(keys, shard_of(codes.shape[1]))
                mine = dealt == number
                block, keys = block[mine].astype(np.int64), keys[mine]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block // SEGMENT), pa.array(block), pa.array(keys.view(np.int64))], names=["segment", "block", "key"]
                )

    def filled(batches):
        for table, bounds in whole_groups(batches, ["segment"]):
            for s, e in zip(bounds[:-1], bounds[1:]):
                part = table.slice(s, e - s)
                segment = part.column("segment")[0].as_py()
                block = (part.column("block").to_numpy() - segment * SEGMENT).astype(_U)
                bits = np.zeros(SEGMENT * BLOCK_WORDS, _U)
                for word, bit in _bits(part.column("key").to_numpy().view(_U)):
                    np.bitwise_or.at(bits, (block * _U(BLOCK_WORDS) + word).astype(np.int64), bit)
                yield pa.RecordBatch.from_arrays([pa.array([segment]), pa.array([bits.tobytes()], pa.binary())], names=["segment", "bits"])

    return keyed, filled


def build_filters(vocab, plan, number):
    """The filters of one pass: pieces filled by tasks, at most about PASS_BYTES together."""
    keyed, filled = _fill(plan, number)
    rows = vocab.select("word").mapInArrow(keyed, "segment long, block long, key long")
    rows = rows.repartition(shuffle_tasks(vocab.sparkSession), "segment").sortWithinPartitions("segment")
    whole = np.zeros(-(-plan.total // SEGMENT) * SEGMENT * BLOCK_WORDS, _U)
    for row in rows.mapInArrow(filled, "segment long, bits binary").toLocalIterator():
        at = row["segment"] * SEGMENT * BLOCK_WORDS
        whole[at : at + SEGMENT * BLOCK_WORDS] = np.frombuffer(row["bits"], _U)
    return whole


def _probe(vocab, plan, number, filters, alphabet):
    """(word, n, other): edits of a word that the filters of one pass may hold."""
    sent = vocab.sparkSession.sparkContext.broadcast(filters)

    def run(batches):
        held = sent.value
        for batch in batches:
            words, n = _encoded(batch.column("word")), batch.column("n").to_numpy()
            for part, codes in _by_length(words):
                length = codes.shape[1]
                same = plan.counts.get(shard_of(length), 0) > 1
                shorter = plan.counts.get(shard_of(length - 1), 0) > 0 and length > MIN_LETTERS
                own, other, count = [], [], []
                for rows, where, letter, keys, size in edits(codes, alphabet, shorter, same):
                    dealt, block = plan.place(keys, shard_of(size))
                    if plan.passes > 1:
                        mine = np.flatnonzero(dealt == number)
                        rows, where, letter, keys, block = (x[mine] for x in (rows, where, letter, keys, block))
                    for i in contains(held, block, keys).tolist():
                        word = words[part[rows[i]]]
                        put = b"" if letter[i] < 0 else bytes((int(letter[i]),))
                        own.append(letters.as_text(word))
                        other.append(letters.as_text(word[: where[i]] + put + word[where[i] + 1 :]))
                        count.append(n[part[rows[i]]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own, pa.string()), pa.array(count, pa.int64()), pa.array(other, pa.string())], names=["word", "n", "other"]
                )

    return vocab.mapInArrow(run, "word string, n long, other string")


def near_pairs(vocab):
    """(word, n, other, other_n): every unordered pair of near words of ``vocab`` (word, n, written) once."""
    spark = vocab.sparkSession
    length = F.length("word")
    shard = F.when(length <= SHARDS, length).otherwise(SHARDS + 1 + length % SHARDS)
    counts = {r["shard"]: r["n"] for r in vocab.groupBy(shard.alias("shard")).agg(F.count("*").alias("n")).collect()}
    plan = Plan(counts)
    code = F.explode(F.array_distinct(F.split("word", ""))).alias("c")
    alphabet = np.array(sorted({ord(r["c"]) for r in vocab.select(code).distinct().collect() if r["c"]}), np.int64)
    dealt = vocab.repartition(shuffle_tasks(spark), "word")
    pairs = None
    for number in range(plan.passes):
        found = _probe(dealt, plan, number, build_filters(vocab, plan, number), alphabet)
        pairs = found if pairs is None else pairs.union(found)
    return pairs.join(vocab.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other")


# --- forms -------------------------------------------------------------------------


def _roots(forms, most):
    """(word, root) of all words with a form: pointers jump, twice as far every round.

    A form is at least RATIO times as frequent as its word, which bounds the length of a chain by ``most`` occurrences.
    """
    jumps = forms.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    steps, reach = 1, MIN_COUNT * RATIO
    while reach <= most:
        reach, steps = reach * RATIO, steps + 1
    hops = 1
    while hops < steps:
        jumps = materialize(jumps, "spelling-jumps")
        further = jumps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        jumps = jumps.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
        hops *= 2
    return jumps


def group_spellings(vocab):
    """Per word of ``vocab`` (word, n): form, root, n_near, form_n.

    Two words are near if they differ by one inserted, deleted or replaced letter. ``form`` is the most frequent near
    word if it is at least RATIO times as frequent; ``root`` is the last form that is reached from word to form.
    """
    vocab = materialize(vocab, "spelling-words")
    pairs = near_pairs(vocab)
    sides = F.explode(
        F.array(
            F.struct(F.col("word"), F.col("other"), F.col("other_n").alias("n")),
            F.struct(F.col("other").alias("word"), F.col("word").alias("other"), F.col("n")),
        )
    ).alias("s")
    near = pairs.select(sides).select("s.*").groupBy("word")
    near = near.agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("n")).alias("n"), F.col("other").alias("word"))).alias("best"))
    forms = vocab.join(near, "word", "left")
    enough = -F.col("best.n") >= RATIO * F.col("n")
    forms = forms.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("best.word")).alias("form"),
        F.when(enough, -F.col("best.n")).alias("form_n"),
    )
    forms = materialize(forms, "spelling-forms")
    most = forms.agg(F.max("n")).first()[0] or 0
    found = forms.join(_roots(forms, most), "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
