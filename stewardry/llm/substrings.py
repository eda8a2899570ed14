"""Repeated passages across documents: recompression names passages, equal names are verified word by word."""

from functools import reduce

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stewardry.llm.common import binary, bound_batches, few_rows, hash_words, mix, quoted, slices, split_rows, split_words
from stewardry.session import materialize

WINDOW = 50
# Rounds of recompression whose symbols serve as anchors: the last for most windows, an
# earlier one for windows that hold no whole symbol of a later one.
LEVELS = (4, 6, 8, 9)
# Symbols whose naming read fewer words than this recur by chance; they name nothing on their own.
LEAST_WORDS = 10
# Words handled at a time.
STEP_WORDS = 200_000

_B1, _B2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_SALT = np.uint64(0xD6E8FEB86659FD93)
_FAR = np.int64(1) << 40


def _powers(base, n):
    p = np.full(n + 1, base, np.uint64)
    p[0] = 1
    return np.cumprod(p, dtype=np.uint64)


def _inverse(odd):
    x, b = 1, int(odd)
    for _ in range(6):
        x = x * (2 - b * x) & (2**64 - 1)
    return np.uint64(x)


_INVERSES = {int(b): _inverse(b) for b in (_B1, _B2)}


class Spans:
    """64-bit names of any spans of one word array, from prefix sums of a polynomial."""

    def __init__(self, words, base):
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(words * _powers(base, len(words))[:-1], dtype=np.uint64)])
        self.back = _powers(_INVERSES[int(base)], len(words))

    def of(self, start, end):
        return mix((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(np.uint64) * _SALT)


def recompress(words, doc, levels=LEVELS):
    """Symbols (name, start, end, low, high) after each of the rounds ``levels``, the last round first.

    ``words`` are word names, ``doc`` the number of each word's document (ascending). A round
    first names runs of one symbol by (symbol, length), then parts all symbols by a bit
    that this round gives their first word and names every pair left-right. Names are hashes of
    what they stand for, so every task of every executor gives one thing one name.

    [low, high) is the stretch of words that the naming has read: two documents that are equal
    there hold the same symbol there. A symbol that has read past its document's end has
    low or high far outside.
    """
    n = len(words)
    name, start = words.copy(), np.arange(n)
    end, low, high, own = start + 1, start.copy(), start + 1, doc
    after = []
    for r in range(max(levels)):
        # runs
        first = np.ones(len(name), bool)
        first[1:] = (name[1:] != name[:-1]) | (own[1:] != own[:-1])
        a = np.flatnonzero(first)
        z = np.append(a[1:], len(name))
        has_left, has_right = np.zeros(len(a), bool), np.zeros(len(a), bool)
        has_left[1:] = own[a[1:]] == own[a[1:] - 1]
        has_right[:-1] = own[z[:-1]] == own[z[:-1] - 1]
        new_low, new_high = np.minimum.reduceat(low, a), np.maximum.reduceat(high, a)
        s, e = start[a], end[z - 1]
        # the neighbour differs: one word shows it where its nearest word differs, else its whole naming
        right = np.where(has_right, z, 0) % len(name)
        left = np.where(has_left, a - 1, 0)
        one = end[a] - s
        shown = words[np.minimum(e, n - 1)] != words[s]
        high_next = np.where(shown, e + 1, high[right])
        shown = words[np.maximum(s - 1, 0)] != words[s + one - 1]
        low_next = np.where(shown, s - 1, low[left])
        new_high = np.maximum(new_high, np.where(has_right, high_next, _FAR))
        new_low = np.minimum(new_low, np.where(has_left, low_next, -_FAR))
        count = z - a
        name = np.where(count > 1, mix(name[a] + count.astype(np.uint64) * _SALT + np.uint64(2 * r + 1)), name[a])
        start, end, low, high, own = s, e, new_low, new_high, own[a]
        # pairs
        coin = mix(np.full(1, r + 1, np.uint64) * _B2)
        side = (mix(words[start] ^ coin) >> np.uint64(63)).astype(bool)
        same = own[1:] == own[:-1]
        pair = ~side[:-1] & side[1:] & same
        head, tail = np.append(pair, False), np.append(False, pair)
        next_high = np.append(np.where(same, end[:-1] + 1, _FAR), _FAR)
        last_low = np.append(-_FAR, np.where(same, low[:-1], -_FAR))
        alone_left, alone_right = ~side & ~head, side & ~tail
        named = mix(mix(name[:-1] * _B1 + np.uint64(r)) + name[1:] * _B2)
        high = np.where(alone_left, np.maximum(high, next_high), high)
        low = np.where(alone_right, np.minimum(low, last_low), low)
        at = np.flatnonzero(pair)
        name[at], end[at] = named[at], end[at + 1]
        low[at], high[at] = np.minimum(low[at], low[at + 1]), np.maximum(high[at], high[at + 1])
        stay = ~tail
        name, start, end, low, high, own = (x[stay] for x in (name, start, end, low, high, own))
        if r + 1 in levels:
            after.append((name, start, end, low, high))
    return after[::-1]


def anchors(words, doc, spans):
    """A list of (low, high, key, served): stretches that equal texts name alike, and the windows each part of them serves.

    A window is served by the symbols of the last round that lie in it with all they have read;
    where there is none, by those of the round before, and so on; where no round has
    one, by itself. All of that shows inside the window, so a window has the same
    anchors wherever it stands. The key names the words read and the symbol's place and name.
    """
    n, out = len(words), []
    bare = _windows(doc)
    for name, start, _, low, high in recompress(words, doc):
        fits = (high - low >= LEAST_WORDS) & (high - low <= WINDOW) & (low >= 0) & (high <= n)
        # of windows without a later symbol, those that start between the ends of this reach
        upto = np.concatenate([[0], np.cumsum(bare)])
        fits[fits] = upto[low[fits] + 1] > upto[np.maximum(high[fits] - WINDOW, 0)]
        name, start, low, high = name[fits], start[fits], low[fits], high[fits]
        key = mix(spans.of(low, high) ^ mix(name + (start - low).astype(np.uint64)))
        served = bare & _holding(low, high, n)
        out.append((low, high, key, served))
        bare = bare & ~served
    alone = np.flatnonzero(bare)
    out.append((alone, alone + WINDOW, spans.of(alone, alone + WINDOW), bare))
    return out


def _windows(doc):
    """Whether 50 words of one document start at each word."""
    n = len(doc)
    fit = np.zeros(n, bool)
    if n >= WINDOW:
        fit[: n - WINDOW + 1] = doc[: n - WINDOW + 1] == doc[WINDOW - 1 :]
    return fit


def _holding(low, high, n):
    """Whether the window that starts at each word holds one of the stretches."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, np.maximum(high - WINDOW, 0), 1)
    np.add.at(step, low + 1, -1)
    return np.cumsum(step)[:n] > 0


def _steps(texts):
    """Row numbers, words and document numbers of a bounded number of words at a time."""
    rows, parts, held = [], [], 0
    for i, t in enumerate(texts):
        w = hash_words(split_words(t))
        if len(w) >= WINDOW:
            rows.append(i)
            parts.append(w)
            held += len(w)
        if rows and (held >= STEP_WORDS or i + 1 == len(texts)):
            yield rows, np.concatenate(parts), np.repeat(np.arange(len(rows)), [len(p) for p in parts])
            rows, parts, held = [], [], 0
    if rows:
        yield rows, np.concatenate(parts), np.repeat(np.arange(len(rows)), [len(p) for p in parts])


def _name(batches):
    """Anchor keys of each text, with the text's first name for its document."""
    for b in slices(batches, 0):
        names = b.column(1).to_numpy()
        for rows, words, doc in _steps(binary(b.column(0))):
            found = anchors(words, doc, Spans(words, _B1))
            low, key = (np.concatenate([part[k] for part in found]) for k in (0, 2))
            text = names[np.array(rows)][doc[low]]
            pairs = np.unique(np.stack([key.view(np.int64), text], axis=1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["key", "h1"])


def _among(keys, owner, known):
    """Whether each key is in the sorted list of its document."""
    shared = np.zeros(len(keys), bool)
    order = np.argsort(owner, kind="stable")
    bounds = np.searchsorted(owner[order], np.arange(len(known) + 1))
    for k, x, z in zip(known, bounds, bounds[1:]):
        at = order[x:z]
        shared[at] = k[np.minimum(np.searchsorted(k, keys[at]), len(k) - 1)] == keys[at]
    return shared


def _compare(batches):
    """Two names of every window whose anchors are all shared."""
    for b in slices(batches, 1):
        ids, texts, keys = b.column(0).to_numpy(), b.column(3).to_numpy(), b.column(2).to_pylist()
        for rows, words, doc in _steps(binary(b.column(1))):
            spans, other = Spans(words, _B1), Spans(mix(words), _B2)
            known = [np.sort(np.array(keys[i], np.int64)) for i in rows]
            open_ = np.zeros(len(words), bool)
            for low, high, key, served in anchors(words, doc, spans):
                alone = ~_among(key.view(np.int64), doc[low], known)
                open_ |= served & ~_holding(low[alone], high[alone], len(words))
            start = np.flatnonzero(open_)
            begin = np.concatenate([[0], np.cumsum(np.bincount(doc))])
            columns = [
                ids[np.array(rows)][doc[start]],
                texts[np.array(rows)][doc[start]].astype(np.int32),
                (start - begin[doc[start]]).astype(np.int32),
                spans.of(start, start + WINDOW).view(np.int64),
                (other.of(start, start + WINDOW) >> np.uint64(32)).astype(np.uint32).view(np.int32),
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["doc_id", "t1", "pos", "w1", "w2"])


def _cut(batches):
    """Words left of each text, given the starts of its repeated windows or that all repeat."""
    for b in slices(batches, 1):
        out = ([], [], [])
        for text, starts, copy in zip(binary(b.column(1)), b.column(2), b.column(3).to_pylist()):
            words = split_words(text)
            n = len(words)
            if copy and n >= WINDOW:
                words = []
            elif starts.is_valid:
                at = starts.values.to_numpy()
                step = np.zeros(n + 1, np.int64)
                np.add.at(step, at, 1)
                np.add.at(step, at + WINDOW, -1)
                left = np.cumsum(step)[:n] == 0
                words = [w for w, keep in zip(words, left.tolist()) if keep]
            out[0].append(n)
            out[1].append(n - len(words))
            out[2].append(b" ".join(words).decode())
        columns = [b.column(0), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string())]
        names = ["doc_id", "n_words", "n_removed", "kept_text"]
        yield pa.RecordBatch.from_arrays(columns + b.columns[4:], names=names + ["row"] * (b.num_columns > 4))


def _low(name):
    """The lower 32 bits of a name, as numpy cuts them."""
    low = F.pmod(name, F.lit(1 << 32))
    return F.when(low >= 1 << 31, low - (1 << 32)).otherwise(low).cast("int")


def cut_repeats(docs, text="text", doc_id="doc_id", carry=False):
    """(doc_id, n_words, n_removed, kept_text) of every row, with ``carry`` also the ``row`` itself: words of windows that a smaller doc_id also has are gone.

    A word (a run without ASCII white space, unchanged) goes if one of the windows of 50 consecutive words
    over it also starts in a document with a smaller doc_id, as both documents were given;
    ``kept_text`` joins the others by one blank.

    Every text is named by recompression; a name that two different texts share is looked up once per
    document, and only windows all of whose names are shared are compared word by word (by two
    independent names of their 50 words, 96 bits together), with one minimum of ids per window before rows
    move. Equal texts are one text throughout: all copies but the least id lose every window at once. A name
    or window with a third of all rows is split by the adaptive skew join.

    Null, empty and short texts keep all words, and so do rows with a null id, which also take none
    from others. Rows of one id are not smaller than each other; different texts under one
    id are judged apart. Repeated rows are judged alike.
    """
    bound_batches(docs.sparkSession)
    row = F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("row")
    whole = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), *[row] * carry)
    rows = whole.select("doc_id", "text")
    signed = rows.where("doc_id is not null and text is not null")
    signed = signed.withColumn("h1", F.xxhash64("text")).withColumn("h2", F.xxhash64(F.lit("second"), "text"))
    firsts = signed.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"))
    firsts = materialize(firsts, "text-firsts")

    named = materialize(signed.select("text", "h1").mapInArrow(_name, "key long, h1 long"), "text-names")
    shared = named.groupBy("key").agg(F.min("h1").alias("a"), F.max("h1").alias("z")).where("a != z").select("key")
    # written, so that the join's two sides are plain shuffles, which the skew join can split
    shared = materialize(shared, "text-shared")
    known = named.join(shared, "key", "left_semi").groupBy("h1").agg(F.collect_set("key").alias("keys"))
    known = known.join(firsts, "h1").select(F.col("first").alias("doc_id"), "h1", "h2", "keys")
    known = materialize(known, "text-known")
    asked = few_rows(signed, known, ["doc_id"]).join(known, ["doc_id", "h1", "h2"]).select("doc_id", "text", "keys", "h1")
    windows = materialize(asked.mapInArrow(_compare, "doc_id long, t1 int, pos int, w1 long, w2 int"), "text-windows")
    least = windows.groupBy("w1", "w2").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("z")).where("a < z").drop("z")
    least = materialize(least, "text-least")
    again = windows.join(least, ["w1", "w2"]).where("doc_id > a")
    marks = materialize(again.groupBy("doc_id", "t1").agg(F.collect_set("pos").alias("starts")), "text-marks")

    copies = signed.select("doc_id", "h1", "h2").join(firsts, ["h1", "h2"])
    copies = copies.where("doc_id > first").select("doc_id", "h1", F.lit(True).alias("copy")).distinct()
    copies = materialize(copies, "text-copies")
    judged = whole.withColumn("h1", F.xxhash64("text")).withColumn("t1", _low(F.col("h1")))
    touched = materialize(copies.select("doc_id").union(marks.select("doc_id")).distinct(), "text-touched")
    parts = split_rows(judged, touched, ["doc_id"])
    parts = [
        parts[0].join(copies, ["doc_id", "h1"], "left").join(marks, ["doc_id", "t1"], "left"),
        *(p.withColumns({"copy": F.lit(None).cast("boolean"), "starts": F.lit(None).cast("array<int>")}) for p in parts[1:]),
    ]
    judged = reduce(DataFrame.unionByName, [p.select("doc_id", "text", "starts", "copy", *["row"] * carry) for p in parts])
    schema = StructType.fromDDL("doc_id long, n_words long, n_removed long, kept_text string")
    return judged.mapInArrow(_cut, StructType(schema.fields + judged.schema.fields[4:]))
