"""Unigram Viterbi segmentation over a double-array trie of pieces, and its decoding."""

import math
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece

from stewardry.llm.common import binary, bound_batches, slices

MARK = "▁"
# Natural-log penalty of a character that only bytes can spell, below the rarest piece.
FALLBACK_PENALTY = 10.0
# Bytes of distinct units that are segmented together; a longer unit than LONG_UNIT goes alone.
SEGMENT_BYTES, LONG_UNIT = 1 << 17, 256
# Bytes of a character by its first one.
_WIDTHS = np.repeat(np.array([1, 2, 3, 4], np.int32), [0xC0, 0x20, 0x10, 0x10])


def load_pieces(path):
    """(piece bytes, id, log score) of the ordinary pieces, and the ids of the 256 bytes.

    The public vocabulary file ranks its pieces but holds no probabilities, and nothing
    is trained here; so a piece of rank r gets the Zipf log-probability -ln r - ln H.
    """
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    kept, byte_ids = [], {}
    for i in range(model.get_piece_size()):
        text = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(text[3:5], 16)] = i
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            kept.append((model.get_score(i), i, text))
    kept.sort(key=lambda x: (-x[0], x[1]))
    norm = math.log(sum(1 / r for r in range(1, len(kept) + 1)))
    pieces = [(t.encode(), i, -math.log(r) - norm) for r, (_, i, t) in enumerate(kept, 1)]
    return pieces, [byte_ids[b] for b in range(256)]


class DoubleArray:
    """A trie in two arrays: a child by byte c of state s is t = base[s] + c + 1, if check[t] == s."""

    def __init__(self, keys):
        """keys: sorted byte strings; ``leaf[t]`` is the key's position or -1."""
        self.base, self.check, self.leaf = [0], [-1], [-1]
        # the root's children own the first 257 slots; so any later slot suits any byte
        self._free, self._roomy = 257, 257
        pending = [(0, 0, len(keys), 0)]
        while pending:
            state, start, end, depth = pending.pop()
            if len(keys[start]) == depth:
                self.leaf[state] = start
                start += 1
            spans = []
            while start < end:
                c, stop = keys[start][depth], start + 1
                while stop < end and keys[stop][depth] == c:
                    stop += 1
                spans.append((c + 1, start, stop))
                start = stop
            if not spans:
                continue
            base = self._place([c for c, _, _ in spans])
            self.base[state] = base
            for c, a, b in spans:
                self.check[base + c] = state
                pending.append((base + c, a, b, depth + 1))

    def _grow(self, size):
        more = size - len(self.check)
        if more > 0:
            self.base += [0] * more
            self.check += [-1] * more
            self.leaf += [-1] * more

    def _place(self, codes):
        """A base whose slots for all codes are free. Only children fill holes from the left;
        families start where the last long search ended, so that building stays linear."""
        check = self.check
        while self._free < len(check) and check[self._free] != -1:
            self._free += 1
        start = self._free if len(codes) == 1 else max(self._roomy, self._free)
        base = first = start - codes[0] if self.base[0] or len(check) > 257 else 0
        while True:
            self._grow(base + 258)
            if all(check[base + c] == -1 for c in codes):
                if base - first > 32 and len(codes) > 1:
                    self._roomy = base
                return base
            base += 1


class Pieces:
    """A vocabulary ready to segment; picklable, of the vocabulary's size."""

    def __init__(self, pieces, byte_ids):
        pieces = sorted(pieces)
        trie = DoubleArray([p for p, _, _ in pieces])
        self.base, self.check = np.array(trie.base, np.int32), np.array(trie.check, np.int32)
        self.leaf = np.array(trie.leaf, np.int32)
        self.ids = [i for _, i, _ in pieces]
        self.scores = [s for _, _, s in pieces]
        self.byte_ids = byte_ids
        self.fallback = min(self.scores, default=0.0) - FALLBACK_PENALTY
        self.spelling = {i: p.replace(MARK.encode(), b" ") for p, i, _ in pieces}
        self.spelling.update({i: bytes([b]) for b, i in enumerate(byte_ids)})
        texts = [p.decode() for p, _, _ in pieces]
        # no piece holds a mark after another character, nor a line feed next to one: then
        # the best path of a text is the concatenation of the best paths of its units
        self.by_word = not any(MARK in t.lstrip(MARK) for t in texts)
        self.by_line = not any("\n" in t for t in texts)

    def units(self, text):
        if not self.by_word:
            return [text] if text else []
        if self.by_line:
            return re.findall(f"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n", text)
        return re.findall(f"{MARK}+[^{MARK}]*|[^{MARK}]+", text)


class Segmenter:
    def __init__(self, pieces):
        self.pieces = pieces
        self.base, self.check, self.leaf = (x.tolist() for x in (pieces.base, pieces.check, pieces.leaf))
        self.ids = np.array(pieces.ids, np.int32)
        self.byte_ids = np.array(pieces.byte_ids, np.int32)
        # the last score is that of a character spelt in bytes, whose edge is named -1
        self.scores = np.array([*pieces.scores, pieces.fallback])
        self._spell = pieces.spelling

    def viterbi(self, data):
        """Ids of the path with the largest sum of scores; of equal paths that of the longer last piece."""
        base, check, leaf = self.base, self.check, self.leaf
        ids, scores, states = self.pieces.ids, self.pieces.scores, len(self.check)
        n = len(data)
        best = [-math.inf] * (n + 1)
        back = [None] * (n + 1)
        best[0] = 0.0
        for i in range(n):
            here = best[i]
            if here == -math.inf:
                continue
            lead = data[i]
            width = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
            state, j, single = 0, i, False
            while j < n:
                t = base[state] + data[j] + 1
                if t >= states or check[t] != state:
                    break
                state, j = t, j + 1
                k = leaf[state]
                if k >= 0:
                    single |= j == i + width
                    if here + scores[k] > best[j]:
                        best[j], back[j] = here + scores[k], (i, ids[k])
            if not single and here + self.pieces.fallback > best[i + width]:
                best[i + width], back[i + width] = here + self.pieces.fallback, (i, None)
        path, end = [], n
        while end:
            start, piece = back[end]
            if piece is None:
                path.extend(self.pieces.byte_ids[b] for b in reversed(data[start:end]))
            else:
                path.append(piece)
            end = start
        return path[::-1]

    def _edges(self, codes, data, starts):
        """(place, length, piece) of all pieces at the characters ``starts``, by length; -1 spells a character in bytes."""
        base, check, leaf = self.pieces.base, self.pieces.check, self.pieces.leaf
        width = _WIDTHS[data]
        single = np.zeros(len(data), bool)
        at, state, size, found = starts, np.zeros(len(starts), np.int32), 0, []
        while len(at):
            t = base[state] + codes[at + size]
            go = np.flatnonzero(check[t] == state)
            at, state, size = at[go], t[go], size + 1
            piece = leaf[state]
            hit = np.flatnonzero(piece >= 0)
            first = at[hit]
            found.append((first, np.full(len(hit), size, np.int32), piece[hit]))
            if size <= 4:
                single[first[width[first] == size]] = True
        spelt = starts[~single[starts]]
        found.append((spelt, width[spelt], np.full(len(spelt), -1, np.int32)))
        return [np.concatenate(x) for x in zip(*found)]

    def _paths(self, words):
        """(ids, number of ids of each) of words, UTF-8 bytes that are not empty.

        :meth:`viterbi` for many words at once: step k takes the edges that start at byte k of any word. No two
        of them end at the same place, and the steps go in the order of the single form, so ties fall alike.
        """
        # each word has one place more than bytes, its end, whose code no piece goes on with
        data = np.frombuffer(b"\0".join([*words, b""]), np.uint8)
        size = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(size + 1) - 1
        starts = ends - size
        codes = data.astype(np.int32) + 1
        codes[ends] = 257
        within = np.arange(len(data)) - np.repeat(starts, size + 1)
        out = np.full(len(data), -1, np.int32)
        firsts = (data & 0xC0) != 0x80
        firsts[ends] = False
        short = size <= LONG_UNIT
        for w in np.flatnonzero(~short):
            path = self.viterbi(words[w])
            out[starts[w] :][: len(path)] = path
            firsts[starts[w] : ends[w]] = False
        at, long, piece = self._edges(codes, data, np.flatnonzero(firsts))
        order = np.argsort(within[at].astype(np.uint16), kind="stable")
        at, long, piece = at[order], long[order], piece[order]
        after, score = at + long, self.scores[piece]
        best, back = np.full(len(data), -np.inf), np.zeros(len(data), np.int64)
        best[starts] = 0.0
        steps = np.cumsum(np.bincount(within[at], minlength=1)).tolist()
        for a, z in zip([0, *steps], steps):
            sums, places = best[at[a:z]] + score[a:z], after[a:z]
            better = np.flatnonzero(sums > best[places])
            places = places[better]
            best[places], back[places] = sums[better], better + a
        place = ends[short]
        while len(place):
            edge = back[place]
            place, chosen = at[edge], piece[edge]
            spelt = np.flatnonzero(chosen < 0)
            out[place] = self.ids[chosen]
            for k in range(4):
                byte = place[spelt[long[edge[spelt]] > k]] + k
                out[byte] = self.byte_ids[data[byte]]
            place = place[within[place] > 0]
        return out[out >= 0], np.add.reduceat(out >= 0, starts, dtype=np.int64)

    def _units(self, data, starts):
        """Where the units of texts start that lie end to end from ``starts``, each behind a blank."""
        begin = np.zeros(len(data) + 3, bool)
        begin[starts] = True
        blank, line = data == 0x20, data == 0x0A
        if self.pieces.by_word:
            begin[: len(data)] |= blank
            begin[1 : len(data)] &= ~(blank[1:] & blank[:-1])
            if self.pieces.by_line:
                begin[: len(data)] |= line
                begin[1 : len(data) + 1] |= line
        begin[starts] = True
        a, b, c = MARK.encode()
        marks = np.flatnonzero((data[:-2] == a) & (data[1:-1] == b) & (data[2:] == c))
        begin[marks] = begin[marks + 3] = True
        return np.flatnonzero(begin[: len(data)])

    def encode_all(self, texts):
        """(int32 ids, ends of each text's ids) of a list of UTF-8 bytes or None. Blanks become marks, one mark goes first;
        a mark of the text itself is spelt in bytes. Equal units are segmented once a call."""
        size = np.array([len(t) + 1 if t else 0 for t in texts], np.int64)
        data = np.frombuffer(b"".join(b" " + t for t in texts if t), np.uint8)
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        stops = np.cumsum(size)
        first = self._units(data, (stops - size)[size > 0])
        bounds = pa.py_buffer(np.append(first, len(data)).astype(np.int64))
        units = pa.Array.from_buffers(pa.large_binary(), len(first), [None, bounds, pa.py_buffer(data)])
        coded = units.dictionary_encode()
        which, distinct = coded.indices.to_numpy(), coded.dictionary
        marked = pc.replace_substring(distinct, b" ", MARK.encode())
        ends = np.cumsum(pc.binary_length(marked).to_numpy())
        found = [self._paths(marked.slice(a, z - a).to_pylist()) for a, z in _runs(ends, SEGMENT_BYTES)]
        ids, n_ids = (np.concatenate(x) for x in zip(*found))
        from_ = np.cumsum(n_ids) - n_ids
        mark = pc.index(distinct, pa.scalar(MARK.encode(), distinct.type)).as_py()
        if mark >= 0:
            from_[mark], n_ids[mark] = len(ids), len(MARK.encode())
            ids = np.append(ids, self.byte_ids[list(MARK.encode())])
        long = n_ids[which]
        upto = np.concatenate([[0], np.cumsum(long)])
        places = np.arange(upto[-1]) + np.repeat(from_[which] - upto[:-1], long)
        return ids[places], upto[np.searchsorted(first, stops)]

    def encode(self, text):
        """int32 ids of one text as bytes."""
        return self.encode_all([text.encode() if text else None])[0].tobytes()

    def decode(self, ids):
        """The text of a list of ids: marks are blanks, the first one goes; broken UTF-8 is replaced."""
        data = b"".join(map(self._spell.__getitem__, ids))
        return data.removeprefix(b" ").decode("utf-8", "replace")


def _runs(ends, size):
    """Runs (from, to) of items with the given running ends, each of at most ``size`` or one item."""
    start = 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + size, "right")))
        yield start, stop
        start = stop


_segmenters = {}


def _segmenter(shared):
    """One segmenter per Python worker and vocabulary."""
    key = hash((tuple(shared.ids[:64]), len(shared.ids), tuple(shared.byte_ids[:4])))
    if key not in _segmenters:
        _segmenters.clear()
        _segmenters[key] = Segmenter(shared)
    return _segmenters[key]


def encode_pieces(docs, path, text="text", doc_id="doc_id"):
    """(doc_id, ids, n_pieces, n_bytes, decoded): pieces of every whole text, and the text read back from them.

    ``n_bytes`` counts byte pieces. Null and empty texts have no pieces and decode to the
    empty text. Rows keep their number; null and repeated ids stay as they are. No shuffle; what
    travels is the vocabulary, whose size does not follow the data.
    """
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(Pieces(*load_pieces(path)))

    def run(batches):
        tool = _segmenter(shared.value)
        spells = np.zeros(max(shared.value.spelling) + 1, bool)
        spells[shared.value.byte_ids] = True
        for batch in slices(batches, 1):
            ids, ends = tool.encode_all(binary(batch.column(1)))
            ends = np.append(0, ends).astype(np.int32)
            is_byte = np.concatenate([[0], np.cumsum(spells[ids], dtype=np.int32)])
            decoded = [tool.decode(ids[a:b].tolist()) for a, b in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(ids)),
                    pa.array(np.diff(ends)),
                    pa.array((is_byte[ends[1:]] - is_byte[ends[:-1]]).astype(np.int32)),
                    pa.array(decoded, pa.string()),
                ],
                names=["doc_id", "ids", "n_pieces", "n_bytes", "decoded"],
            )

    id_type = dict(docs.dtypes)[doc_id]
    schema = f"doc_id {id_type}, ids array<int>, n_pieces int, n_bytes int, decoded string"
    return docs.select(doc_id, text).mapInArrow(run, schema)
