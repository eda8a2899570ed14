"""Token ids in binary shards: every document compressed alone against one shared dictionary."""

import os
import re
import struct
import zlib
from array import array
from bisect import bisect_left
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stewardry.llm.common import CACHED_LENGTH, bound_batches, shuffle_tasks, slices
from stewardry.llm.files import new_file, reader, writer
from stewardry.session import materialize, scratch_dir

MAGIC = b"IDSHARD1"
# Index at the end of a shard: null count, document count, offset of the index, magic.
TAIL = struct.Struct("<QQQ8s")
END_ID = 1
# The dictionary learns from this many documents at most, and from this many runs of so many ids of each,
# at hashed places of the whole document. It only changes the size of the files, never what is read from them.
SAMPLE_DOCS, SAMPLE_RUNS, RUN_IDS = 512, 16, 256
# Parts of words in a generation of a worker's memo.
PART_WORDS = 400_000
DICTIONARY_BYTES = 64 * 1024
LEVEL = 3


def _load(path):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class Recent:
    """A bounded memo. Past its limit it starts anew and keeps one older generation, whose entries come back with use.

    Keys over CACHED_LENGTH are not kept, so that the memo is bounded in bytes too.
    """

    def __init__(self, limit, make):
        self.limit, self.make, self.now, self.older = limit, make, {}, {}

    def all(self, keys):
        """The values of distinct keys in their order; ``make`` gives those of a list of unknown keys."""
        if len(self.now) > self.limit:
            self.now, self.older = {}, self.now
        found = list(map(self.now.get, keys))
        gaps = [k for k, value in enumerate(found) if value is None]
        unknown = []
        for k in gaps:
            found[k] = self.older.get(keys[k])
            if found[k] is None:
                unknown.append(k)
        for k, value in zip(unknown, self.make([keys[k] for k in unknown])):
            found[k] = value
        self.now.update((keys[k], found[k]) for k in gaps if len(keys[k]) <= CACHED_LENGTH)
        return found


class WordIds:
    """Ids of texts, word by word through the tokenizer.

    Right for tokenizers that never join across ASCII white space and drop it, fold case, and never
    join a letter to following ASCII punctuation. Words of Latin letters (ASCII and Latin-1, all
    composed) are then looked up in lower case and apart from their ending, and go straight
    to the tokenizer's model in its own byte letters; its other steps would hand them over the same way.
    Words are cut and put together as Arrow columns; only the distinct parts of a column of texts become
    Python objects, and those kept in the worker's memo are not tokenized again.
    """

    def __init__(self, path):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = _load(path)
        self.parts = Recent(PART_WORDS, self._of_parts)
        spell = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.letters = {c: spell(chr(c))[0][0] for c in range(0xDF, 0x100) if chr(c).isalpha()}

    def _of_parts(self, parts):
        model, found, others = self.tokenizer.model.tokenize, {}, []
        for part in parts:
            if part.isascii() and part.isalpha():
                found[part] = [token.id for token in model(part)]
            elif _PLAIN.fullmatch(part):
                found[part] = [token.id for token in model(part.translate(self.letters))]
            else:
                others.append(part)
        coded = self.tokenizer.encode_batch_fast(others, add_special_tokens=False)
        found.update((part, one.ids) for part, one in zip(others, coded))
        return [struct.pack(f"<{len(found[part])}I", *found[part]) for part in parts]

    def encode_all(self, texts):
        """The ids of each text of an Arrow column, as arrays of little-endian unsigned 32-bit integers; null is empty."""
        words = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        coded = words.flatten().dictionary_encode()
        cores, ends = _cut(coded.dictionary)
        parts = pa.concat_arrays([cores, ends]).dictionary_encode()
        ids = self.parts.all(parts.dictionary.to_numpy(zero_copy_only=False).tolist())
        ids = pa.array(ids, pa.large_binary()).take(parts.indices)
        ids = pc.binary_join_element_wise(ids[: len(cores)], ids[len(cores) :], _JOINED)
        ids = pc.binary_join(pa.ListArray.from_arrays(words.offsets, ids.take(coded.indices)), _JOINED)
        return [np.frombuffer(x, "<u4") for x in ids.to_pylist()]


# Composed Latin letters and an ending of ASCII punctuation; without "<", which may open a special token.
_LATIN = r"^(?P<core>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<end>[!-/:;=-@\[-`{-~]*)$"
_PLAIN = re.compile(r"[a-zß-öø-ÿ]+")
_JOINED = pa.scalar(b"", pa.large_binary())


def _cut(words):
    """Words of Latin letters in lower case and their endings, which may be empty; any other word as it is."""
    cores, ends = pc.extract_regex(words, _LATIN).flatten()
    return pc.coalesce(pc.utf8_lower(cores), words), pc.fill_null(ends, "")


_encoders = {}


def encoder(path):
    if path not in _encoders:
        _encoders[path] = WordIds(path)
    return _encoders[path]


def _sampled(ids):
    """All ids of a short document, runs of ids at hashed places of a long one."""
    if len(ids) <= SAMPLE_RUNS * RUN_IDS:
        return ids
    data = ids.tobytes()
    starts = [xxhash.xxh64_intdigest(data, seed=k) % (len(ids) - RUN_IDS + 1) for k in range(SAMPLE_RUNS)]
    return np.concatenate([ids[s : s + RUN_IDS] for s in sorted(starts)])


def train_dictionary(docs, tokenizer_path, text="text", doc_id="doc_id"):
    """Bytes of a dictionary trained on the serialized ids of a bounded sample; empty where there is too little to learn."""
    ids = docs.select(F.col(doc_id).alias("_i")).where("_i is not null").distinct()
    drawn = ids.orderBy(F.xxhash64("_i"), "_i").limit(SAMPLE_DOCS)
    texts = docs.select(F.col(doc_id).alias("_i"), F.col(text).alias("_t")).join(F.broadcast(drawn), "_i")
    # one text per drawn id, however often the id stands
    texts = texts.groupBy("_i").agg(F.min_by("_t", F.xxhash64("_t")).alias("_t"))

    def code(batches):
        tool = encoder(tokenizer_path)
        for b in slices(batches, 1):
            yield pa.RecordBatch.from_arrays(
                [pa.array([_sampled(x).tobytes() for x in tool.encode_all(b.column(1))], pa.binary())], names=["ids"]
            )

    samples = sorted(bytes(r[0]) for r in texts.mapInArrow(code, "ids binary").collect())
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, [s for s in samples if s]).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def _compressor(dictionary):
    if not dictionary:
        return zstandard.ZstdCompressor(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary))


def _decompressor(dictionary):
    if not dictionary:
        return zstandard.ZstdDecompressor()
    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))


class ShardWriter:
    """Header (magic, dictionary hash), one frame per document, index, tail.

    The index holds a column each of ids, frame offsets and token counts, in the order
    written; null ids come first and are counted in the tail.
    """

    def __init__(self, path, dictionary):
        self.out, self.at = writer(path), 0
        self.zip = _compressor(dictionary)
        self.ids, self.offsets, self.counts, self.nulls = array("q"), array("Q"), array("Q"), 0
        self._put(MAGIC + sha256(dictionary).digest())

    def _put(self, data):
        self.out.write(data)
        self.at += len(data)

    def add(self, doc_id, data):
        self.offsets.append(self.at)
        self.counts.append(len(data) // 4)
        self.nulls += doc_id is None
        self.ids.append(0 if doc_id is None else doc_id)
        self._put(self.zip.compress(data))

    def close(self):
        index = self.at
        self.offsets.append(index)
        for column in (self.ids, self.offsets, self.counts):
            self._put(column.tobytes())
        self._put(TAIL.pack(self.nulls, len(self.ids), index, MAGIC))
        self.out.close()


class ShardReader:
    def __init__(self, path, dictionary):
        self.file = reader(path)
        self.unzip = _decompressor(dictionary)
        head = self.file.read_at(len(MAGIC) + 32, 0)
        if head != MAGIC + sha256(dictionary).digest():
            raise ValueError(f"{path} was not written with this dictionary")
        size = self.file.size()
        self.nulls, n, index, magic = TAIL.unpack(self.file.read_at(TAIL.size, size - TAIL.size))
        if magic != MAGIC:
            raise ValueError(f"{path} is not whole")
        body = self.file.read_at(size - TAIL.size - index, index)
        self.ids, self.offsets, self.counts = array("q"), array("Q"), array("Q")
        self.ids.frombytes(body[: 8 * n])
        self.offsets.frombytes(body[8 * n : 16 * n + 8])
        self.counts.frombytes(body[16 * n + 8 :])

    def __len__(self):
        return len(self.ids)

    def ids_at(self, k):
        start, end = self.offsets[k], self.offsets[k + 1]
        return np.frombuffer(self.unzip.decompress(self.file.read_at(end - start, start)), "<u4")

    def find(self, doc_id):
        """Ids of one document without reading the others, or None."""
        k = bisect_left(self.ids, doc_id, lo=self.nulls)
        return self.ids_at(k) if k < len(self) and self.ids[k] == doc_id else None


def write_tokens(docs, tokenizer_path, folder, dictionary, end_id=END_ID, text="text", doc_id="doc_id"):
    """Shards of all documents in ascending ``doc_id``; returns their manifest (shard, path, n_docs, n_tokens, start).

    Documents are range-partitioned by id, a shard per partition, and streamed through the
    tokenizer into the file: a task holds one batch and the index of its shard. ``start`` counts
    the tokens of all shards before. Null texts are empty, null ids come first, and
    rows of one id stay together in one shard.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    end = np.array([end_id], "<u4").tobytes()

    def write(batches):
        tool, shard, path = encoder(tokenizer_path), None, None
        tokens = 0
        for b in slices(batches, 1):
            for i, ids in zip(b.column(0).to_pylist(), tool.encode_all(b.column(1))):
                if shard is None:
                    path = new_file(folder, "ids")
                    shard = ShardWriter(path, dictionary)
                data = ids.tobytes() + end
                shard.add(i, data)
                tokens += len(data) // 4
        if shard is not None:
            shard.close()
            row = [[TaskContext.get().partitionId()], [path], [len(shard.ids)], [tokens]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row[0], pa.int64()), pa.array(row[1]), pa.array(row[2], pa.int64()), pa.array(row[3], pa.int64())],
                names=["shard", "path", "n_docs", "n_tokens"],
            )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    ordered = rows.repartitionByRange(shuffle_tasks(spark), "doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    manifest = ordered.mapInArrow(write, "shard long, path string, n_docs long, n_tokens long")
    manifest = materialize(manifest, "token-manifest")
    # one row per shard, so one task orders them
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_tokens(manifest, dictionary):
    """(doc_id, start, n_tokens, ids_crc32) of every document, read back from the shards of a manifest."""

    def read(batches):
        for b in batches:
            for path, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                shard = ShardReader(path, dictionary)
                for a in range(0, len(shard), 5_000):
                    out = ([], [], [], [])
                    for k in range(a, min(a + 5_000, len(shard))):
                        ids = shard.ids_at(k)
                        values = (None if k < shard.nulls else shard.ids[k], start, len(ids), zlib.crc32(ids.tobytes()))
                        for column, v in zip(out, values):
                            column.append(v)
                        start += len(ids)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.int64()) for c in out], names=["doc_id", "start", "n_tokens", "ids_crc32"]
                    )

    n = shuffle_tasks(manifest.sparkSession)
    shards = manifest.select("path", "start").repartition(n, "path")
    return shards.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def store_tokens(docs, tokenizer_path):
    """Write, then read back: (manifest, dictionary, rows per document)."""
    bound_batches(docs.sparkSession)
    folder = scratch_dir(docs.sparkSession, "tokens")
    dictionary = train_dictionary(docs, tokenizer_path)
    manifest = materialize(write_tokens(docs, tokenizer_path, folder, dictionary), "token-starts")
    return manifest, dictionary, read_tokens(manifest, dictionary)
