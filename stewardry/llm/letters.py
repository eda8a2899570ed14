"""Runs of Latin letters of whole texts, and their counts over a corpus."""

from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F

from stewardry.llm.common import bound_batches, slices

# Distinct runs a task counts before it sends them on, and the longest run it keeps (longer ones go on at once).
KEPT_RUNS = 300_000
KEPT_BYTES = 64


def _table():
    table = bytearray(b" " * 256)
    for code in range(256):
        if 65 <= code <= 90:
            table[code] = code + 32
        elif 97 <= code <= 122 or code >= 0xC0:
            table[code] = code
    return bytes(table)


_LETTERS = _table()


def letter_runs(text):
    """Maximal runs of A-Z, a-z and U+00C0 to U+00FF in Latin-1 bytes, only A-Z lower-cased. None has no run."""
    return text.encode("latin-1", "replace").translate(_LETTERS).split() if text else []


def as_text(run):
    return run.decode("latin-1")


def _rows(counts):
    words = pa.array([as_text(w) for w in counts], pa.string())
    return pa.RecordBatch.from_arrays([words, pa.array(list(counts.values()), pa.int64())], names=["word", "n"])


def count_words(docs, spell=None, least=1):
    """(word, n): occurrences over all documents of what ``spell`` makes of a document's letter runs.

    ``spell(doc_id, {run: n})`` yields (word, n) pairs; without it runs are counted as they are. Words of fewer than
    ``least`` letters are left out. Counts are added up in every task first, so a frequent word is one row per task.
    """
    bound_batches(docs.sparkSession)

    def run(batches):
        counts = Counter()
        for part in slices(batches, "text"):
            for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                found = letter_runs(text)
                if spell is None:
                    counts.update(found)
                else:
                    for word, n in spell(doc_id, Counter(found)):
                        counts[word] += n
                if len(counts) >= KEPT_RUNS or found and max(map(len, found)) > KEPT_BYTES:
                    yield _rows({w: n for w, n in counts.items() if len(w) >= least})
                    counts.clear()
        yield _rows({w: n for w, n in counts.items() if len(w) >= least})

    part = docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, "word string, n long")
    return part.groupBy("word").agg(F.sum("n").alias("n"))
