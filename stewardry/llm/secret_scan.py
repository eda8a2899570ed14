"""Secret scans: fixed patterns, and values in credential contexts that are costly to guess.

The cost of a value is that of its cheapest segmentation into dictionary words, dates, repeats, keyboard walks and
brute-force spans (a dynamic programme over its end positions, linear in its length). Words are ranked by how often
the corpus has them, so prose in a credential context is cheap and a random string is not.

Nulls: a null text has no span; repeated rows are scanned again. Spans count code points, the end is exclusive. Other
columns are kept beside the results by ``scan_secrets`` only as far as asked for. An empty table gives no row.
"""

import math
import re
from bisect import bisect_right
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stewardry.llm.common import binary, bound_batches, slices
from stewardry.llm.letters import count_words
from stewardry.session import materialize

# The base patterns, and the least length of what each must hold.
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{16,}")
MIN_ASSIGN, MIN_ACCESS = 12, 18
KINDS = ("assign", "access", "hex", "guess")

# Contexts of credentials: a name that holds one of these words, a separator and a value; or a URL's password.
CONTEXT_WORDS = (b"pass", b"pwd", b"secret", b"token", b"api", b"credential", b"access", b"private", b"auth")
_NAMED = re.compile(
    rb"""(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|api[_-]?key|credentials?|access[_-]?key|private[_-]?key|auth(?:orization)?)"""
    rb"""[\w-]{0,32}["'`]?[ \t]*(?::=|=>|[:=])[ \t]*(?:bearer[ ])?["'`]?([^\s"'`<>,;]{8,})""",
    re.IGNORECASE,
)
_URL = re.compile(rb"""://[^\s/:@]{1,256}:([^\s/@"'`<>]{8,})@""")
# Least cost of a secret, as the decimal logarithm of the guesses it takes.
MIN_GUESSES = 13.0

# Ranked words, their letters, and what an attacker pays for one more segment.
RANKED_WORDS, MIN_WORD, MAX_WORD = 20_000, 3, 24
SEGMENT_COST = 1.0
# Words that stand in for a secret; ranked before the corpus.
STAND_INS = (
    "password", "passwort", "secret", "token", "admin", "welcome", "changeme", "letmein", "default", "example", "sample",
    "test", "dummy", "placeholder", "your", "here", "none", "null", "true", "false", "user", "root", "login", "master",
)
_LEET = str.maketrans("@4310$57!8", "aaeiosstib")
_ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm", "abcdefghijklmnopqrstuvwxyz")
MAX_UNIT, MIN_WALK = 8, 4


def ranked_words(docs, limit=RANKED_WORDS):
    """{word: rank} of stand-ins and of the corpus's ``limit`` most frequent words, counted over all documents.

    Counts are first counted by size, eight sizes to an octave, so that only words of the sizes that reach
    the limit compete: the driver's share does not follow the number of tasks.
    """
    counts = materialize(count_words(docs, least=MIN_WORD).where(F.length("word") <= MAX_WORD), "secret-words")
    size = F.floor(F.log2("n") * 8).cast("int")
    held, least = 0, 0
    for r in counts.groupBy(size.alias("size")).agg(F.count("*").alias("n")).orderBy(F.col("size").desc()).collect():
        held, least = held + r["n"], r["size"]
        if held >= limit:
            break
    top = counts.where(size >= least).orderBy(F.col("n").desc(), "word").limit(limit).collect()
    words = [*STAND_INS, *(r["word"] for r in top)]
    ranks = {}
    for word in words:
        ranks.setdefault(word, len(ranks) + 1)
    return ranks


# --- cost of a guess ---------------------------------------------------------------


def _neighbours():
    """Keys next to each other: along a row, and from a row to the one below."""
    near = set()
    for row in _ROWS:
        near |= set(zip(row, row[1:]))
    for upper, lower in zip(_ROWS[:3], _ROWS[1:4]):
        near |= set(zip(upper, lower)) | set(zip(upper[1:], lower))
    return near | {(b, a) for a, b in near}


_NEAR = _neighbours()
# (letters a class adds to an alphabet)
_CLASSES = (10, 26, 26, 33, 1000)


def _class_of(c):
    if "0" <= c <= "9":
        return 1
    if "a" <= c <= "z":
        return 2
    if "A" <= c <= "Z":
        return 4
    return 8 if c < "\x80" else 16


_LETTER_COST = [math.log10(max(1, sum(size for i, size in enumerate(_CLASSES) if mask >> i & 1))) for mask in range(32)]
_DATE = re.compile(
    r"(?:19|20)\d\d([-/._]?)(?:0?[1-9]|1[0-2])\1(?:0?[1-9]|[12]\d|3[01])|(?:0?[1-9]|[12]\d|3[01])([-/._]?)(?:0?[1-9]|1[0-2])\2(?:(?:19|20)?\d\d)"
    r"|(?:0?[1-9]|1[0-2])([-/._]?)(?:0?[1-9]|[12]\d|3[01])\3(?:(?:19|20)?\d\d)|(?:19|20)\d\d"
)


def _words(value, ranks):
    plain, leet = value.lower(), value.lower().translate(_LEET)
    if len(plain) != len(value):  # a letter whose lower case is longer
        plain, leet = value, value
    for i in range(len(value)):
        for j in range(i + MIN_WORD, min(i + MAX_WORD, len(value)) + 1):
            rank, swapped = ranks.get(plain[i:j]), 0.0
            if rank is None and plain[i:j] != leet[i:j]:
                rank, swapped = ranks.get(leet[i:j]), math.log10(4)
            if rank is not None:
                own = value[i:j]
                upper = sum(c.isupper() for c in own)
                cased = 0.0 if not upper else math.log10(2) if own.istitle() or own.isupper() else math.log10(math.comb(j - i, upper))
                yield i, j, "word", math.log10(rank) + cased + swapped


def _dates(value):
    for i in range(len(value)):
        if value[i].isdigit():
            for j in range(min(i + 10, len(value)), i + 3, -1):
                if found := _DATE.fullmatch(value, i, j):
                    parts = any(found.groups())
                    yield i, j, "date", math.log10(200 if j - i == 4 else 365 * 100) + (math.log10(4) if parts else 0)


def _repeats(value):
    """The longest repeat of every unit of up to MAX_UNIT letters from every place where one begins."""
    for unit in range(1, MAX_UNIT + 1):
        start = 0
        for i in range(unit, len(value) + 1):
            if i == len(value) or value[i] != value[i - unit]:
                if i - start >= max(2 * unit, 3):
                    mask = 0
                    for c in value[start : start + unit]:
                        mask |= _class_of(c)
                    yield start, i, "repeat", unit * _LETTER_COST[mask] + math.log10((i - start) / unit)
                start = i - unit + 1


def _walks(value):
    """Runs of neighbouring keys, or of the alphabet, dear by their turns."""
    low, start, turns = value.lower(), 0, 0
    low = low if len(low) == len(value) else value
    step = None
    for i in range(1, len(low) + 1):
        near = i < len(low) and (low[i - 1], low[i]) in _NEAR
        if near:
            now = ord(low[i]) - ord(low[i - 1])
            turns += step is not None and (now > 0) != (step > 0)
            step = now
        else:
            if i - start >= MIN_WALK:
                yield start, i, "walk", math.log10(47) + math.log10(i - start) + turns * math.log10(4)
            start, turns, step = i, 0, None


def guess_cost(value, ranks):
    """(decimal logarithm of the guesses, segments as (kind, start, end)) of the cheapest segmentation of a value."""
    n = len(value)
    ending = [[] for _ in range(n + 1)]
    for found in (_words(value, ranks), _dates(value), _repeats(value), _walks(value)):
        for i, j, kind, cost in found:
            ending[j].append((i, kind, cost))
    best, back = [0.0] + [math.inf] * n, [None] * (n + 1)
    # open brute-force spans by their alphabet: (cost, where they began)
    spans = [(math.inf, 0)] * 32
    for j in range(1, n + 1):
        own, began = _class_of(value[j - 1]), best[j - 1] + (SEGMENT_COST if j > 1 else 0.0)
        for mask in range(1, 32):
            if mask & own:
                spans[mask] = min(spans[mask], (began, j - 1))
                spans[mask] = (spans[mask][0] + _LETTER_COST[mask], spans[mask][1])
                if spans[mask][0] < best[j]:
                    best[j], back[j] = spans[mask][0], (spans[mask][1], "brute")
            else:
                spans[mask] = (math.inf, 0)
        for i, kind, cost in ending[j]:
            total = best[i] + cost + (SEGMENT_COST if i else 0.0)
            if total < best[j]:
                best[j], back[j] = total, (i, kind)
    parts, j = [], n
    while j:
        i, kind = back[j]
        parts.append((kind, i, j))
        j = i
    return best[n], parts[::-1]


# --- scan --------------------------------------------------------------------------


def _assigned(raw):
    """(start, kind, end) in bytes of the assignments in UTF-8 bytes."""
    return ((m.start(), 0, m.end()) for m in ASSIGN.finditer(raw) if m.end(2) - m.start(2) >= MIN_ASSIGN)


def _shaped(raw):
    """(start, kind, end) in bytes of the spans known by their shape alone."""
    yield from ((m.start(), 1, m.end()) for m in ACCESS.finditer(raw) if m.end() - m.start() >= MIN_ACCESS)
    yield from ((m.start(), 2, m.end()) for m in HEX.finditer(raw))


def context_values(raw):
    """Byte spans of values in credential contexts, without closing punctuation."""
    for pattern in (_NAMED, _URL):
        for m in pattern.finditer(raw):
            value = m[1].rstrip(b".:!?)]}")
            if len(value) >= 8:
                yield m.start(1), m.start(1) + len(value)


def scan_text(raw, cost):
    """[(kind, start, end, guesses)] of UTF-8 bytes, sorted by start and kind; ``cost`` prices a value."""
    low = raw.lower()
    named = any(w in low for w in CONTEXT_WORDS)
    base = [*(_assigned(raw) if named else ()), *_shaped(raw)]
    found = [(s, k, e, None) for s, k, e in base]
    if named or b"://" in raw:
        held = [sorted(s for s in base if s[1] == k) for k in range(3)]
        seen = set()
        for s, e in context_values(raw):
            if (s, e) in seen or _covered(held, s, e):
                continue
            seen.add((s, e))
            guesses = cost(raw[s:e].decode("utf-8", "replace"))
            if guesses >= MIN_GUESSES:
                found.append((s, 3, e, guesses))
    found.sort(key=lambda x: (x[0], x[1]))
    if raw.isascii():
        return [(KINDS[k], s, e, g) for s, k, e, g in found]
    # byte places to code points, one pass over the text
    places = sorted({p for s, _, e, _ in found for p in (s, e)})
    at, before, points = {}, 0, 0
    for p in places:
        points += len(raw[before:p].decode("utf-8", "replace"))
        at[p], before = points, p
    return [(KINDS[k], at[s], at[e], g) for s, k, e, g in found]


def _covered(held, start, end):
    """Whether one base span of a kind holds the whole of start..end. Spans of a kind are sorted and don't overlap."""
    for spans in held:
        last = bisect_right(spans, (start, len(KINDS), 0)) - 1
        if last >= 0 and end <= spans[last][2]:
            return True
    return False


def scan_secrets(docs, ranks, keep=("doc_id",)):
    """The columns ``keep`` of each row, with ``spans``: array of (kind, start, end, guesses), by start and kind.

    ``ranks`` is what ``ranked_words`` gives, at most RANKED_WORDS and the stand-ins.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    sent = spark.sparkContext.broadcast(ranks)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("guesses", pa.float64())]))

    def run(batches):
        cost = lru_cache(1_000)(lambda value: guess_cost(value, sent.value)[0])
        for part in slices(batches, "_text"):
            spans = [
                [dict(zip(("kind", "start", "end", "guesses"), s)) for s in scan_text(raw, cost)] if raw else []
                for raw in binary(part.column("_text"))
            ]
            columns = [c for n, c in zip(part.schema.names, part.columns) if n != "_text"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(spans, kind)], names=[*keep, "spans"])

    rows = docs.select(*keep, F.col("text").cast("string").alias("_text"))
    added = StructType.fromDDL("spans array<struct<kind: string, start: bigint, end: bigint, guesses: double>>")
    return rows.mapInArrow(run, StructType([*rows.schema.fields[:-1], *added.fields]))
