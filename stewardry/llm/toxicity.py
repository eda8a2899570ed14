"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy."""

import pickle

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from stewardry.llm.common import Memo, binary, bound_batches, few_rows, slices, split_words
from stewardry.session import materialize

# Labelled documents the classifier is fitted on at most, half of them toxic where there are
# enough; which ones, a hash of the id decides.
SAMPLE_DOCS = 6_000
BUCKETS, DIMS = 1 << 17, 8
WIDTHS, FILTERS = (1, 2, 3), 8
# Batches of one fit, however many documents the sample holds.
STEPS, BATCH, RATE = 900, 64, 0.08
THRESHOLD = 0.3
# Scores lie between the logits -LOGIT_BOUND and LOGIT_BOUND; they are counted in bins of equal width there.
LOGIT_BOUND, BINS_PER_LOGIT = 30, 50
BINS = 2 * LOGIT_BOUND * BINS_PER_LOGIT
# Words a scoring step holds at once; longer documents run through in pieces.
STEP_WORDS = 200_000


# A word is looked up by itself and by these many of its first letters, so that forms of one stem share.
STEMS = (4, 5)
_BITS, _MASK = 20, (1 << 20) - 1


def _bucket(word):
    """Buckets of a word, in lower case without outer punctuation, and of its stems; 0 is the padding."""
    text = word.decode("utf-8", "replace").lower()
    start, end = 0, len(text)
    while start < end and not text[start].isalnum():
        start += 1
    while end > start and not text[end - 1].isalnum():
        end -= 1
    text = text[start:end]
    packed = 0
    for k, part in enumerate((text, *(f"{n}:{text[:n]}" for n in STEMS))):
        packed |= (1 + xxhash.xxh64_intdigest(part) % (BUCKETS - 1)) << (_BITS * k)
    return packed


def _unpacked(packed):
    return [(packed >> (_BITS * k)) & _MASK for k in range(1 + len(STEMS))]


_buckets = Memo(_bucket)


def word_buckets(text):
    """The bucket numbers of each word of UTF-8 bytes, packed in one integer."""
    words = split_words(text)
    return np.fromiter(_buckets.all(words), np.int64, len(words))


def _padded(docs):
    """Documents in one array, each after and before enough padding for the widest filter."""
    gap = np.zeros(max(WIDTHS) - 1, np.int64)
    parts, starts, at = [gap], [], len(gap)
    for d in docs:
        starts.append(at - len(gap))
        parts += [d, gap]
        at += len(d) + len(gap)
    return np.concatenate(parts), np.array(starts, np.int64)


class TextCnn:
    """Embeddings of a word and its stems summed, filters of several widths, the maximum of each over the text, a logistic unit."""

    def __init__(self, seed=7):
        rng = np.random.default_rng(seed)
        self.table = rng.normal(0, 0.1, (BUCKETS, DIMS)).astype(np.float32)
        self.table[0] = 0
        self.kernels = [rng.normal(0, 0.3, (w * DIMS, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.shift = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        self.out = rng.normal(0, 0.3, len(WIDTHS) * FILTERS).astype(np.float32)
        self.bias = np.float32(-1.0)

    def _maps(self, ids, drop=0):
        """Filter responses at every position; row p of width w covers words p .. p + w - 1."""
        vectors = sum(self.table[part] for part in _unpacked(ids))
        n = len(ids) - max(WIDTHS) + 1
        for w, kernel, shift in zip(WIDTHS, self.kernels, self.shift):
            stacked = np.concatenate([vectors[k : k + n] for k in range(w)], axis=1)
            yield stacked, stacked @ kernel + shift

    def features(self, docs):
        ids, starts = _padded(docs)
        return np.concatenate([np.maximum.reduceat(m, starts, axis=0) for _, m in self._maps(ids)], axis=1)

    def _long(self, doc):
        """Features of one document, whose padded words pass in pieces that overlap by a filter's reach."""
        ids, reach = _padded([doc])[0], max(WIDTHS) - 1
        top = None
        for a in range(0, len(ids) - reach, STEP_WORDS):
            found = np.concatenate([m.max(axis=0) for _, m in self._maps(ids[a : a + STEP_WORDS + reach])])
            top = found if top is None else np.maximum(top, found)
        return top

    def scores(self, docs):
        """Probability of label 1 for each document of the list, over all its words."""
        if not docs:
            return np.zeros(0)
        pooled = np.zeros((len(docs), len(self.out)), np.float32)
        part, held = [], 0
        for i, d in enumerate(docs):
            if len(d) > STEP_WORDS:
                pooled[i] = self._long(d)
            else:
                part.append(i)
                held += len(d)
            if part and (held >= STEP_WORDS or i + 1 == len(docs)):
                pooled[part] = self.features([docs[k] for k in part])
                part, held = [], 0
        z = np.maximum(pooled, 0) @ self.out + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -LOGIT_BOUND, LOGIT_BOUND).astype(np.float64)))

    def _start_from_counts(self, docs, labels):
        """Sets the first coordinate of a bucket from how often toxic and other documents hold it.

        Only one position per filter and document learns, so words are found much sooner when
        they start apart; buckets of fewer than four documents start at 0.
        """
        seen = [np.unique(np.concatenate(_unpacked(d))) for d in docs]
        held = np.zeros((2, BUCKETS))
        for label in (0, 1):
            rows = [s for s, y in zip(seen, labels) if y == label]
            held[label] = np.bincount(np.concatenate(rows), minlength=BUCKETS) if rows else 0
        size = np.array([(labels == 0).sum(), (labels == 1).sum()])[:, None]
        odds = np.log((held[1] + 0.5) / (size[1] + 1)) - np.log((held[0] + 0.5) / (size[0] + 1))
        self.table[:, 0] = np.where(held.sum(axis=0) >= 4, odds / 4, 0)
        self.table[0] = 0

    def fit(self, docs, labels, steps=STEPS, seed=11):
        """Adagrad on the logistic loss; of each filter only the strongest position learns."""
        rng = np.random.default_rng(seed)
        labels = np.asarray(labels, np.float32)
        self._start_from_counts(docs, labels)
        grown = [np.full_like(x, 1e-4) for x in (*self.kernels, *self.shift, self.out)]
        table_grown, bias_grown = np.full(BUCKETS, 1e-4, np.float32), 1e-4
        for _ in range(max(1, steps * BATCH // len(docs))):
            order = rng.permutation(len(docs))
            for at in range(0, len(order), BATCH):
                chosen = order[at : at + BATCH]
                ids, starts = _padded([docs[i] for i in chosen])
                maps = list(self._maps(ids))
                tops, wins = [], []
                for _, m in maps:
                    top = np.maximum.reduceat(m, starts, axis=0)
                    ends = np.append(starts[1:], len(m))
                    owner = np.repeat(np.arange(len(starts)), ends - starts)
                    rows, filters = np.nonzero(m[starts[0] :] == top[owner])
                    _, first = np.unique(owner[rows] * FILTERS + filters, return_index=True)
                    tops.append(top)
                    wins.append((rows[first] + starts[0]).reshape(len(chosen), FILTERS))
                pooled = np.maximum(np.concatenate(tops, axis=1), 0)
                p = 1 / (1 + np.exp(-np.clip(pooled @ self.out + self.bias, -30, 30)))
                error = (p - labels[chosen]) / len(chosen)
                back = np.outer(error, self.out) * (pooled > 0)
                steps = []
                word_rows, word_steps = [], []
                for k, (w, (stacked, _)) in enumerate(zip(WIDTHS, maps)):
                    g = back[:, k * FILTERS : (k + 1) * FILTERS]
                    picked = stacked[wins[k]]
                    steps.append(np.einsum("df,dfx->xf", g, picked))
                    into = g[:, :, None] * self.kernels[k].T[None]
                    for j in range(w):
                        word_rows.append((wins[k] + j).ravel())
                        word_steps.append(into[:, :, j * DIMS : (j + 1) * DIMS].reshape(-1, DIMS))
                steps += [back[:, k * FILTERS : (k + 1) * FILTERS].sum(axis=0) for k in range(len(WIDTHS))]
                steps.append(error @ pooled)
                for x, g, s in zip((*self.kernels, *self.shift, self.out), steps, grown):
                    s += g * g
                    x -= RATE * g / np.sqrt(s)
                bias_grown += float(error.sum()) ** 2
                self.bias -= np.float32(RATE * error.sum() / np.sqrt(bias_grown))
                words = ids[np.concatenate(word_rows)]
                rows = np.concatenate(_unpacked(words))
                moves = np.concatenate(word_steps)
                used, inverse = np.unique(rows, return_inverse=True)
                g = np.zeros((len(used), DIMS), np.float32)
                np.add.at(g, inverse, np.concatenate([moves] * (1 + len(STEMS))))
                table_grown[used] += (g * g).mean(axis=1)
                self.table[used] -= RATE * g / np.sqrt(table_grown[used])[:, None]
                self.table[0] = 0
        return self


def _best_threshold(counts):
    """The cut with the largest F1 of ``counts`` (2 x BINS, per label), halfway between the bins that hold any; None without both labels."""
    held = np.flatnonzero(counts.sum(axis=0))[::-1]
    if not counts[0].any() or not counts[1].any():
        return None
    hits, taken = np.cumsum(counts[1, held]), np.cumsum(counts[:, held].sum(axis=0))
    k = int(np.argmax(2 * hits / (taken + hits[-1])))
    below = held[k + 1] + 1 if k + 1 < len(held) else 0
    return float(1 / (1 + np.exp(LOGIT_BOUND - (held[k] + below) / 2 / BINS_PER_LOGIT)))


class ToxicityModel:
    """A fitted classifier and its thresholds: one per language, ``default`` elsewhere."""

    def __init__(self, net, thresholds, default=THRESHOLD):
        self.net, self.thresholds, self.default = net, thresholds, default


def held_out(doc_id="doc_id"):
    """True for the quarter of the ids that is never learnt from; false for a null id."""
    remainder = F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4
    return F.coalesce(remainder == 2, F.lit(False))


def fit_toxicity(docs, labels, sample_docs=SAMPLE_DOCS, seed="toxic"):
    """Fit on at most ``sample_docs`` labelled documents outside the held-out quarter; calibrate on all others.

    Ids are drawn by a hash within each label before any text is read, so the fit, one task, gets a bounded number
    of documents, as hashed words, and the driver only the net. One fifth of them is kept from the fit; it and all labelled documents that
    were not drawn calibrate the thresholds per language (:func:`calibrate`). Rows with a null id, text or
    label are not learnt from; of several labels of one id the largest counts.
    """
    ids = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    ids = ids.join(docs.where("text is not null").select("doc_id").distinct(), "doc_id", "left_semi")
    ids = materialize(ids.withColumn("toxic", (F.col("toxic") >= 1).cast("int")), "toxic-ids")
    sizes = {r["toxic"]: r["n"] for r in ids.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    few = min(sizes.get(1, 0), sample_docs // 2)
    order = (F.xxhash64(F.lit(seed), "doc_id"), "doc_id")
    drawn = ids.where("toxic = 1").orderBy(*order).limit(few)
    drawn = drawn.union(ids.where("toxic = 0").orderBy(*order).limit(sample_docs - few))

    bound_batches(docs.sparkSession)

    def hashed(batches):
        for b in slices(batches, 1):
            coded = [word_buckets(t).tobytes() for t in binary(b.column(1))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(coded, pa.binary()), b.column(2)], names=["doc_id", "words", "toxic"]
            )

    id_type = dict(docs.dtypes)["doc_id"]
    texts = docs.where("text is not null").select("doc_id", "text").join(F.broadcast(drawn), "doc_id")
    # a repeated id brings one document, that with the least text hash
    texts = texts.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.first("toxic").alias("toxic"))
    rows = texts.mapInArrow(hashed, f"doc_id {id_type}, words binary, toxic int").repartition(1)
    kept = materialize(rows.mapInArrow(_fit_task(sizes), f"doc_id {id_type}, net binary, trained boolean"), "toxic-fit")
    found = kept.where("net is not null").select("net", "trained").first()
    if found is None or not found["trained"]:
        return ToxicityModel(TextCnn(), {})
    return calibrate(docs, ids, kept.where("net is null").select("doc_id").distinct(), pickle.loads(found["net"]))


def _fit_task(sizes):
    """Fits in one task, as its rows are bounded: the driver holds no documents, only the net. Yields the net, then the ids fitted on."""

    def fit(batches):
        ids, words, toxic = [], [], []
        for b in batches:
            ids += b.column(0).to_pylist()
            words += [np.frombuffer(w, np.int64) for w in binary(b.column(1))]
            toxic += b.column(2).to_pylist()
        order = sorted(range(len(ids)), key=lambda k: (xxhash.xxh64_intdigest(str(ids[k])), words[k].tobytes()))
        words, toxic = [words[k] for k in order], np.array([toxic[k] for k in order], np.int64)
        net, trained = TextCnn(), len(set(toxic.tolist())) == 2
        cut = len(order) - len(order) // 5 if trained else 0
        if trained:
            net.fit(words[:cut], toxic[:cut])
            # the sample holds more toxic documents than the labels do: back to the odds of the labels
            n_toxic = int(toxic.sum())
            net.bias += np.float32(np.log(sizes[1] / sizes[0]) - np.log(n_toxic / (len(toxic) - n_toxic)))
        if ids:
            columns = [
                pa.array([None, *[ids[k] for k in order[:cut]]], b.schema.field(0).type),
                pa.array([pickle.dumps(net), *[None] * cut], pa.binary()),
                pa.array([trained, *[None] * cut], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "net", "trained"])

    return fit


def calibrate(docs, ids, fitted, net):
    """Thresholds from all of ``ids`` (doc_id, toxic) that are not ``fitted``, scored where their texts are.

    Only counts per language, label and bin of the score come to the driver. The fit took more
    of one label than of the other, so both are weighed back to their share among all ids of the
    language. A language with fewer than 20 toxic ids there gets the common threshold. Of several
    documents of one id that with the least text hash counts.
    """
    texts = docs.where(F.col("text").isNotNull() & ~held_out())
    texts = few_rows(texts.select("doc_id", "text", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang")), ids, ["doc_id"])
    scored = score_toxicity(texts, ToxicityModel(net, {}), output="score")
    # text alone decides the score, so a copy is only told apart by its language
    scored = scored.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "lang", "score")).alias("r"))
    unseen = ids.join(F.broadcast(fitted.select("doc_id", F.lit(False).alias("unseen"))), "doc_id", "left")
    told = scored.join(unseen.withColumn("unseen", F.coalesce("unseen", F.lit(True))), "doc_id")
    logit = F.log(F.col("r.score") / (1 - F.col("r.score")))
    bin_ = F.least(F.greatest(F.floor((logit + LOGIT_BOUND) * BINS_PER_LOGIT), F.lit(0)), F.lit(BINS - 1))
    counts = told.groupBy(F.col("r.lang").alias("lang"), "toxic", F.when(F.col("unseen"), bin_).cast("int").alias("bin"))
    counts = materialize(counts.agg(F.count("*").alias("n")), "toxic-counts")
    many = counts.where("toxic = 1 and bin is not null").groupBy("lang").agg(F.sum("n").alias("n")).where("n >= 20")

    def weighed(rows):
        found, whole = np.zeros((2, BINS)), np.zeros(2)
        for r in rows:
            whole[r["toxic"]] += r["n"]
            if r["bin"] is not None:
                found[r["toxic"], r["bin"]] += r["n"]
        return found * (whole / np.maximum(found.sum(axis=1), 1))[:, None]

    common = counts.groupBy("toxic", "bin").agg(F.sum("n").alias("n")).collect()
    default = _best_threshold(weighed(common)) or THRESHOLD
    of_lang = {}
    for r in counts.join(F.broadcast(many.select("lang")), "lang", "left_semi").collect():
        of_lang.setdefault(r["lang"], []).append(r)
    thresholds = {lang: _best_threshold(weighed(rows)) or default for lang, rows in of_lang.items()}
    return ToxicityModel(net, thresholds, default)


def score_toxicity(docs, model, text="text", output="score"):
    """``docs`` with ``output`` (0 to 1): a function of the whole text alone; null and empty texts get that of no words."""
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model.net)

    @F.pandas_udf("double")
    def score(texts):
        import pandas as pd

        found = np.zeros(len(texts))
        part, held = [], 0
        for i, t in enumerate(texts):
            part.append(word_buckets(t.encode() if t else None))
            held += len(part[-1])
            if held >= STEP_WORDS or i + 1 == len(texts):
                found[i + 1 - len(part) : i + 1] = shared.value.scores(part)
                part, held = [], 0
        return pd.Series(found)

    return docs.withColumn(output, score(F.col(text)))


def toxic_by_language(score, lang, model):
    """Whether a score passes the calibrated threshold of its language."""
    cut = F.lit(model.default)
    for name, value in sorted(model.thresholds.items()):
        cut = F.when(lang == name, F.lit(value)).otherwise(cut)
    return score >= cut
