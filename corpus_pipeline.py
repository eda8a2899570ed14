"""Documents to token pieces: five stages, each reading all that the one before it kept."""

import public_tokenizers
from pyspark.sql import functions as F

from stewardry.llm import mixing, near_docs, pieces, substrings, toxicity
from stewardry.llm.common import quoted
from stewardry.session import materialize

# No source is cut; small ones are drawn up to twice.
MAX_REPEATS = 2.0
# Some stages are a fitted model, a hash or a search, which SQL cannot express.
ORACLE_SQL = None


def same_columns(rows, docs):
    return rows.select(*[quoted(c) for c in docs.columns])


def drop_toxic(spark, docs, sf_dir):
    """Documents whose score passes the threshold of their language go; null and empty texts stay.

    The classifier is fitted on the labelled documents outside the held-out quarter.
    """
    model = toxicity.fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    name = "_toxic_score"
    while name in docs.columns:
        name += "_"
    scored = toxicity.score_toxicity(docs, model, output=name)
    toxic = toxicity.toxic_by_language(F.col(name), F.col("lang"), model)
    empty = F.length(F.trim(F.coalesce("text", F.lit("")))) == 0
    return same_columns(scored.where(~toxic | empty), docs)


def drop_near_copies(spark, docs, sf_dir):
    """One document of each class of near copies stays, that with the smallest doc_id."""
    found = materialize(near_docs.near_documents(docs), "pipeline-near")
    return same_columns(near_docs.keep_one(docs, found), docs)


def cut_passages(spark, docs, sf_dir):
    """Words of passages that a smaller doc_id also has go; untouched texts stay as they are, and no row goes."""
    cut = substrings.cut_repeats(docs, carry=True)
    changed = F.col("n_removed") > 0
    new = {
        "text": F.when(changed, F.col("kept_text")).otherwise(F.col("row.text")),
        "n_chars": F.when(changed, F.length("kept_text")).otherwise(F.col("row.n_chars")),
    }
    return cut.select(*[new.get(c, F.col(f"row.{quoted(c)}")).cast(docs.schema[c].dataType).alias(c) for c in docs.columns])


def mix_sources(spark, docs, sf_dir):
    """Every document at least once; sources below the largest are repeated, at most twice, to flatten the mix."""
    return same_columns(mixing.mix(docs, max_repeats=MAX_REPEATS), docs)


def encode_pieces(spark, docs, sf_dir):
    """(doc_id, source, ids, n_pieces) per drawn row."""
    coded = pieces.encode_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select("doc_id", "ids", "n_pieces", "n_bytes")


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", drop_near_copies),
    ("substring_dedup", cut_passages),
    ("mix_sources", mix_sources),
    ("sentencepiece", encode_pieces),
]


def run(spark, sf_dir):
    """The stages over ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
