"""Documents to a training mix: toxicity, exact copies, near copies, source mix, token ids.

Each stage takes the documents its predecessor kept and returns those it keeps, with the
columns of ``documents``; the last returns the documents that are left with their token ids.

Rows keep their columns whatever those are called. Defined cases of the stages are those of
the operators they call; a stage over an empty table returns an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wardlake.llm.common import documents, id_and_text, labels, same_row, written
from wardlake.llm.exact_dedup import drop_copies
from wardlake.llm.jaccard_join import component_rows
from wardlake.llm.mixing import Mix, PRODUCTION, take_mix
from wardlake.llm.queries import PIECE_BPE
from wardlake.llm.sentencepiece_codec import sentencepiece_codec
from wardlake.llm.toxicity import THRESHOLD, labelled, learn, score_of

# Near copies share 80 % of their 5-word shingles; op5_jaccard_join has values of its own.
NEAR_GRAM, NEAR_PERCENT = 5, 80

# As the registered mix, but a document is taken once at most.
ONE_EPOCH = Mix(PRODUCTION.domain_of, PRODUCTION.default_domain, PRODUCTION.weights, max_epochs=1)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity stays below the threshold."""
    rows = id_and_text(docs, "doc_id", "text")
    scorer = learn(rows, labelled(labels(spark, sf_dir)))
    if scorer is None:
        return docs
    return docs.where(score_of(scorer, F.coalesce(docs["text"].cast("string"), F.lit(""))) < THRESHOLD)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the greatest id."""
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies, the one with the least id; of several
    texts under that id, the one with the least hash.

    Documents without shingles link with nothing; those of them that repeat id and text are one.
    """
    found = component_rows(docs, gram=NEAR_GRAM, percent=NEAR_PERCENT)
    gone = written(found.where("not stays").select("doc_id", "text_key").distinct(), "gone")
    keyed = docs.select(
        F.struct("*").alias("row"), docs["doc_id"].cast("long").alias("doc_id"),
        F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit(""))).alias("text_key"),
    )
    left = same_row(keyed, gone, "left_anti")
    # Rows that repeat an id and its text: only if there are any, one of them is picked.
    again = found.where("stays").groupBy("doc_id", "text_key").count().where("count > 1")
    if again.head(1):
        left = left.dropDuplicates(["doc_id", "text_key"])
    return left.select("row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The prefix of each source that its budget pays for."""
    return take_mix(docs, ONE_EPOCH)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document with its SentencePiece ids."""
    return sentencepiece_codec(docs, PIECE_BPE)


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("sentencepiece", encode),
]

# Learned scores and token ids have no SQL form; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over a table directory, each written and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
