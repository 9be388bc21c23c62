"""The corpus pipeline: toxicity, near duplicates, PII, mixing, packing.

Each stage is a function of (spark, docs, sf_dir); its result is written as Parquet into the shared folder and read
again as the next one's ``docs``. All but the last return the columns of ``documents``. Nulls in any column pass
through; columns other than those of ``documents`` are dropped; an empty table stays empty. Repeated rows: the near
duplicates stage keeps one of them if they have words, and all if they have none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fathomline.llm import jaccard, mixing, packing, pii, toxicity
from fathomline.llm.common import scratch, staged, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below 0.5. Lexicon and coefficients come from the labelled documents outside the held-out fold."""
    docs = docs.select(*COLUMNS)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, model).where(F.col("toxic_score") < 0.5).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents whose five-word shingle sets link at a Jaccard similarity of 0.8 or more, the one with the least
    doc_id (on equal ids the least text hash, of equal rows one). Documents without words link with nothing and stay."""
    key = lambda h: F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), F.lit(":"), h.cast("string"))
    with scratch(spark):
        found = jaccard.near_duplicates(docs, k=5, num=80, den=100)
        stay = found.where(F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("h") == F.col("first_h")))
        stay = staged(stay.select(key(F.col("h")).alias("near_key"), (F.col("n_shingles") == 0).alias("near_empty")).distinct(), "pipeline-kept", keep=True)
    rows = docs.select(*COLUMNS).withColumn("near_key", key(F.xxhash64(F.coalesce("text", F.lit(""))))).join(stay, "near_key")
    rows = rows.withColumn("near_row", F.row_number().over(W.partitionBy("near_key").orderBy("source", "lang")))
    return rows.where("near_empty or near_row = 1").select(*COLUMNS)


def replace_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by surrogates; ``n_chars`` counted anew."""
    out = pii.surrogates(docs.select(*COLUMNS), pii.session_key(spark))
    return out.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The passes of the mix in training order: documents of sources that are to be repeated occur up to three times, those
    of sources beyond their target may be left out."""
    return mixing.mixed(docs, COLUMNS).withColumn("n_chars", F.length("text").cast("long"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 1024 tokens."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("pii", replace_pii),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Lexicon learning, surrogates and tokenisation have no SQL form; the tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with scratch(spark):
            docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}", keep=True)
    return STAGES[-1][1](spark, docs, sf_dir)
