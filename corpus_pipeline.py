"""The corpus pipeline: toxicity, near-duplicates, decontamination, secrets, mixing.

Each stage takes (spark, docs, sf_dir) and returns the documents it leaves, with
the columns of ``documents``; the last adds ``copy``, as a document is in the
mix as often as its copies say. Stages are written and read again in between,
so each works on all its predecessor kept and survives lost executors.

Rows are named by id and text, and further columns are carried along whatever
their names. NULL and empty texts are documents like others; what each stage
makes of them, of repeated rows and of ties is said there. An empty table
passes every stage as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from hazeline.llm import mixing, postings, secrets, simhash, toxicity
from hazeline.session import ready, stored
from hazeline.sources.tables import table

#: Documents scored this or higher go.
TOXIC = 0.5
#: Words of a shingle and differing bits that still link two fingerprints.
SHINGLE, RADIUS = 3, 2


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones, does not reject.

    NULL and empty texts have the score of no evidence; equal texts share their
    fate; without labels of both kinds all documents share one.
    """
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, model, TOXIC)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of nearly equal fingerprints connect: that with the smallest id.

    Of equal ids the smallest text hash stays, of repeated rows one. All texts
    without words have one fingerprint and form a group, NULL ones included; a
    NULL id stays only where its group has no other.
    """
    return simhash.one_per_group(docs, radius=RADIUS, shingle=SHINGLE)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item; texts and items without words match nothing, repeated rows go together."""
    return postings.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by their kind; a NULL text stays NULL. ``n_chars`` follows the text where the table has it."""
    masked = docs.withColumn("text", secrets.redacted(F.col("text")))
    if "n_chars" not in docs.columns:
        return masked
    length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return masked.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(length))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix of sources takes them; those without words are taken as their source's rate says, a NULL source is one of its own."""
    return mixing.mixed(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
]

#: The toxicity model and the mixing rates have no SQL form; tests check the stages by brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(ready(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
