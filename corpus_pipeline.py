"""The corpus pipeline: from raw documents to packed training sequences.

Each stage takes what the one before it kept, and all stages but the last return the columns
of ``documents``. ``run`` writes what a stage returns to the shared folder and reads it again, so
that a lost executor costs no more than one stage's work; what only that stage has read is then
removed. All stages take null and empty texts as texts without words, keep extra columns of any
name, and return no rows for none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeaudit.llm import chosen_path, host_bayes, mixing, packing, secrets
from lakeaudit.session import apply_defaults, remove, scratch, work_path

TOKENIZER = "word_bpe_49k.json"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects as toxic or of low quality go.

    Repeated rows are judged alike; a document is rejected at a probability of one half. Without labels all stay.
    """
    apply_defaults(spark)
    return host_bayes.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the least id.

    Of repeated rows one stays; texts without words are no duplicates of each other.
    """
    apply_defaults(spark)
    return chosen_path.one_of_each(docs)


def redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; secrets in them are replaced by a mark. Repeated rows are changed alike."""
    apply_defaults(spark)
    return secrets.redacted(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: whole copies, and the fractional repetition.

    Sources tie by code point, null last; of repeated rows each has its own draw.
    """
    apply_defaults(spark)
    return mixing.mixture(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, each with its sequence and place, and its token ids.

    A text without words is one piece with the end id; repeated rows are pieces of their own.
    """
    import public_tokenizers

    apply_defaults(spark)
    return packing.packed(docs, public_tokenizers.path(TOKENIZER), with_ids=True)


STAGES = [
    ("quality_classifier", quality),
    ("ngram_jaccard_join", near_duplicates),
    ("secret_scans", redaction),
    ("mixing", mixture),
    ("packing", packing_stage),
]

# Training a classifier, min-hash joins and packing have no SQL form; tests hold the result against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES[:-1]:
        path = work_path(spark, f"pipeline-{name}")
        with scratch(spark):
            kept = stage(spark, docs, sf_dir)
            kept.write.parquet(path)
        remove(spark, before)
        docs, before = spark.read.schema(kept.schema).parquet(path), [path]
    return STAGES[-1][1](spark, docs, sf_dir)
