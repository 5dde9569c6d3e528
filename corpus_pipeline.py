"""From raw documents to token ids: quality, line dedup, near duplicates,
decontamination, SentencePiece.

Every stage takes (spark, docs, sf_dir) and returns the documents it keeps with
their columns; the last adds ``ids``. ``run`` writes each stage's result to the
shared folder and reads it again, so a lost executor costs one stage at most.

Null or empty texts pass the stages (there is nothing to reject in them); rows
with a null ``doc_id`` pass; repeated rows stay repeated where a stage goes by
``doc_id``; further columns pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.llm.common import cut
from blotter.llm.decontam import decontaminated
from blotter.llm.jaccard import jaccard_dedup
from blotter.llm.linededup import line_dedup
from blotter.llm.pieces import encode
from blotter.llm.quality import accepted, train


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It learns from the labelled
    documents of the raw table."""
    model = train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return accepted(docs, model)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated three-line windows go; so does a document all of whose lines
    are repeats. ``n_chars`` follows the text."""
    names = docs.columns
    kept = line_dedup(docs, counts=True).where("n_removed = 0 or n_removed < n_lines")
    if "n_chars" in names:
        kept = kept.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType))
                               .otherwise(F.col("n_chars")))
    return kept.select(*names)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the smallest doc_id."""
    return jaccard_dedup(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its piece ids."""
    return encode(docs)


STAGES = [("quality", quality), ("line_dedup", lines), ("ngram_jaccard", near_duplicates),
          ("decontamination", decontamination), ("sentencepiece", tokens)]

#: SQL can't express the classifier and the piece merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
