"""From raw documents to a training mix: five stages, each written as Parquet and read again by the next.

Each stage is a function of the session, the documents its predecessor kept, and the folder of the other tables. All
but the last return the columns of documents; the last adds ``repeats``, how often the mix takes a document.

Every stage takes an empty table for one, texts of any length whole, and other columns of any name along with their
rows; the last one replaces a column called ``repeats``. Rows are judged one by one: repeated rows stay or go alike in
the first two and the fourth stage, one of them stays in the third, and the last gives each its own copies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ordermill.llm import decontaminate, line_dedup, minhash, mixing, toxicity
from ordermill.llm.store import dropped, ship, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a model of the labels at hand (without the held-out ones) scores under 0.5.

    Rows with null or empty texts stay; no labels, or labels of one kind only, reject nothing.
    """
    ship(spark)
    model = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.without_toxic(docs, model)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat earlier runs of lines; those left without any line go."""
    ship(spark)
    return line_dedup.without_repeated_lines(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near-duplicates (a similarity of 0.8 or more).

    Rows without an id or without words all stay; rows of one id are judged by their own texts.
    """
    ship(spark)
    return minhash.without_near_duplicates(docs, minhash.STAGE_SIMILAR)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which under a twentieth of the words lie in benchmark passages."""
    ship(spark)
    return decontaminate.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, and how often."""
    ship(spark)
    return mixing.drawn(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("minhash", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

#: SQL has no counterpart of the learned toxicity score, so the pipeline is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}", keep=True)
        if before is not None:
            dropped(before)
        before = docs
    return docs
