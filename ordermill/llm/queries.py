"""The queries ``opN_<name>`` and ``pipeline``, each over its whole tables, and their SQL where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ordermill.llm import (
    decontaminate,
    fill_in_middle,
    fingerprint,
    line_dedup,
    minhash,
    mixing,
    pii,
    prefix_trie,
    secret_scan,
    sharding,
    suffix_dedup,
    toxicity,
    url_filter,
)
from ordermill.llm.store import ship

QUERIES = {}
ORACLES = {}


def query(name: str, sql: str | None = None):
    def add(run):
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return run

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op1_minhash", minhash.ORACLE)
def op1(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicates of every document: its component and whether it is the one kept."""
    return minhash.near_duplicates(table(spark, folder, "documents"))


@query("op2_suffix_dedup", suffix_dedup.ORACLE)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    """Passages of 50 bytes and more that stand in an earlier document, removed from every later one."""
    return suffix_dedup.deduplicated(table(spark, folder, "documents"))


@query("op3_pii")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data: counts of base spans, their digest and all spans of every document."""
    return pii.personal_data(table(spark, folder, "documents"))


@query("op4_decontamination")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark passages in every document, and whether they make it contaminated."""
    return decontaminate.decontamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op5_secrets")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets: counts of base spans, their digest and all spans of every document."""
    return secret_scan.secrets(table(spark, folder, "documents"))


@query("op6_fingerprint")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how like each other they are."""
    return fingerprint.fingerprints(table(spark, folder, "documents"))


@query("op7_url_filter", url_filter.ORACLE)
def op7(spark: SparkSession, folder: str) -> DataFrame:
    """Host, path, rule and verdict of every page's url."""
    return url_filter.url_verdicts(table(spark, folder, "pages"))


@query("op8_mixing", mixing.ORACLE)
def op8(spark: SparkSession, folder: str) -> DataFrame:
    """Words that the mix takes of every document so that each source comes near its target."""
    return mixing.mixture(table(spark, folder, "documents"))


@query("op9_line_dedup", line_dedup.ORACLE)
def op9(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of every document that repeat an earlier run of lines, and what is left without them."""
    return line_dedup.line_report(table(spark, folder, "documents"))


@query("op10_toxicity")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity score of every document, learned from the labels that aren't held out."""
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op11_prefix_trie", prefix_trie.ORACLE)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    """Every distinct beginning of a conversation, with its members, children, leaves and the bytes it saves."""
    return prefix_trie.spliced_trie(table(spark, folder, "conversations"))


@query("op12_sharding", sharding.ORACLE)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    """Shard and slot of every document, by a permutation of the global row numbers."""
    return sharding.shard_report(table(spark, folder, "documents"))


@query("op13_fill_in_middle", fill_in_middle.ORACLE)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    """Every document cut and put together for filling in the middle, and the text rebuilt from that."""
    return fill_in_middle.cut_report(table(spark, folder, "documents"))


@query("pipeline")
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    """All stages of ``corpus_pipeline`` over the whole documents table."""
    import corpus_pipeline

    ship(spark)
    return corpus_pipeline.run(spark, folder)
