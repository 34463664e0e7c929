"""Queries of the language-model data problems: 5, 8, 9 and 10. SQL expresses none of them; tests hold brute force against each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.llm import leakage, names, packing, sentences
from panelforge.session import cut, table


def _typed(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "seriesdemopopulation").where("FIPS_CODE IS NULL AND Country IS NOT NULL")
    return names.resolve_rows(rows, table(spark, d, "country_data"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return _typed(spark, d).select("row_id", "ifs_fipscode").distinct()


def p5_misses(spark: SparkSession, d: str) -> DataFrame:
    """The report of unmatched texts: how, and how many rows hold each."""
    missed = _typed(spark, d).where(F.col("ifs_fipscode") == names.NONE)
    return missed.groupBy(F.col("Country").alias("typed"), "how").agg(F.count("*").alias("row_count"))


def _capacities(spark: SparkSession, d: str) -> dict[str, int]:
    return {r["container_kind"]: r["capacity_tokens"] for r in table(spark, d, "containers").collect()}


def _packed(kind: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, d: str) -> DataFrame:
        return packing.pack(table(spark, d, "documents"), _capacities(spark, d)[kind])

    return query


def p8_slack(spark: SparkSession, d: str) -> DataFrame:
    """Containers, least number of containers and unused share for each kind."""
    counts = cut(packing.token_counts(table(spark, d, "documents")))
    out = None
    for kind, capacity in sorted(_capacities(spark, d).items()):
        one = packing.slack(packing.pack_counts(counts, capacity), capacity).withColumn("container_kind", F.lit(kind))
        out = one if out is None else out.unionByName(one)
    return out


def _leaks(spark: SparkSession, d: str, kind: str) -> DataFrame:
    return leakage.leaks(table(spark, d, "documents"), table(spark, d, "eval_items")).where(F.col("kind") == kind)


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return _leaks(spark, d, "verbatim").select("doc_id", "item_id")


def p9_paraphrases(spark: SparkSession, d: str) -> DataFrame:
    """Documents that hold an item's passage in other words, with the part of it and of its answers that they keep."""
    return _leaks(spark, d, "paraphrase").select("doc_id", "item_id", "share", "answers")


def p9_leaked_items(spark: SparkSession, d: str) -> DataFrame:
    """Evaluation items that leaked word for word, with the number of documents that hold them."""
    return _leaks(spark, d, "verbatim").groupBy("item_id").agg(F.count("*").alias("documents"), F.max("windows").alias("most_windows"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return sentences.sentence_units(table(spark, d, "documents")).select("doc_id", "end_pos")


def p10_units(spark: SparkSession, d: str) -> DataFrame:
    return sentences.sentence_units(table(spark, d, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "p5_found": p5_found, "p5_misses": p5_misses,
        "p8_standard": _packed("standard"), "p8_short": _packed("short"), "p8_long": _packed("long"), "p8_slack": p8_slack,
        "p9_found": p9_found, "p9_paraphrases": p9_paraphrases, "p9_leaked_items": p9_leaked_items, "p10_found": p10_found, "p10_units": p10_units,
    }


def oracle_sql() -> dict[str, str]:
    return {}
