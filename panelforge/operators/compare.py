"""Comparing panels: how many cells were added, revised or lost, and what covers which years and entities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CELL = ["table_name", "entity", "code", "year"]


def change_counts(before: DataFrame, incoming: DataFrame, after: DataFrame, threshold: float = 0.5, cell: list[str] = CELL) -> DataFrame:
    """Per table: cells added, revised, removed, unchanged and backfilled, and large revisions.

    Backfilled cells are those that the incoming panel holds empty, or not at all, though they have a value before and after,
    also where another batch revised it. A revision is large if it is more than `threshold` of the value before, or that was zero.
    """
    side = lambda df, name: df.select(*cell, F.col("value").alias(name))
    all3 = side(before, "a").join(side(incoming, "i"), cell, "full").join(side(after, "b"), cell, "full")
    a, b, i = F.col("a"), F.col("b"), F.col("i")
    revised = a.isNotNull() & b.isNotNull() & (a != b)
    large = revised & ((a == 0) | (F.abs(b - a) > threshold * F.abs(a)))
    return all3.groupBy("table_name").agg(
        F.count_if(a.isNull() & b.isNotNull()).alias("added"), F.count_if(revised).alias("revised"), F.count_if(a.isNotNull() & b.isNull()).alias("removed"),
        F.count_if(a.isNotNull() & (a == b)).alias("unchanged"), F.count_if(i.isNull() & a.isNotNull() & b.isNotNull()).alias("backfilled"), F.count_if(large).alias("large_revisions"),
    )


def coverage(panels: DataFrame, by: list[str]) -> DataFrame:
    """Non-null cells per `by` and year."""
    return panels.groupBy(*by, "year").agg(F.count("value").alias("cells"))


def entity_coverage(panel: DataFrame, by: list[str]) -> DataFrame:
    """Populated years of each series, and the first and last of them."""
    y = F.when(F.col("value").isNotNull(), F.col("year"))
    return panel.groupBy(*by).agg(F.count("value").alias("populated"), F.min(y).alias("first_year"), F.max(y).alias("last_year"))


def incoming_classes(before: DataFrame, incoming: DataFrame, cell: list[str] = CELL) -> DataFrame:
    """Each differing cell's class: added, missing_country, old_only_year, incoming_null or revised; the first that applies.

    That a year or an entity is absent is told from the incoming table's own years and entities, null cells included.
    """
    years = incoming.select("table_name", "year").distinct().withColumn("_y", F.lit(True))
    entities = incoming.select("table_name", "entity", "code").distinct().withColumn("_e", F.lit(True))
    both = before.select(*cell, F.col("value").alias("before")).join(incoming.select(*cell, F.col("value").alias("after")), cell, "full")
    told = both.join(years, ["table_name", "year"], "left").join(entities, ["table_name", "entity", "code"], "left")
    kind = (
        F.when(F.col("before").isNull(), "added").when(F.col("_e").isNull(), "missing_country").when(F.col("_y").isNull(), "old_only_year")
        .when(F.col("after").isNull(), "incoming_null").otherwise("revised")
    )
    return told.where(~F.col("before").eqNullSafe(F.col("after"))).select(*cell, "before", "after", kind.alias("change_class"))


def outcomes(before: DataFrame, incoming: DataFrame, cell: list[str] = CELL) -> DataFrame:
    """Each cell's outcome: both_missing, unchanged, added, incoming_missing or revised."""
    both = before.select(*cell, F.col("value").alias("before")).join(incoming.select(*cell, F.col("value").alias("after")), cell, "full")
    a, b = F.col("before"), F.col("after")
    kind = F.when(a.isNull() & b.isNull(), "both_missing").when(a == b, "unchanged").when(a.isNull(), "added").when(b.isNull(), "incoming_missing").otherwise("revised")
    return both.select(*cell, "before", "after", kind.alias("outcome"))


def revision_evidence(before: DataFrame, incoming: DataFrame, cell: list[str] = CELL) -> DataFrame:
    """Per table: overlap, equal and revised cells, cells of one side only, and the upper median of the relative revision."""
    both = before.select(*cell, F.col("value").alias("a")).join(incoming.select(*cell, F.col("value").alias("b")), cell, "full")
    a, b = F.col("a"), F.col("b")
    told = both.withColumn("rel", F.when((a != b) & (a != 0), F.abs(b - a) / F.abs(a)))
    return told.groupBy("table_name").agg(
        F.count_if(a.isNotNull() & b.isNotNull()).alias("overlap"), F.count_if(a == b).alias("exact_equal"), F.count_if(a != b).alias("revised"),
        F.count_if(a.isNull() & b.isNotNull()).alias("incoming_only"), F.count_if(a.isNotNull() & b.isNull()).alias("base_without_incoming"),
        F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY rel DESC)").alias("upper_median_revision"),
    )


def import_coverage(panel: DataFrame, by: list[str]) -> DataFrame:
    """Entities with data, observations, zeros, negatives and null cells of each table."""
    v = F.col("value")
    return panel.groupBy(*by).agg(
        F.countDistinct(F.when(v.isNotNull(), F.col("code"))).alias("entities"), F.count(v).alias("observations"), F.count_if(v == 0).alias("zeros"), F.count_if(v < 0).alias("negatives"), F.count_if(v.isNull()).alias("null_cells"))


def classify_findings(findings: DataFrame) -> DataFrame:
    """Findings of a final dataset by where the same numerical evidence (rule and signature) also stands.

    findings: role (base, incoming, final), rule, signature. Evidence in the base counts before that in an incoming dataset,
    that before a rule's being about a boundary of blending; all else is specific to the dataset or unresolved.
    """
    roles = findings.groupBy("rule", "signature").agg(F.collect_set("role").alias("roles"))
    final = findings.where("role = 'final'").join(roles, ["rule", "signature"])
    kind = (
        F.when(F.array_contains("roles", "base"), "also_in_base").when(F.array_contains("roles", "incoming"), "also_in_incoming")
        .when(F.col("rule") == "blending_boundary_jump", "blending_boundary").otherwise("dataset_specific_or_unresolved")
    )
    return final.select("rule", "signature", kind.alias("classification"))
