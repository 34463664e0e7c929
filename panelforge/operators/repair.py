"""Repair of delivered tables: empty and surplus rows, endpoints, roster padding, and an audit of every change."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.functions.columns import is_blank
from panelforge.operators import identity


def _all_blank(df: DataFrame, columns: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"`{c}`").isNull() | is_blank(F.col(f"`{c}`").cast("string")) for c in columns])


def empty_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows in which every one of the columns is null or blank."""
    return df.where(_all_blank(df, columns))


def without_empty_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.where(~_all_blank(df, columns))


def surplus_rows(rows: DataFrame, roster: DataFrame, alias: DataFrame, table: list[str], values: list[str] | None = None, reviewed: DataFrame | None = None) -> DataFrame:
    """Rows beyond a complete roster: their identity can't be told, and neither their code nor their name is known at all.

    Only tables whose rows resolve to each roster entity exactly once have surplus rows; a row with a known name, alias,
    reviewed name or code never is one, it is a conflict for review. Rows that are empty but for the table are left out.
    `values` names the other columns by which a row may be non-empty (default: all but the table's).
    """
    body = without_empty_rows(rows, values if values is not None else [c for c in rows.columns if c not in table])
    told = identity.repair_identity(body, roster, alias, reviewed)
    present = told.where("fixed_code IS NOT NULL").groupBy(*table, "fixed_code").agg(F.count("*").alias("_n"))
    size = roster.agg(F.countDistinct("code").alias("_size"))
    complete = present.groupBy(*table).agg(F.count("*").alias("_have"), F.max("_n").alias("_most")).join(F.broadcast(size), how="cross").where("_have = _size AND _most = 1").select(*table)
    unknown = told.where("decision IN ('error_unknown_code', 'error_unknown_name')").withColumn("_alias", identity.normalized(F.col("entity")))
    unknown = unknown.join(alias.select(F.col("alias_norm").alias("_alias")).distinct(), "_alias", "left_anti").drop("_alias")
    return unknown.join(complete, table, "left_semi").select(*rows.columns)


def endpoint_mismatches(wide: DataFrame, keys: list[str], years: list[str]) -> DataFrame:
    """Rows whose Earliest or MostRecent isn't the first or last non-null year's value, with both."""
    values = F.array_compact(F.array(*[F.col(f"`{y}`") for y in years]))
    told = wide.withColumns({"first_value": F.try_element_at(values, F.lit(1)), "last_value": F.try_element_at(values, F.lit(-1))})
    return told.where(~F.col("Earliest").eqNullSafe(F.col("first_value")) | ~F.col("MostRecent").eqNullSafe(F.col("last_value"))).select(*keys, "Earliest", "first_value", "MostRecent", "last_value")


def repair_counts(audit: DataFrame) -> DataFrame:
    """Repairs per table and rule."""
    return audit.groupBy("table_name", "rule").agg(F.count("*").alias("repairs"))


def audit_text(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """One row per repaired cell: key, field, rule (blank_to_null, infinity_to_null, numeric_text_to_double) and the text."""
    from panelforge.operators.panel import DECIMAL, INFINITY

    flat = rows.select(key, "table_name", *[F.col(f"`{c}`").cast("string").alias(c) for c in columns]).unpivot([key, "table_name"], [F.col(f"`{c}`") for c in columns], "field", "raw").where("raw IS NOT NULL")
    rule = F.when(is_blank(F.col("raw")), "blank_to_null").when(F.col("raw").rlike(INFINITY), "infinity_to_null").when(F.col("raw").rlike(DECIMAL), "numeric_text_to_double")
    return flat.withColumn("rule", rule).where("rule IS NOT NULL")


def multiset_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of one side that the other hasn't, with the side, as often as they are more; empty if both hold the same rows.

    Both sides are counted in one aggregation, combined before its shuffle.
    """
    counted = a.withColumn("_n", F.lit(1)).unionByName(b.withColumn("_n", F.lit(-1))).groupBy(*[F.col(f"`{c}`") for c in a.columns]).agg(F.sum("_n").alias("_n"))
    more = counted.where("_n <> 0").withColumn("side", F.when(F.col("_n") > 0, "left").otherwise("right"))
    return more.withColumn("_k", F.explode(F.sequence(F.lit(1), F.abs("_n")))).drop("_n", "_k")
