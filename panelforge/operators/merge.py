"""Merging ordered batches: newest non-null wins, with the origin of each cell, events, discards and verification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CELL = ["table_name", "entity", "code", "year"]


def blend(old: DataFrame, new: DataFrame, policy: str = "prefer_new_non_null", cell: list[str] = CELL) -> DataFrame:
    """Two panels in one. `replace` takes the new one alone, `keep_old` the old one; otherwise new non-null values win."""
    if policy == "replace":
        return new.select(*cell, "value")
    if policy == "keep_old":
        return old.select(*cell, "value")
    both = old.select(*cell, F.col("value").alias("_old")).join(new.select(*cell, F.col("value").alias("_new")), cell, "full")
    return both.select(*cell, F.coalesce("_new", "_old").alias("value"))


def consolidate(batches: DataFrame, cell: list[str] = CELL) -> DataFrame:
    """All batches in one pass: per cell the value of the highest seq that isn't null, and its origin (`base` if none is).

    One aggregation whose partial results are combined before the shuffle; any number of batches costs no more.
    """
    there = F.col("value").isNotNull()
    # A null ordering key is never the maximum.
    rank = F.when(there, F.col("seq"))
    merged = batches.groupBy(*cell).agg(F.max_by("value", rank).alias("value"), F.max_by("batch", rank).alias("origin"))
    return merged.withColumn("origin", F.coalesce("origin", F.lit("base")))


def discard(batches: DataFrame, excluded: list[str], cell: list[str] = CELL) -> DataFrame:
    """The merge rebuilt without the excluded batches."""
    return consolidate(batches.where(~F.col("batch").isin(*excluded)), cell)


def events(batches: DataFrame, cell: list[str] = CELL) -> DataFrame:
    """Every non-null cell that a batch after the base supplied, with the value before it and whether it changed."""
    order = Window.partitionBy(*cell).orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    seen = batches.withColumn("before_value", F.last("value", ignorenulls=True).over(order))
    out = seen.where((F.col("seq") > 0) & F.col("value").isNotNull())
    return out.select("batch", *cell, "before_value", F.col("value").alias("imported_value"), (~F.col("before_value").eqNullSafe(F.col("value"))).alias("changed"))


def replay(batches: DataFrame, cell: list[str] = CELL) -> DataFrame:
    """The merge in another formulation, to hold against `consolidate`: the last of the non-null rows by number."""
    order = Window.partitionBy(*cell).orderBy(F.col("value").isNotNull().desc(), F.desc("seq"))
    top = batches.withColumn("_k", F.row_number().over(order)).where("_k = 1")
    return top.select(*cell, "value", F.when(F.col("value").isNotNull(), F.col("batch")).otherwise("base").alias("origin"))


def unequal(expected: DataFrame, actual: DataFrame, cell: list[str] = CELL, values: tuple[str, ...] = ("value", "origin")) -> DataFrame:
    """Cells that are missing on one side or differ in any value; nothing if both panels are equal."""
    side = lambda df, tag: df.select(*cell, *[F.col(v).alias(f"{tag}_{v}") for v in values], F.lit(True).alias(f"_{tag}"))
    both = side(expected, "expected").join(side(actual, "actual"), cell, "full")
    differs: Column = F.col("_expected").isNull() | F.col("_actual").isNull()
    for v in values:
        differs = differs | ~F.col(f"expected_{v}").eqNullSafe(F.col(f"actual_{v}"))
    return both.where(differs).drop("_expected", "_actual")


def batch_counts(batches: DataFrame, cell: list[str] = CELL) -> DataFrame:
    """Per batch and table: cells supplied, changed, added and revised."""
    seen = events(batches, cell)
    return seen.groupBy("batch", "table_name").agg(
        F.count("*").alias("supplied"), F.count_if("changed").alias("changed"),
        F.count_if(F.col("before_value").isNull()).alias("added"), F.count_if(F.col("before_value").isNotNull() & F.col("changed")).alias("revised"),
    )


def overlaps(batches: DataFrame) -> DataFrame:
    """Tables that more than one batch after the base supplies, with the batches in order."""
    by = batches.where("seq > 0").groupBy("table_name").agg(F.array_sort(F.collect_set("batch")).alias("batches"))
    return by.where(F.size("batches") > 1).select("table_name", F.array_join("batches", ",").alias("batches"))


def release_counts(origins: DataFrame, base: DataFrame, cell: list[str] = CELL) -> DataFrame:
    """Distinct tables created and updated by origin, without unchanged cells."""
    before = base.select(*cell, F.col("value").alias("_before"))
    old_tables = base.select("table_name").distinct().withColumn("_old", F.lit(True))
    changed = origins.where("origin <> 'base'").join(before, cell, "left").where(~F.col("value").eqNullSafe(F.col("_before")))
    tagged = changed.join(old_tables, "table_name", "left")
    return tagged.groupBy("origin").agg(
        F.countDistinct(F.when(F.col("_old").isNull(), F.col("table_name"))).alias("created"), F.countDistinct(F.when(F.col("_old"), F.col("table_name"))).alias("updated"), F.count("*").alias("cells"))


def metadata_diff(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """Fields that differ between two metadata tables: keys, field, before and after."""
    fields = [c for c in before.columns if c in after.columns and c not in keys]
    side = lambda df, name: df.select(*[F.col(f"`{k}`") for k in keys], *[F.col(f"`{c}`").cast("string").alias(c) for c in fields]).unpivot([F.col(f"`{k}`") for k in keys], [F.col(f"`{c}`") for c in fields], "field", name)
    both = side(before, "before").join(side(after, "after"), [*keys, "field"], "full")
    return both.where(~F.col("before").eqNullSafe(F.col("after")))


def metadata_merge(base: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Incoming rows over base rows. A null that is supplied stays null; a column that is absent inherits the base's."""
    supplied = [c for c in incoming.columns if c not in keys]
    new = incoming.select(*[F.col(f"`{k}`") for k in keys], *[F.col(f"`{c}`").alias(f"new {c}") for c in supplied], F.lit(True).alias("_new"))
    both = base.join(new, keys, "full")
    rest = [c for c in base.columns if c not in keys]
    pick = lambda c: (F.when(F.col("_new"), F.col(f"`new {c}`")).otherwise(F.col(f"`{c}`")) if c in supplied else F.col(f"`{c}`")).alias(c)
    return both.select(*[F.col(f"`{k}`") for k in keys], *[pick(c) for c in rest])


def metadata_issues(datadict: DataFrame, tables: DataFrame, required: list[str]) -> DataFrame:
    """table_name, issue: tables without metadata, metadata without a table, blank required fields, several units."""
    linked = datadict.select(F.col("Table").alias("table_name")).where("table_name IS NOT NULL").distinct()
    real = tables.select("table_name").where("table_name IS NOT NULL").distinct()
    parts = [real.join(linked, "table_name", "left_anti").withColumn("issue", F.lit("missing_metadata")), linked.join(real, "table_name", "left_anti").withColumn("issue", F.lit("missing_table"))]
    blanks = F.array_compact(F.array(*[F.when(F.col(f"`{c}`").isNull() | (F.trim(F.col(f"`{c}`")) == ""), F.lit(f"blank {c}")) for c in required]))
    parts.append(datadict.where("`Table` IS NOT NULL").select(F.col("Table").alias("table_name"), F.explode(blanks).alias("issue")).distinct())
    parts.append(datadict.where("`Table` IS NOT NULL").groupBy(F.col("Table").alias("table_name")).agg(F.countDistinct("Units").alias("_n")).where("_n > 1").select("table_name", F.lit("several_units").alias("issue")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
