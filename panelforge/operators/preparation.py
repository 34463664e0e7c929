"""Preparation of imports: names by code, canonical schemas, percentages, labels of a second source, and package projection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.functions.columns import is_blank, salted_lookup, strip
from panelforge.operators.panel import ENDPOINTS, YEAR, endpoints
from panelforge.operators.repair import multiset_difference


def name_view(rows: DataFrame, roster: DataFrame, table: list[str]) -> tuple[DataFrame, DataFrame]:
    """rows with the canonical name of their code, and what forbids that: unknown_code and repeated_key per table and code."""
    known = roster.select("code", F.col("entity").alias("_canonical"))
    met = salted_lookup(rows, known, ["code"])
    unknown = met.where("_canonical IS NULL").select(*table, "code").distinct().withColumn("issue", F.lit("unknown_code"))
    cell = [c for c in (*table, "code", "year") if c in rows.columns]
    repeated = rows.groupBy(*cell).agg(F.count("*").alias("n")).where("n > 1").select(*table, "code").distinct().withColumn("issue", F.lit("repeated_key"))
    view = met.withColumn("entity", F.coalesce("_canonical", "entity")).select(*rows.columns)
    return view, unknown.unionByName(repeated)


def canonical_schema(wide: DataFrame, keys: list[str]) -> DataFrame:
    """A delivered table in canonical form: keys as text, years in number order as doubles, endpoints recomputed behind them.

    A column that is none of these is an error, and so is text in a year column that is no number.
    """
    years = sorted(c for c in wide.columns if YEAR.fullmatch(c))
    stray = [c for c in wide.columns if c not in keys and c not in years and c not in ENDPOINTS]
    if stray or not years:
        raise ValueError(f"columns that a series may not have: {stray}" if stray else "a series needs a year column")
    cells = {y: F.col(f"`{y}`").cast("double") for y in years}
    there = F.array_compact(F.array(*cells.values()))
    ends = (F.try_element_at(there, F.lit(1)).alias(ENDPOINTS[0]), F.try_element_at(there, F.lit(-1)).alias(ENDPOINTS[1]))
    return wide.select(*[F.col(f"`{k}`").cast("string").alias(k) for k in keys], *[c.alias(y) for y, c in cells.items()], *ends)


def percentages(cells: DataFrame, approved: DataFrame | None = None) -> DataFrame:
    """cells (key, raw) with value, a hundred times the fraction, unrounded, and violation.

    Null and blank cells are null; `#VALUE!` is null where `approved` (key) names the cell, and fails elsewhere, as other text does.
    """
    text = strip(F.col("raw"))
    allowed = approved.select("key", F.lit(True).alias("_ok")).distinct() if approved is not None else None
    met = cells.join(allowed, "key", "left") if allowed is not None else cells.withColumn("_ok", F.lit(None).cast("boolean"))
    number = F.when(text.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z"), text.try_cast("double"))
    missing = F.col("raw").isNull() | is_blank(F.col("raw")) | ((text == "#VALUE!") & F.coalesce("_ok", F.lit(False)))
    value = F.when(~missing & (F.abs(number) < F.lit(float("inf"))), number * 100)
    return met.withColumns({"value": value, "violation": F.when(~missing & value.isNull(), "value")}).drop("_ok")


def code_labels(labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One label per code of a second source (code, label), and the codes that bear several, which get none."""
    each = labels.select(strip(F.col("code")).alias("code"), strip(F.col("label")).alias("label")).where("code <> '' AND label <> ''").distinct()
    per = each.groupBy("code").agg(F.array_sort(F.collect_set("label")).alias("labels"))
    return per.where(F.size("labels") == 1).select("code", F.get("labels", F.lit(0)).alias("label")), per.where(F.size("labels") > 1)


def package(batch: DataFrame, datadict: DataFrame, applied: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The part of an import that was applied: its cells and metadata rows of the tables in `applied` (table_name)."""
    kept = applied.select("table_name").distinct()
    rows = batch.join(kept, "table_name", "left_semi").select(*batch.columns)
    meta = datadict.join(kept.withColumnRenamed("table_name", "Table"), "Table", "left_semi").select(*[F.col(f"`{c}`") for c in datadict.columns])
    return rows, meta


def package_differences(original: DataFrame, projected: DataFrame) -> DataFrame:
    """Rows by which a stored package differs from the same tables of its import, as multisets; none if it is faithful."""
    tables = projected.select("table_name").distinct()
    return multiset_difference(original.join(tables, "table_name", "left_semi").select(*original.columns), projected.select(*original.columns))


def stale_endpoints(long: DataFrame, stored: DataFrame, by: list[str]) -> DataFrame:
    """Series whose stored Earliest or MostRecent isn't what their cells say."""
    now = endpoints(long, by)
    was = stored.select(*by, *[F.col(c).alias(f"stored_{c}") for c in ENDPOINTS])
    return now.join(was, by).where(" OR ".join(f"NOT ({c} <=> stored_{c})" for c in ENDPOINTS))
