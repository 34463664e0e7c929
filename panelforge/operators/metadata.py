"""Metadata of series: casts by declaration, plans against a base, checked merges, and the last event of each cell.

Rows that break a rule are reported with it rather than dropped or raised one by one; callers decide by `issue`.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.functions.columns import is_blank, squeeze, strip
from panelforge.operators.panel import DECIMAL, INFINITY

# Fields without which a metadata row says nothing, what the older merge generates, and its defaults.
REQUIRED = ("Table", "Variable", "Definition", "Units", "Source")
GENERATED = ("Last IFs Update", "Years")
DEFAULTS = {"UsedInHistAnalog": 0, "UsedInFunctions": 0, "Decimal Places": 5}


def declared_type(declaration: str) -> str:
    """string, bigint or double for a declared column type of the base; another one is an error."""
    kind = " ".join(declaration.upper().split()).replace(" (", "(")
    if kind in ("TEXT", "CLOB") or re.fullmatch(r"(VAR)?CHAR(\([0-9]+\))?", kind):
        return "string"
    if kind == "INT" or re.fullmatch(r"INTEGER(\([0-9]+\))?", kind):
        return "bigint"
    if kind in ("DOUBLE(53)", "DOUBLE", "REAL", "FLOAT"):
        return "double"
    raise ValueError(f"no metadata type: {declaration}")


def integer(text: Column) -> tuple[Column, Column]:
    """The whole number that a text holds exactly (null for null, blank and infinite ones), and whether the text fails.

    Decimal text with a fraction of zeros or with an exponent counts; anything beyond 64 bits fails.
    """
    t = strip(text)
    empty = t.isNull() | (t == "") | t.rlike(INFINITY)
    plain = t.rlike(r"^[+-]?[0-9]+(\.0*)?\z")
    power = t.rlike(DECIMAL) & t.rlike("(?i)e")
    exact = t.try_cast("decimal(38,18)")
    number = (
        F.when(plain, F.regexp_replace(t, r"\.0*$", "").try_cast("bigint")).when(t.rlike(r"^[+-]?\.0+\z"), F.lit(0).cast("bigint"))
        .when(power & (exact == F.floor(exact)), exact.try_cast("decimal(20,0)").try_cast("bigint"))
    )
    return F.when(~empty, number), ~empty & number.isNull()


def cast_declared(rows: DataFrame, declared: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Text metadata rows cast by the declared types of their columns, and the cells that don't fit (row_id, field, raw).

    Numbers in text columns stay as they are written; columns that nothing declares are an error.
    """
    stray = [c for c in rows.columns if c != "row_id" and c not in declared]
    if stray:
        raise ValueError(f"columns without a declaration: {stray}")
    out, bad = [F.col("row_id")], []
    for c in [c for c in rows.columns if c != "row_id"]:
        kind, raw = declared_type(declared[c]), F.col(f"`{c}`").cast("string")
        if kind == "bigint":
            value, failed = integer(raw)
        elif kind == "double":
            number = F.when(raw.rlike(DECIMAL), strip(raw).try_cast("double"))
            value = F.when(F.abs(number) < F.lit(float("inf")), number)
            failed = raw.isNotNull() & ~is_blank(raw) & ~raw.rlike(INFINITY) & value.isNull()
        else:
            value, failed = raw, F.lit(False)
        out.append(value.alias(c))
        bad.append(F.when(F.coalesce(failed, F.lit(False)), F.struct(F.lit(c).alias("field"), raw.alias("raw"))))
    failures = rows.select("row_id", F.explode(F.array_compact(F.array(*bad))).alias("_b")).select("row_id", "_b.field", "_b.raw")
    return rows.select(*out), failures


def of_tables(datadict: DataFrame, tables: DataFrame) -> DataFrame:
    """The metadata rows of the selected tables (table_name)."""
    return datadict.join(tables.select(F.col("table_name").alias("Table")).distinct(), "Table", "left_semi").select(*[F.col(f"`{c}`") for c in datadict.columns])


def plan(base: DataFrame, incoming: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Incoming rows in the base's columns and order, and what was done (row_id, field, rule, before, after).

    incoming has row_id. An absent column inherits the value of the base row of the same Table and Variable, else null. Units
    that differ from the table's one base wording by case and spacing only keep that wording. Columns that the base doesn't
    have are an error; an inherited field whose base row is ambiguous has the rule `ambiguous_base` and stays null.
    """
    fields = list(base.columns)
    supplied = [c for c in incoming.columns if c != "row_id"]
    unknown = [c for c in supplied if c not in fields]
    missing = [c for c in ("Table", "Variable") if c not in supplied]
    if unknown or missing:
        raise ValueError(f"columns unknown to the base: {unknown}" if unknown else f"columns that link rows are missing: {missing}")
    absent = [c for c in fields if c not in supplied]
    key = ["_tab", "_var"]
    prior = base.groupBy(F.col("Table").alias("_tab"), F.col("Variable").alias("_var")).agg(F.count("*").alias("_n"), *[F.first(f"`{c}`").alias(f"base {c}") for c in absent])
    units = base.groupBy(F.col("Table").alias("_tab")).agg(F.countDistinct(F.coalesce("Units", F.lit(""))).alias("_u"), F.max("Units").alias("_units"))
    met = incoming.withColumns({"_tab": F.col("Table"), "_var": F.col("Variable")}).join(prior, key, "left").join(units, "_tab", "left")
    out, events = [F.col("row_id")], []
    event = lambda when, field, rule, before, after: F.when(when, F.struct(F.lit(field).alias("field"), rule.alias("rule"), before.cast("string").alias("before"), after.cast("string").alias("after")))
    for c in fields:
        if c in absent:
            value = F.when(F.col("_n") == 1, F.col(f"`base {c}`"))
            rule = F.when(F.col("_n") > 1, "ambiguous_base").when(F.col("_n") == 1, "retain_absent_metadata_field").otherwise("add_unresolved_metadata_field")
            events.append(event(F.lit(True), c, rule, F.lit(None), value))
        elif c == "Units":
            alike = (F.col("_u") == 1) & (F.lower(squeeze(F.col("Units"))) == F.lower(squeeze(F.col("_units")))) & (F.col("Units") != F.col("_units")) & (squeeze(F.col("_units")) != "")
            value = F.when(alike, F.col("_units")).otherwise(F.col("Units"))
            events.append(event(F.coalesce(alike, F.lit(False)), c, F.lit("retain_base_unit_label"), F.col("Units"), F.col("_units")))
        else:
            value = F.col(f"`{c}`")
        out.append(value.alias(c))
    done = F.array_compact(F.array(*events)) if events else F.array().cast("array<struct<field:string,rule:string,before:string,after:string>>")
    log = met.select("row_id", F.explode(done).alias("_e")).select("row_id", "_e.*")
    return met.select(*out), log


def merge_issues(base: DataFrame, incoming: DataFrame, tables: DataFrame | None = None) -> DataFrame:
    """table_name and issue of each table whose incoming metadata can't be merged; no row if all can.

    missing_source_metadata (a table of `tables` without a row), blank_required, duplicate_source, duplicate_base,
    several_source_units, units_changed (trimmed, against any base row), vanished_variable.
    """
    name = lambda df, issue: df.select(F.col("Table").alias("table_name"), F.lit(issue).alias("issue")).distinct()
    told = of_tables(base, incoming.select(F.col("Table").alias("table_name")))
    blank = [F.coalesce(is_blank(F.col(f"`{c}`")), F.lit(True)) for c in REQUIRED]
    unit = strip(F.col("Units"))
    both = lambda df: df.groupBy("Table", "Variable").agg(F.count("*").alias("n")).where("n > 1")
    mine, theirs = incoming.select("Table", unit.alias("u")).where("u IS NOT NULL").distinct(), told.select("Table", unit.alias("b")).where("b IS NOT NULL").distinct()
    parts = [
        name(incoming.where(blank[0] | blank[1] | blank[2] | blank[3] | blank[4]), "blank_required"), name(both(incoming), "duplicate_source"), name(both(told), "duplicate_base"),
        name(incoming.groupBy("Table").agg(F.countDistinct(F.coalesce("Units", F.lit(""))).alias("n")).where("n > 1"), "several_source_units"),
        name(mine.join(theirs, "Table").where("u <> b"), "units_changed"),
        name(told.select("Table", "Variable").join(incoming.select("Table", "Variable"), ["Table", "Variable"], "left_anti"), "vanished_variable"),
    ]
    if tables is not None:
        parts.append(name(tables.select(F.col("table_name").alias("Table")).join(incoming.select("Table"), "Table", "left_anti"), "missing_source_metadata"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def generated(merged: DataFrame, panel: DataFrame, today: str) -> DataFrame:
    """Merged rows with generated fields: the update stamp, the span of populated years, and defaults for three nulls."""
    y = F.when(F.col("value").isNotNull(), F.col("year"))
    span = panel.groupBy(F.col("table_name").alias("Table")).agg(F.coalesce(F.concat_ws("-", F.min(y).cast("string"), F.max(y).cast("string")), F.lit("")).alias("_span"))
    out = merged.join(span, "Table", "left")
    made = {}
    if "Last IFs Update" in merged.columns:
        made["Last IFs Update"] = F.lit(today)
    if "Years" in merged.columns:
        made["Years"] = F.coalesce("_span", F.lit(""))
    made |= {c: F.coalesce(F.col(f"`{c}`"), F.lit(v).cast(dict(merged.dtypes)[c])) for c, v in DEFAULTS.items() if c in merged.columns}
    return out.withColumns(made).select(*[F.col(f"`{c}`") for c in merged.columns])


def year_span_issues(datadict: DataFrame, panel: DataFrame) -> DataFrame:
    """Metadata rows whose Years isn't the span of the years that their table populates: table_name, stated, observed."""
    y = F.when(F.col("value").isNotNull(), F.col("year"))
    span = panel.groupBy("table_name").agg(F.coalesce(F.concat_ws("-", F.min(y).cast("string"), F.max(y).cast("string")), F.lit("")).alias("observed"))
    stated = datadict.select(F.col("Table").alias("table_name"), F.col("Years").alias("stated")).where("coalesce(stated, '') <> ''")
    return stated.join(span, "table_name").where("stated <> observed").distinct()


def last_events(events: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last event of each key, by `order`; one pass whose partial results are combined before the shuffle."""
    rest = [c for c in events.columns if c not in keys]
    top = events.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_e"))
    return top.select(*keys, *[F.col(f"_e.`{c}`").alias(c) for c in rest])


def newest(datadict: DataFrame, stamp: str = "Last IFs Update") -> DataFrame:
    """One row per Table and Variable: the one updated last; of equal stamps the largest text."""
    rest = [c for c in datadict.columns if c not in ("Table", "Variable", stamp)]
    order = Window.partitionBy("Table", "Variable").orderBy(F.col(f"`{stamp}`").desc_nulls_last(), F.to_json(F.struct(*[F.col(f"`{c}`") for c in rest])).desc())
    return datadict.withColumn("_k", F.row_number().over(order)).where("_k = 1").drop("_k")
