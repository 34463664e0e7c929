"""The long panel model: shapes, endpoints, cell classes, parsing and identity checks.

A panel is a long table of batch, seq, table_name, entity, code, year and value (dyadic ones also partner and partner_code).
NULL cells stay: that a year or an entity exists though it holds nothing matters to several operators.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.functions.columns import is_blank, salted_lookup, strip
from panelforge.functions.numbers import is_plain, judge

MONADIC = ("entity", "code")
DYADIC = ("entity", "code", "partner", "partner_code")
ENDPOINTS = ("Earliest", "MostRecent")
#: A year column's name.
YEAR = re.compile(r"[12][0-9]{3}")
#: Decimal or scientific notation in ASCII digits, read leniently.
DECIMAL = r"^[ \t]*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[ \t]*\z"
INFINITY = r"^(?i)[ \t]*[+-]?inf(inity)?[ \t]*\z"


def year_columns(df: DataFrame) -> list[str]:
    return sorted(c for c in df.columns if YEAR.fullmatch(c))


def to_long(wide: DataFrame, keys: list[str]) -> DataFrame:
    """keys, year and value; a column that is neither key, year nor endpoint is an error, never dropped."""
    years = year_columns(wide)
    stray = [c for c in wide.columns if c not in keys and c not in years and c not in ENDPOINTS]
    if stray or not years:
        raise ValueError(f"columns that a series may not have: {stray}" if stray else "a series needs a year column")
    return wide.select(*keys, *[F.col(f"`{y}`").cast("double").alias(y) for y in years]).unpivot(list(keys), years, "year", "value").withColumn("year", F.col("year").cast("int"))


def endpoints(long: DataFrame, by: list[str]) -> DataFrame:
    """The first and last non-null values in year order, per series row."""
    there = F.col("value").isNotNull()
    return long.groupBy(*by).agg(F.min_by("value", F.when(there, F.col("year"))).alias("Earliest"), F.max_by("value", F.when(there, F.col("year"))).alias("MostRecent"))


def to_wide(long: DataFrame, by: list[str], years: list[int]) -> DataFrame:
    """One row per series with a column per year and both endpoints. The years are given, so the plan needs no extra pass."""
    there = F.col("value").isNotNull()
    cells = [F.max(F.when(F.col("year") == y, F.col("value"))).alias(str(y)) for y in years]
    return long.groupBy(*by).agg(*cells, F.min_by("value", F.when(there, F.col("year"))).alias("Earliest"), F.max_by("value", F.when(there, F.col("year"))).alias("MostRecent"))


def densify(long: DataFrame, table: list[str], keys: list[str]) -> DataFrame:
    """Every year between a table's first and last for each of its entities; added cells are null."""
    span = long.groupBy(*table).agg(F.min("year").alias("_from"), F.max("year").alias("_to"))
    rows = long.select(*table, *keys).distinct().join(span, table)
    grid = rows.select(*table, *keys, F.explode(F.sequence("_from", "_to")).alias("year"))
    return grid.join(long.select(*table, *keys, "year", "value"), [*table, *keys, "year"], "left")


#: Blocks of the roster that tables meet one by one.
BLOCKS = 16


def _expected(long: DataFrame, roster: DataFrame, table: list[str]) -> DataFrame:
    """Every roster entry for every table, which is what is asked for: each table meets each block of the roster."""
    parts = roster.select("entity", "code", F.pmod(F.xxhash64("code"), F.lit(BLOCKS)).cast("int").alias("_block"))
    each = long.select(*table).distinct().withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1))))
    return each.join(parts, "_block").select(*table, "entity", "code")


def absent_entities(long: DataFrame, roster: DataFrame, table: list[str]) -> DataFrame:
    """Roster entries without a row in a table."""
    return _expected(long, roster, table).join(long.select(*table, "code").distinct(), [*table, "code"], "left_anti").select(*table, "entity", "code")


def pad_roster(long: DataFrame, roster: DataFrame, table: list[str]) -> DataFrame:
    """Null rows for roster entities that a monadic table lacks, over the table's own years."""
    added = absent_entities(long, roster, table).join(long.select(*table, "year").distinct(), table).withColumn("value", F.lit(None).cast("double"))
    columns = [*table, "entity", "code", "year", "value"]
    return long.select(*columns).unionByName(added.select(*columns))


def text_class(value: Column, tokens: list[str], numeric_tokens: list[float]) -> Column:
    """What represents a cell that is stored as text."""
    number = F.when(value.rlike(DECIMAL), strip(value).try_cast("double"))
    return (
        F.when(value.isNull(), "sql_null").when(value == "", "empty_string").when(is_blank(value), "whitespace_string")
        .when(strip(value).isin(*tokens), "declared_string_token").when(number.isin(*numeric_tokens), "declared_numeric_token")
        .when(number.isNotNull() & (F.abs(number) < F.lit(float("inf"))), "numeric_text").otherwise("invalid_value")
    )


def number_class(value: Column, numeric_tokens: list[float]) -> Column:
    """What represents a cell that is stored as a number."""
    finite = ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))
    return F.when(value.isNull(), "sql_null").when(~finite, "invalid_value").when(value.isin(*numeric_tokens), "declared_numeric_token").when(value == 0, "numeric_zero").otherwise("numeric")


def lenient(value: Column, tokens: list[str], numeric_tokens: list[float]) -> tuple[Column, Column]:
    """The number of a text cell (null where missing) and whether it fails: not a finite number and no missing token."""
    kind = text_class(value, tokens, numeric_tokens)
    number = F.when(kind == "numeric_text", strip(value).try_cast("double"))
    return number, kind == "invalid_value"


def strict(df: DataFrame, value: str) -> DataFrame:
    """df with `number`, `action` (blank_to_null, infinity_to_null, numeric_text_to_double) and `error` of exact decimal text.

    Each distinct odd text is judged once: overflow, underflow, lost precision or syntax are errors.
    """
    c = F.col(f"`{value}`")
    action = F.when(c.isNull(), None).when(is_blank(c), "blank_to_null").when(c.rlike(INFINITY), "infinity_to_null").otherwise("numeric_text_to_double")
    numeric = F.coalesce(action == "numeric_text_to_double", F.lit(False))
    tagged = df.withColumns({"_act": action, "_odd": numeric & ~F.coalesce(is_plain(c), F.lit(False)), "_t": c})
    odd = tagged.where("_odd")
    book = judge(odd.select(F.col("_t").alias("value")).distinct()).select(F.col("value").alias("_t"), F.col("detail").alias("_why"))
    # Only texts that no pattern settles meet the dictionary.
    judged = salted_lookup(odd, book, ["_t"]).unionByName(tagged.where("NOT _odd").withColumn("_why", F.lit(None).cast("string")))
    number = F.when((F.col("_act") == "numeric_text_to_double") & F.col("_why").isNull(), F.regexp_replace("_t", r"[ \t]", "").try_cast("double"))
    return judged.withColumns({"number": number, "action": F.when(F.col("_why").isNull(), F.col("_act")), "error": F.col("_why")}).drop("_act", "_t", "_why", "_odd")


def scaled(value: Column, multiplier: float, least: float | None = None, most: float | None = None) -> tuple[Column, Column]:
    """value times multiplier, and the violation: not_finite, below or above the inclusive bounds, or null."""
    out = value * F.lit(multiplier)
    why = F.when(F.isnan(out) | (F.abs(out) == F.lit(float("inf"))), "not_finite")
    if least is not None:
        why = why.when(out < least, "value_below_bound")
    if most is not None:
        why = why.when(out > most, "value_above_bound")
    return out, why


def identity_violations(rows: DataFrame, table: list[str]) -> DataFrame:
    """table, rule, key and n: blank keys, repeated keys, names with several codes and codes with several names.

    Four aggregations of the same rows; each is combined before its shuffle, so a key that holds most rows is one row then.
    """
    e, c = F.col("entity"), F.col("code")
    blank = rows.where(e.isNull() | c.isNull() | is_blank(e) | is_blank(c) | (strip(e) != e) | (strip(c) != c)).groupBy(*table).agg(F.count("*").alias("n")).select(*table, F.lit("blank_or_untrimmed_key").alias("rule"), F.lit("").alias("key"), "n")
    full = rows.where(e.isNotNull() & c.isNotNull())
    pair = full.groupBy(*table, "entity", "code").agg(F.count("*").alias("n"))
    repeated = pair.where("n > 1").select(*table, F.lit("repeated_key").alias("rule"), F.concat_ws(" | ", "entity", "code").alias("key"), "n")
    names = pair.groupBy(*table, "entity").agg(F.count("*").alias("n")).where("n > 1").select(*table, F.lit("name_with_several_codes").alias("rule"), F.col("entity").alias("key"), "n")
    codes = pair.groupBy(*table, "code").agg(F.count("*").alias("n")).where("n > 1").select(*table, F.lit("code_with_several_names").alias("rule"), F.col("code").alias("key"), "n")
    return blank.unionByName(repeated).unionByName(names).unionByName(codes)


def without_violating(batches: DataFrame, violations: DataFrame) -> DataFrame:
    """Batches without the tables that hold a violation: one bad cell skips its whole table of that batch."""
    return batches.join(violations.select("batch", "table_name").distinct(), ["batch", "table_name"], "left_anti")
