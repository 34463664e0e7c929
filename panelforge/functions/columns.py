"""Column helpers that stay inside the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Copies of a lookup row among which the rows of one hot key are spread.
SALTS = 16


def squeeze(c: Column) -> Column:
    """Text without white space at its ends and with single blanks inside."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def strip(c: Column) -> Column:
    """Text without white space of any kind at its ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def is_blank(c: Column) -> Column:
    """Whether a text is empty or white space only; null for null."""
    return c.rlike(r"(?U)^\s*\z")


def code_key(c: Column) -> Column:
    """A code trimmed and in upper case; null if nothing is left."""
    return F.nullif(F.upper(strip(c)), F.lit(""))


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


#: Columns that tell rows apart, of which the first that is there spreads them.
IDS = ("row_id", "doc_id", "record_id", "change_id", "item_id")


def salted_lookup(rows: DataFrame, lookup: DataFrame, on: list[str], how: str = "left", salts: int = SALTS) -> DataFrame:
    """Join rows to a lookup that is unique in `on`, spreading the rows of each key over `salts` partitions.

    The lookup is copied `salts` times, so a key that holds a third of all rows is met by that many tasks. A lookup small
    enough for spark.sql.autoBroadcastJoinThreshold is broadcast by the planner from its measured size and the salt is idle.
    Only `inner`, `left`, `left_semi` and `left_anti` keep this meaning. The salt is a hash of the row's id, or of all its
    columns where it has none: a task that is run again salts its rows as before.
    """
    salt = "_salt"
    by = [c for c in IDS if c in rows.columns and c not in on][:1] or [c for c, t in rows.dtypes if "map<" not in t and "variant" not in t]
    spread = rows.withColumn(salt, F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in by]), F.lit(salts)).cast("int"))
    copies = lookup.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return spread.join(copies, [*on, salt], how).drop(salt)
