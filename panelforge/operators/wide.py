"""Problem 3: entity-attribute-value rows into one wide row per entity, as log-structured upserts.

Each batch becomes a run: a sparse wide delta with one row per key and one cell per listed attribute, which holds the latest
value of the batch with its version, or nothing. Runs are sorted by key and stored in the shared folder. `compact` merges any
number of runs, stored or not, by the latest version per cell; `widen` gives the cells of the result their types, `filled`
lists them. A version is (received, row id), so a run may be merged late, twice or in any order and the result stays the same.

Defined results. Rows without a full key, a listed attribute or a value that loads make no cell. An emptied or failed
redelivery doesn't erase what loaded before. Of rows with an equal time the larger row id wins; exact copies are one cell.
An empty table gives no rows and all columns. Attributes may be called as keys are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.session import cut

#: Rows are collected into runs of so many days of receipt.
RUN_DAYS = 183


def _cells(attributes: list[str]) -> list[str]:
    """Names of the cells of runs, in the order of the attributes."""
    return [f"_cell{i}" for i in range(len(attributes))]


def deltas(rows: DataFrame, keys: list[str], attribute: str, attributes: list[str], run_days: int = RUN_DAYS, stored: bool = True) -> DataFrame:
    """The runs of all batches: per key and run the latest cell of each attribute, as a struct of version and text.

    rows needs keys, attribute, received_at, row_id and cell. Redeliveries are collapsed before the shuffle. One pass and one
    aggregation, however many attributes there are; its rows leave it sorted by key, and stay so in the shared folder.
    """
    run = F.floor(F.unix_seconds("received_at") / F.lit(run_days * 86400)).alias("run")
    version = F.struct("received_at", "row_id", "cell")
    latest = [F.max(F.when(F.col(attribute) == a, version)).alias(c) for a, c in zip(attributes, _cells(attributes))]
    out = rows.where(F.col(attribute).isin(*attributes)).groupBy(*keys, run).agg(*latest)
    return cut(out) if stored else out


def compact(runs: list[DataFrame], keys: list[str], attributes: list[str]) -> DataFrame:
    """One compacted run out of several: per key and attribute the cell of the latest version."""
    parts = [r.select(*keys, *_cells(attributes)) for r in runs]
    return reduce(DataFrame.unionByName, parts).groupBy(*keys).agg(*[F.max(c).alias(c) for c in _cells(attributes)])


def filled(compacted: DataFrame, keys: list[str], attribute: str, attributes: list[str]) -> DataFrame:
    """One row per filled cell: keys and attribute."""
    names = F.array_compact(F.array(*[F.when(F.col(c).isNotNull(), F.lit(a)) for a, c in zip(attributes, _cells(attributes))]))
    return compacted.select(*keys, F.explode(names).alias(attribute))


def widen(compacted: DataFrame, keys: list[str], columns: dict[str, str]) -> DataFrame:
    """One row per key with a typed column for each attribute of `columns` (name: integer, decimal, flag or label)."""
    text = lambda cell: F.col(cell)["cell"]
    bare = lambda cell: F.regexp_replace(text(cell), r"^[ \t]+|[ \t]+$", "")
    typed = {
        # A whole number beyond 38 digits stays readable as a double only; the long column is null then.
        "integer": lambda cell: F.coalesce(bare(cell).try_cast("bigint"), bare(cell).try_cast("double").try_cast("bigint")),
        "decimal": lambda cell: bare(cell).try_cast("double"),
        "flag": lambda cell: F.lower(F.trim(text(cell))).isin("y", "yes", "true", "1"),
        "label": text,
    }
    return compacted.select(*keys, *[typed[kind](cell).alias(name) for (name, kind), cell in zip(columns.items(), _cells(list(columns)))])
