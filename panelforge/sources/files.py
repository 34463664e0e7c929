"""Sources of panels: long and wide CSV, CSV inside (nested) zip archives, SQLite series, Parquet."""

from __future__ import annotations

import csv
import io
import itertools
import re
import sqlite3
import zipfile
from collections.abc import Iterator
from typing import IO
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from panelforge.functions.columns import is_blank, salted_lookup, strip
from panelforge.operators import panel
from panelforge.session import ship
from panelforge.sources.recipes import Recipe


def header_of(spark: SparkSession, path: str) -> list[str]:
    """The column names of a CSV file; repeated names are an error."""
    first = spark.read.option("header", False).option("inferSchema", False).csv(path).limit(1).collect()
    names = [str(x).lstrip("﻿") for x in first[0]] if first else []
    if not names or len(set(names)) < len(names):
        raise ValueError(f"{path}: no header, or one that repeats a name")
    return names


def read_text_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, with `_bad` holding lines of another width; quoted fields may hold line breaks."""
    names = header_of(spark, path)
    schema = StructType([StructField(n, StringType()) for n in [*names, "_bad"]])
    return spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad").option("enforceSchema", True).csv(path)


# Fixed value: the years that a series may have.
FIRST_YEAR, LAST_YEAR = 1000, 2999


def load_long(rows: DataFrame, recipe: Recipe, roster: DataFrame, alias: DataFrame | None = None) -> DataFrame:
    """Every kept row of a long delivery: table_name, entity, code, year, value and violation (null where it loads).

    Ignored indicators and codes are left out. Violations, first that applies: width, indicator, unit, country, year, value,
    bound, duplicate. Where the recipe declares a unit and a unit column, a missing unit is a violation too. A mapped
    indicator without any row is a row of its own with violation `absent`. alias: source_code and code, where the delivery
    has codes of its own. A roster or alias list that contradicts itself is an error.
    """
    c = {k: F.col(f"`{v}`") for k, v in recipe.columns.items()}
    spark = rows.sparkSession
    book = spark.createDataFrame([(k, i.table, i.unit, float(i.multiplier), i.least, i.most) for k, i in recipe.indicators.items()], "_ind string, table_name string, _unit string, _mul double, _least double, _most double")
    stated = "unit" in c and recipe.columns["unit"] in rows.columns
    named = rows.withColumns({"_ind": strip(c["indicator"]), "_src": strip(c["code"]), "_year": strip(c["year"]), "_text": c["value"], "_u": strip(c["unit"]) if stated else F.lit(None).cast("string")})
    # Texts are read before the look-ups, behind which the planner would read them wherever they are named.
    number, failed = panel.lenient(F.col("_text"), list(recipe.missing), list(recipe.missing_numeric))
    wide = F.col("_bad").isNotNull() if "_bad" in rows.columns else F.lit(False)
    named = named.select("_ind", "_src", "_year", "_u", wide.alias("_wide"), number.alias("_number"), failed.alias("_failed"))
    kept = named.where(~F.coalesce(F.col("_ind").isin(*recipe.ignored_indicators), F.lit(False)) & ~F.coalesce(F.col("_src").isin(*recipe.ignored_codes), F.lit(False)))
    met = salted_lookup(kept, book, ["_ind"])
    known = country_reference(roster.select(F.col("entity").alias("Country"), F.col("code").alias("FIPS_CODE")))
    codes = unique(alias.select(F.col("source_code").alias("_src"), F.col("code").alias("_code")), "_src") if alias is not None else known.select(F.col("code").alias("_src"), F.col("code").alias("_code"))
    met = salted_lookup(met, codes, ["_src"])
    met = salted_lookup(met, known.select(F.col("code").alias("_code"), "entity"), ["_code"])
    met = met.withColumn("value", F.col("_number") * F.col("_mul"))
    year = F.when(F.col("_year").rlike(r"^[0-9]{4}\z"), F.col("_year").cast("int"))
    odd_unit = F.col("_unit").isNotNull() & (F.lit(stated) & ~F.col("_u").eqNullSafe(F.col("_unit")))
    why = (
        F.when(F.col("_wide"), "width").when(F.col("table_name").isNull(), "indicator").when(odd_unit, "unit")
        .when(F.col("entity").isNull(), "country").when(~F.coalesce(year.between(FIRST_YEAR, LAST_YEAR), F.lit(False)), "year")
        .when(F.col("_failed") | (F.abs("value") == F.lit(float("inf"))), "value").when((F.col("value") < F.col("_least")) | (F.col("value") > F.col("_most")), "bound")
    )
    told = met.withColumns({"violation": why, "year": year}).withColumnRenamed("_code", "code")
    key = ["table_name", "code", "year"]
    twice = told.where("violation IS NULL").groupBy(*key).agg(F.count("*").alias("_n")).where("_n > 1").select(*key, F.lit(True).alias("_twice"))
    out = salted_lookup(told, twice, key)
    out = out.select("table_name", "entity", "code", "year", "value", F.coalesce("violation", F.when(F.col("_twice"), "duplicate")).alias("violation"))
    absent = book.select("_ind", "table_name").join(kept.select("_ind").distinct(), "_ind", "left_anti")
    none = F.lit(None)
    return out.unionByName(absent.select("table_name", none.cast("string").alias("entity"), none.cast("string").alias("code"), none.cast("int").alias("year"), none.cast("double").alias("value"), F.lit("absent").alias("violation")))


def unique(pairs: DataFrame, key: str) -> DataFrame:
    """Distinct rows, or an error if one key has several."""
    once = pairs.distinct()
    twice = once.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").limit(5).collect()
    if twice:
        raise ValueError(f"conflicting rows for {sorted(str(r[0]) for r in twice)}")
    return once


def country_reference(rows: DataFrame) -> DataFrame:
    """entity, code and source_code of a country reference (Country, FIPS_CODE and maybe source_code), trimmed and distinct.

    Blank names or codes, a code with several names, a name with several codes, a source code of several countries, and an
    empty reference are errors.
    """
    source = F.col("source_code") if "source_code" in rows.columns else F.col("FIPS_CODE")
    each = rows.select(strip(F.col("Country")).alias("entity"), strip(F.col("FIPS_CODE")).alias("code"), strip(source).alias("source_code")).distinct()
    blank = each.where("coalesce(entity, '') = '' OR coalesce(code, '') = '' OR coalesce(source_code, '') = ''").limit(1).collect()
    if blank or each.isEmpty():
        raise ValueError("a country reference needs rows with a name, a code and a source code each")
    pairs = each.select("entity", "code").distinct()
    unique(pairs, "code"), unique(pairs, "entity")
    return unique(each, "source_code")


def reviewed_mapping(rows: DataFrame, roster: DataFrame) -> DataFrame:
    """original_name and matched_code of a reviewed mapping (original_name, matched_name), as an error or whole.

    Names must be present and unique once trimmed; a target that is given must be a roster entity's name. Blank targets
    stay undecided.
    """
    missing = [c for c in ("original_name", "matched_name") if c not in rows.columns]
    if missing:
        raise ValueError(f"a mapping needs the columns {missing}")
    each = unique(rows.select(strip(F.col("original_name")).alias("original_name"), F.nullif(strip(F.col("matched_name")), F.lit("")).alias("matched_name")), "original_name")
    if not each.where("coalesce(original_name, '') = ''").isEmpty():
        raise ValueError("a mapping has a blank name")
    met = each.join(roster.select(F.col("entity").alias("matched_name"), F.col("code").alias("matched_code")), "matched_name", "left")
    stray = met.where("matched_name IS NOT NULL AND matched_code IS NULL").limit(5).collect()
    if stray:
        raise ValueError(f"targets that the roster doesn't have: {sorted(r['matched_name'] for r in stray)}")
    return met.select("original_name", "matched_code")


def fail_on(rows: DataFrame) -> DataFrame:
    """rows without their violation, or an error that names the first few; one bad row fails the load."""
    bad = rows.where("violation IS NOT NULL").limit(5).collect()
    if bad:
        raise ValueError("rows that don't load: " + "; ".join(str(r.asDict()) for r in bad))
    return rows.drop("violation")


def read_wide_csv(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """A wide CSV of keys and year columns as a long panel; cells that are no numbers are an error.

    Each cell of a line of another width has the violation `width` and no value: its numbers may belong to other years.
    """
    text = read_text_csv(spark, path).withColumn("_wide", F.col("_bad").isNotNull())
    years = panel.year_columns(text)
    long = text.select(*keys, "_wide", *years).unpivot([*keys, "_wide"], years, "year", "raw")
    number, failed = panel.lenient(F.col("raw"), [], [])
    why = F.when(F.col("_wide"), "width").when(failed, "value")
    return long.select(*keys, F.col("year").cast("int").alias("year"), F.when(~F.col("_wide"), number).alias("value"), why.alias("violation"))


def read_zip_csv(spark: SparkSession, path: str, member: str = ".csv") -> DataFrame:
    """archive, member, row_no and fields of the records of CSV files in zip archives, nested ones included.

    Quoted fields may hold line breaks. Members are read as streams; an archive is one task's work.
    """
    ship(spark)

    def members(archive: IO[bytes], prefix: str) -> Iterator[tuple[str, IO[bytes]]]:
        with zipfile.ZipFile(archive) as z:
            for n in sorted(z.namelist()):
                if n.endswith(".zip"):
                    with z.open(n) as inner:
                        yield from members(inner, f"{prefix}{n}/")
                elif n.endswith(member):
                    with z.open(n) as f:
                        yield prefix + n, f

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for archive, data in zip(batch["path"], batch["content"]):
                for name, raw in members(io.BytesIO(data), ""):
                    records = enumerate(csv.reader(io.TextIOWrapper(raw, encoding="utf-8-sig", newline="")))
                    while part := list(itertools.islice(records, 1000)):
                        yield pd.DataFrame({"archive": archive, "member": name, "row_no": [k for k, _ in part], "fields": [f for _, f in part]})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "archive string, member string, row_no int, fields array<string>")


_CELL_REF = re.compile(r"([A-Z]+)[0-9]+")
_SHEET_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def _sheet_rows(book: zipfile.ZipFile, sheet: str) -> Iterator[tuple[int, list[str | None]]]:
    """Row numbers and cells of a workbook's sheet, formulas by their stored values."""
    ns = _SHEET_NS
    links = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
    found = [s for s in ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{ns}sheet") if s.get("name") == sheet]
    if not found:
        raise ValueError(f"no sheet {sheet}")
    shared = []
    if "xl/sharedStrings.xml" in book.namelist():
        shared = ["".join(t.text or "" for t in s.iter(f"{ns}t")) for s in ElementTree.fromstring(book.read("xl/sharedStrings.xml")).iter(f"{ns}si")]
    target = links[found[0].get(_LINK)].lstrip("/")
    with book.open(target if target.startswith("xl/") else f"xl/{target}") as f:
        for _, row in ElementTree.iterparse(f):
            if row.tag != f"{ns}row":
                continue
            cells: dict[int, str | None] = {}
            for c in row.iter(f"{ns}c"):
                place = 0
                for letter in _CELL_REF.match(c.get("r")).group(1):
                    place = place * 26 + ord(letter) - 64
                v, kind = c.find(f"{ns}v"), c.get("t")
                if kind == "inlineStr":
                    cells[place] = "".join(t.text or "" for t in c.iter(f"{ns}t"))
                elif v is not None:
                    cells[place] = shared[int(v.text)] if kind == "s" else v.text
            yield int(row.get("r")), [cells.get(i) for i in range(1, max(cells, default=0) + 1)]
            row.clear()


def read_xlsx(spark: SparkSession, path: str, sheet: str) -> DataFrame:
    """workbook, row_no and cells (as text, null where empty) of one sheet of workbooks; a workbook is one task's work."""
    ship(spark)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, data in zip(batch["path"], batch["content"]):
                with zipfile.ZipFile(io.BytesIO(data)) as book:
                    rows = _sheet_rows(book, sheet)
                    while part := list(itertools.islice(rows, 1000)):
                        yield pd.DataFrame({"workbook": name, "row_no": [k for k, _ in part], "cells": [c for _, c in part]})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "workbook string, row_no int, cells array<string>")


def catalog(spark: SparkSession, path: str) -> DataFrame:
    """name, kind (monadic, dyadic or other), columns, years and rows of each table of a SQLite file."""
    ship(spark)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as db:
                for name in batch["name"]:
                    columns = [r[1] for r in db.execute(f"PRAGMA table_info({_quoted(name)})")]
                    keys = _keys_of(columns)
                    kind = {2: "monadic", 4: "dyadic"}[len(keys)] if keys and name.startswith("Series") else "other"
                    count = db.execute(f"SELECT count(*) FROM {_quoted(name)}").fetchone()[0]
                    yield pd.DataFrame({"name": [name], "kind": [kind], "columns": [columns], "years": [[int(c) for c in columns if panel.YEAR.fullmatch(c)]], "rows": [count]})

    with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as db:
        names = [r[0] for r in db.execute("SELECT name FROM sqlite_master WHERE type = 'table' ORDER BY name")]
    listed = spark.createDataFrame([(n,) for n in names], "name string").repartition(max(1, min(len(names), 200)))
    return listed.mapInPandas(run, "name string, kind string, columns array<string>, years array<int>, rows bigint")


def discover(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """Import files below a folder: file, size, modified, and the day that their name ends in, as a date; newest last.

    pattern: a regular expression for file names. Names without a valid day have none and come first; empty files aren't listed.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select(F.col("path").alias("file"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
    name = F.regexp_extract("file", r"([^/]+)$", 1)
    day = F.expr("try_to_date(replace(regexp_extract(regexp_extract(file, '([^/]+)$', 1), '([0-9]{4}-?[0-9]{2}-?[0-9]{2})[.][^.]*$', 1), '-', ''), 'yyyyMMdd')")
    return listed.where(name.rlike(pattern)).withColumn("day", day).orderBy(F.col("day").asc_nulls_first(), "file")


def inspect(spark: SparkSession, path: str, first: int = 5) -> dict[str, object]:
    """What a file holds: the catalog of a SQLite file, or the columns of a CSV file with its first rows."""
    if path.endswith((".db", ".sqlite")):
        return {"tables": [r.asDict() for r in catalog(spark, path).orderBy("name").toLocalIterator()]}
    rows = read_text_csv(spark, path)
    return {"columns": [c for c in rows.columns if c != "_bad"], "first": [r.asDict() for r in rows.drop("_bad").limit(first).collect()]}


def import_tables(spark: SparkSession, path: str) -> DataFrame:
    """name, listed and there of the tables of an import: those that its metadata lists and those that it holds."""
    held = catalog(spark, path).where("kind <> 'other'").select("name", F.lit(True).alias("there"))
    with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as db:
        if db.execute("PRAGMA quick_check").fetchone()[0] != "ok":
            raise ValueError(f"{path} is damaged")
        known = db.execute("SELECT 1 FROM sqlite_master WHERE name = 'DataDict'").fetchone()
        listed = db.execute('SELECT DISTINCT "Table" FROM DataDict WHERE "Table" IS NOT NULL').fetchall() if known else []
    named = spark.createDataFrame(listed, "name string").withColumn("listed", F.lit(True))
    return named.join(held, "name", "full").select("name", F.coalesce("listed", F.lit(False)).alias("listed"), F.coalesce("there", F.lit(False)).alias("there"))


def read_selected(spark: SparkSession, path: str, tables: list[str] | None = None) -> DataFrame:
    """Cells of the series that an import's metadata lists, or of a part of them; a selected table that is missing is an error."""
    told = {r["name"]: r for r in import_tables(spark, path).collect()}
    wanted = sorted(n for n, r in told.items() if r["listed"]) if tables is None else tables
    bad = [n for n in wanted if n not in told or not told[n]["listed"] or not told[n]["there"]]
    if bad or len(set(wanted)) < len(wanted):
        raise ValueError(f"tables that the import doesn't list and hold, or named twice: {bad or wanted}")
    return read_sqlite(spark, path, wanted)


def _quoted(n: str) -> str:
    return '"' + n.replace('"', '""') + '"'


def _keys_of(columns: list[str]) -> tuple[str, ...] | None:
    """The key columns of a series, monadic or dyadic."""
    return next((k for k in (("Country", "FIPS_CODE"), ("Actor", "Actor_FIPS", "Partner", "Partner_FIPS")) if set(k) <= set(columns)), None)


def sqlite_tables(path: str) -> list[str]:
    """Tables of a SQLite file whose names begin as series do."""
    with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as db:
        return [r[0] for r in db.execute("SELECT name FROM sqlite_master WHERE type = 'table' AND name GLOB 'Series*' ORDER BY name")]


def read_sqlite(spark: SparkSession, path: str, tables: list[str] | None = None) -> DataFrame:
    """Cells of the series in a SQLite file that all executors can read: table_name, keys, year, raw and storage_type.

    Tables are spread over tasks; each is read as a stream of rows. Dyadic series have partner and partner_code.
    """
    ship(spark)
    names = sqlite_tables(path) if tables is None else tables
    schema = "table_name string, entity string, code string, partner string, partner_code string, year int, raw string, storage_type string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as db:
                for name in batch["table_name"]:
                    columns = [r[1] for r in db.execute(f"PRAGMA table_info({_quoted(name)})")]
                    keys = _keys_of(columns)
                    years = [c for c in columns if panel.YEAR.fullmatch(c)]
                    if keys is None or not years:
                        raise ValueError(f"{name} is no series")
                    cells = ", ".join(f"CAST({_quoted(y)} AS TEXT), typeof({_quoted(y)})" for y in years)
                    cursor = db.execute(f"SELECT {', '.join(map(_quoted, keys))}, {cells} FROM {_quoted(name)}")
                    while rows := cursor.fetchmany(500):
                        out = []
                        for r in rows:
                            who = [*r[: len(keys)], *[None] * (4 - len(keys))]
                            out += [(name, *who, int(y), r[len(keys) + 2 * i], r[len(keys) + 2 * i + 1]) for i, y in enumerate(years)]
                        yield pd.DataFrame(out, columns=["table_name", "entity", "code", "partner", "partner_code", "year", "raw", "storage_type"])

    listed = spark.createDataFrame([(n,) for n in names], "table_name string").repartition(max(1, min(len(names), 200)))
    return listed.mapInPandas(run, schema)


def strict_cells(raw: DataFrame) -> DataFrame:
    """Cells of `read_sqlite` as numbers: value, missing (sql_null, empty_string, whitespace) and violation. Text is an error."""
    blank = (F.col("storage_type") == "text") & is_blank(F.col("raw"))
    missing = F.when(F.col("storage_type") == "null", "sql_null").when(blank & (F.col("raw") == ""), "empty_string").when(blank, "whitespace")
    number = F.when(F.col("storage_type").isin("integer", "real"), F.col("raw").try_cast("double"))
    exact = (F.col("storage_type") != "integer") | (number.cast("decimal(38,0)") == F.col("raw").try_cast("decimal(38,0)"))
    fine = number.isNotNull() & ~F.isnan(number) & (F.abs(number) < F.lit(float("inf"))) & exact
    return raw.withColumns({"value": F.when(fine, number), "missing": missing, "violation": F.when(missing.isNull() & ~F.coalesce(fine, F.lit(False)), "value")})
