"""Metadata casts, plans and merges, and the preparation of imports."""

import pytest
from pyspark.sql import functions as F

from panelforge.operators import metadata, preparation


def test_whole_numbers_are_exact(spark):
    want = {"7": 7, "7.0": 7, " -39 ": -39, "1e3": 1000, ".0": 0, "9223372036854775807": 2**63 - 1, "": None, "inf": None, None: None, "7.5": "x", "9223372036854775808": "x", "1e-3": "x", "many": "x", "1,000": "x", "1e30": "x"}
    number, failed = metadata.integer(F.col("t"))
    got = {r["t"]: "x" if r["f"] else r["n"] for r in spark.createDataFrame([(t,) for t in want], "t string").select("t", number.alias("n"), failed.alias("f")).collect()}
    assert got == want


def test_casts_by_declaration(spark):
    assert [metadata.declared_type(x) for x in ("varchar (255)", "TEXT", "integer", "DOUBLE(53)")] == ["string", "string", "bigint", "double"]
    with pytest.raises(ValueError):
        metadata.declared_type("BLOB")
    rows = spark.createDataFrame([(1, "T", "5", "1.5"), (2, "U", "many", "x"), (3, None, "", None)], "row_id int, `Table` string, `Decimal Places` string, Share string")
    cast, bad = metadata.cast_declared(rows, {"Table": "TEXT", "Decimal Places": "INTEGER", "Share": "DOUBLE(53)"})
    assert [tuple(r) for r in cast.orderBy("row_id").collect()] == [(1, "T", 5, 1.5), (2, "U", None, None), (3, None, None, None)]
    assert {tuple(r) for r in bad.collect()} == {(2, "Decimal Places", "many"), (2, "Share", "x")}
    with pytest.raises(ValueError, match="declaration"):
        metadata.cast_declared(rows, {"Table": "TEXT"})


BASE = "`Table` string, Variable string, Definition string, Units string, Source string, Notes string"


def test_plans_inherit_and_keep_unit_wording(spark):
    base = spark.createDataFrame([("T", "V", "d", "Mil  Persons", "s", "n"), ("U", "V", "d", "k", "s", "a"), ("U", "V", "d", "k", "s", "b")], BASE)
    new = spark.createDataFrame([(1, "T", "V", "mil persons", "s2"), (2, "U", "V", "K", "s"), (3, "W", "V", "x", "s")], "row_id int, `Table` string, Variable string, Units string, Source string")
    planned, log = metadata.plan(base, new)
    got = {r["row_id"]: (r["Units"], r["Notes"], r["Source"]) for r in planned.collect()}
    assert got == {1: ("Mil  Persons", "n", "s2"), 2: ("k", None, "s"), 3: ("x", None, "s")} and planned.columns == ["row_id", *base.columns]
    rules = {(r["row_id"], r["field"], r["rule"]) for r in log.collect()}
    assert {(1, "Units", "retain_base_unit_label"), (1, "Notes", "retain_absent_metadata_field"), (2, "Notes", "ambiguous_base"), (3, "Notes", "add_unresolved_metadata_field")} <= rules
    with pytest.raises(ValueError, match="unknown"):
        metadata.plan(base, new.withColumn("Odd", F.lit(1)))


def test_merges_that_are_forbidden(spark):
    base = spark.createDataFrame([("T", "V", "d", "k", "s", "n"), ("T", "W", "d", "k", "s", "n"), ("U", "V", "d", "k", "s", "n")], BASE)
    new = spark.createDataFrame([("T", "V", "d", "m", "s", None), ("U", "V", "d", " k ", "s", None), ("X", "V", " ", "k", "s", None), ("X", "V", "d", "q", "s", None)], BASE)
    want = {("T", "units_changed"), ("T", "vanished_variable"), ("X", "blank_required"), ("X", "duplicate_source"), ("X", "several_source_units"), ("Z", "missing_source_metadata")}
    assert {tuple(r) for r in metadata.merge_issues(base, new, spark.createDataFrame([("T",), ("Z",)], "table_name string")).collect()} == want
    assert metadata.merge_issues(base, base).count() == 0


def test_generated_fields(spark):
    rows = spark.createDataFrame([("T", "old", None, None, 7), ("U", None, None, 3, None)], "`Table` string, `Last IFs Update` string, Years string, UsedInFunctions bigint, `Decimal Places` bigint")
    panel = spark.createDataFrame([("T", 2001, 1.0), ("T", 2003, 2.0), ("T", 2009, None)], "table_name string, year int, value double")
    got = {r["Table"]: tuple(r)[1:] for r in metadata.generated(rows, panel, "2024/01/02").collect()}
    assert got == {"T": ("2024/01/02", "2001-2003", 0, 7), "U": ("2024/01/02", "", 3, 5)}
    stated = spark.createDataFrame([("T", "2001-2002"), ("T", "2001-2003")], "`Table` string, Years string")
    assert [tuple(r) for r in metadata.year_span_issues(stated, panel).collect()] == [("T", "2001-2002", "2001-2003")]


def test_last_events_and_newest(spark):
    events = spark.createDataFrame([("a", 1, "x"), ("a", 3, None), ("b", 2, "y")], "k string, seq int, v string")
    assert {tuple(r) for r in metadata.last_events(events, ["k"], ["seq"]).collect()} == {("a", 3, None), ("b", 2, "y")}
    rows = spark.createDataFrame([("T", "V", None, "a"), ("T", "V", "2020/01/01", "b"), ("T", "V", "2020/01/01", "c")], "`Table` string, Variable string, `Last IFs Update` string, Units string")
    assert [r["Units"] for r in metadata.newest(rows).collect()] == ["c"]


def test_preparation(spark):
    ros = spark.createDataFrame([("Example A", "AA")], "entity string, code string")
    rows = spark.createDataFrame([("T", "Former A", "AA"), ("T", "x", "ZZ"), ("U", "Example A", "AA"), ("U", "A", "AA")], "table_name string, entity string, code string")
    view, issues = preparation.name_view(rows, ros, ["table_name"])
    assert sorted((r["table_name"], r["entity"]) for r in view.collect()) == [("T", "Example A"), ("T", "x"), ("U", "Example A"), ("U", "Example A")]
    assert {tuple(r) for r in issues.collect()} == {("T", "ZZ", "unknown_code"), ("U", "AA", "repeated_key")}
    wide = spark.createDataFrame([("A", "AA", 2.5, None, 0.0)], "Country string, FIPS_CODE string, `2022` double, `2021` double, `2020` double")
    fixed = preparation.canonical_schema(wide, ["Country", "FIPS_CODE"])
    assert fixed.columns == ["Country", "FIPS_CODE", "2020", "2021", "2022", "Earliest", "MostRecent"] and tuple(fixed.first())[-2:] == (0.0, 2.5)
    with pytest.raises(ValueError, match="may not have"):
        preparation.canonical_schema(wide.withColumn("note", F.lit("x")), ["Country", "FIPS_CODE"])
    cells = spark.createDataFrame([(1, "0.125"), (2, None), (3, " "), (4, "#VALUE!"), (5, "#VALUE!"), (6, "x")], "key int, raw string")
    got = {r["key"]: (r["value"], r["violation"]) for r in preparation.percentages(cells, spark.createDataFrame([(4,)], "key int")).collect()}
    assert got == {1: (12.5, None), 2: (None, None), 3: (None, None), 4: (None, None), 5: (None, "value"), 6: (None, "value")}
    one, several = preparation.code_labels(spark.createDataFrame([("a", "x"), ("a ", "x"), ("b", "x"), ("b", "y"), ("c", None)], "code string, label string"))
    assert [tuple(r) for r in one.collect()] == [("a", "x")] and [r["code"] for r in several.collect()] == ["b"]


def test_packages_hold_what_was_applied(spark):
    batch = spark.createDataFrame([("T", 1), ("U", 2), ("U", 2)], "table_name string, v int")
    meta = spark.createDataFrame([("T", "m"), ("U", "n")], "`Table` string, Units string")
    rows, kept = preparation.package(batch, meta, spark.createDataFrame([("U",), ("U",)], "table_name string"))
    assert sorted(tuple(r) for r in rows.collect()) == [("U", 2), ("U", 2)] and [r["Units"] for r in kept.collect()] == ["n"]
    assert preparation.package_differences(batch, rows).count() == 0
    assert preparation.package_differences(batch, rows.distinct()).count() == 1
