import json
import sqlite3
import zipfile

import pytest
from pyspark.sql import functions as F

from panelforge.operators import panel
from panelforge.plans import delivery
from panelforge.sources import files, sinks
from panelforge.sources.recipes import Indicator, Recipe
from panelforge.streaming import intake

RECIPE = Recipe({"POP": Indicator("SeriesPop", "persons", 1000.0, 0.0, 1e9)}, ignored_indicators=("SKIP",), missing=("..",))


def roster(spark):
    return spark.createDataFrame([("Example A", "AAA"), ("Example B", "BBB")], "entity string, code string")


def test_long_csv(spark, tmp_path):
    (tmp_path / "d.csv").write_text("code,indicator,year,value,unit\nAAA,POP,2023,0.120,persons\nBBB,POP,2023,..,persons\nAAA,SKIP,x,x,x\nZZZ,POP,2023,1,persons\nAAA,OTHER,2023,1,persons\nAAA,POP,2024.0,1,persons\nAAA,POP,2022,oops,persons\nAAA,POP,2021,-1,persons\nAAA,POP,2020,1,thousands\nAAA,POP,2019,1,persons\nAAA,POP,2019,1,persons\nAAA,POP,2018\n")
    got = files.load_long(files.read_text_csv(spark, str(tmp_path / "d.csv")), RECIPE, roster(spark)).collect()
    assert {(r["year"], r["value"]) for r in got if r["violation"] is None} == {(2023, 120.0), (2023, None)}
    assert sorted(r["violation"] for r in got if r["violation"]) == ["bound", "country", "duplicate", "duplicate", "indicator", "unit", "value", "width", "year"]
    with pytest.raises(ValueError, match="don't load"):
        files.fail_on(files.load_long(files.read_text_csv(spark, str(tmp_path / "d.csv")), RECIPE, roster(spark)))
    (tmp_path / "e.csv").write_text("a,a\n1,2\n")
    with pytest.raises(ValueError, match="repeats"):
        files.read_text_csv(spark, str(tmp_path / "e.csv"))


def test_recipes_are_checked():
    text = json.dumps({"indicators": {"POP": {"table": "SeriesPop"}}, "missing": [".."]})
    assert Recipe.parse(text).missing == ("..",)
    for bad in ({"indicators": {}}, {"indicators": {"P": {"table": "S"}}, "missing": ["0"]}, {"indicators": {"P": {"table": "S"}}, "policy": "guess"}, {"indicators": {"P": {"table": "S"}}, "more": 1}, {"indicators": {"P": {"table": "S", "multiplier": 0}}}):
        with pytest.raises(ValueError):
            Recipe.parse(json.dumps(bad))


def test_wide_csv_and_nested_zip(spark, tmp_path):
    (tmp_path / "w.csv").write_text('Country,2001,2000\n"A, b",1.5,\nC,x,2\n')
    got = {(r["Country"], r["year"]): (r["value"], r["violation"]) for r in files.read_wide_csv(spark, str(tmp_path / "w.csv"), ["Country"]).collect()}
    assert got == {("A, b", 2001): (1.5, None), ("A, b", 2000): (None, None), ("C", 2001): (None, "value"), ("C", 2000): (2.0, None)}
    with zipfile.ZipFile(tmp_path / "in.zip", "w") as z:
        z.writestr("a.csv", 'x\n1\n"a\nb",c\n')
    with zipfile.ZipFile(tmp_path / "out.zip", "w") as z:
        z.write(tmp_path / "in.zip", "deep/in.zip")
        z.writestr("b.csv", "y\n")
    lines = {(r["member"], r["row_no"]): r["fields"] for r in files.read_zip_csv(spark, str(tmp_path / "out.zip")).collect()}
    assert lines == {("deep/in.zip/a.csv", 0): ["x"], ("deep/in.zip/a.csv", 1): ["1"], ("deep/in.zip/a.csv", 2): ["a\nb", "c"], ("b.csv", 0): ["y"]}


def test_sqlite_both_ways(spark, tmp_path):
    path = str(tmp_path / "s.db")
    with sqlite3.connect(path) as db:
        db.execute('CREATE TABLE "SeriesDebt%GDP" (Country TEXT, FIPS_CODE TEXT, "2000", "2001", Earliest, MostRecent)')
        db.executemany('INSERT INTO "SeriesDebt%GDP" VALUES (?, ?, ?, ?, NULL, NULL)', [("A", "AAA", 1, None), ("B", "BBB", "", "7.0"), ("C", "CCC", 9007199254740993, 2.5)])
        db.execute("CREATE TABLE SeriesTrade (Actor, Actor_FIPS, Partner, Partner_FIPS, '2024')")
        db.executemany("INSERT INTO SeriesTrade VALUES (?, ?, ?, ?, ?)", [("A", "AAA", "B", "BBB", 7), ("B", "BBB", "A", "AAA", 9)])
        db.execute("CREATE TABLE Unrelated (note)")
    cells = files.strict_cells(files.read_sqlite(spark, path)).collect()
    debt = {(r["code"], r["year"]): (r["value"], r["missing"], r["violation"]) for r in cells if r["partner"] is None}
    assert debt == {("AAA", 2000): (1.0, None, None), ("AAA", 2001): (None, "sql_null", None), ("BBB", 2000): (None, "empty_string", None), ("BBB", 2001): (None, None, "value"), ("CCC", 2000): (None, None, "value"), ("CCC", 2001): (2.5, None, None)}
    assert {(r["code"], r["partner_code"]): r["value"] for r in cells if r["partner"]} == {("AAA", "BBB"): 7.0, ("BBB", "AAA"): 9.0}
    wide = spark.createDataFrame([("A", "AAA", 1.0, None)], "Country string, FIPS_CODE string, `2000` double, `2001` double")
    sinks.write_sqlite(wide, str(tmp_path / "t.db"), "Series%X")
    back = files.strict_cells(files.read_sqlite(spark, str(tmp_path / "t.db"))).collect()
    assert {(r["year"], r["value"]) for r in back} == {(2000, 1.0), (2001, None)}


def test_sinks_and_releases(spark, tmp_path):
    df = spark.createDataFrame([("A", [1, 2], 1.0), ("B", None, None)], "code string, years array<int>, value double")
    folder = tmp_path / "candidate"
    folder.mkdir()
    sinks.write_parquet(df, str(folder / "p"))
    sinks.write_csv(df, str(folder / "c"))
    sinks.write_jsonl(df, str(folder / "j"))
    assert {r["years"] for r in spark.read.option("header", True).csv(str(folder / "c")).collect()} == {"[1,2]", None}
    assert spark.read.json(str(folder / "j")).count() == 2
    sinks.seal(str(folder))
    assert sinks.verify(str(folder)) == []
    (tmp_path / "releases").mkdir()
    with pytest.raises(ValueError, match="aren't accepted"):
        sinks.publish(str(folder), str(tmp_path / "releases"), "8.68", warnings=1)
    made = sinks.publish(str(folder), str(tmp_path / "releases"), "8.68")
    assert spark.read.parquet(made + "/p").count() == 2
    with pytest.raises(FileExistsError):
        sinks.publish(str(folder), str(tmp_path / "releases"), "8.68")
    with pytest.raises(ValueError, match="label"):
        sinks.publish(str(folder), str(tmp_path / "releases"), "../x")
    (folder / "new").write_text("x")
    with pytest.raises(ValueError, match="changed"):
        sinks.publish(str(folder), str(tmp_path / "releases"), "8.69")
    with pytest.raises(ValueError):
        sinks.write_json({"x": float("nan")}, str(tmp_path / "x.json"))


BATCH = "batch string, seq long, table_name string, entity string, code string, year int, value double"


def test_streaming_intake_equals_one_merge(spark, tmp_path):
    rows = [("base", 0, "T", "A", "AAA", 2000, 1.0), ("A", 1, "T", "A", "AAA", 2000, None), ("B", 2, "T", "A", "AAA", 2000, 3.0), ("A", 1, "T", "A", "AAA", 2001, 5.0), ("B", 2, "T", "B", "BBB", 2000, 7.0)]
    into, state, check = (str(tmp_path / n) for n in ("in", "state", "check"))
    for part in ([rows[2]], rows[:2], rows[3:]):  # the newest arrives first
        spark.createDataFrame(part, BATCH).write.mode("append").parquet(into)
        intake.follow(spark, into, state, check, once=True).awaitTermination(120)
    from panelforge.operators import merge

    got = {(r["code"], r["year"]): (r["value"], r["batch"]) for r in intake.current(spark, state).collect()}
    want = {(r["code"], r["year"]): (r["value"], r["origin"]) for r in merge.consolidate(spark.createDataFrame(rows, BATCH)).collect()}
    assert got == want
    intake.merge_round(spark.createDataFrame(rows[3:], BATCH), 2, state)  # a repeated round
    assert {(r["code"], r["year"]): (r["value"], r["batch"]) for r in intake.current(spark, state).collect()} == want


def test_windowed_counts(spark):
    events = spark.createDataFrame([("2024-01-01 01:00:00", "a"), ("2024-01-01 23:00:00", "a"), ("2024-01-02 00:00:00", "b")], "t string, event_type string").withColumn("ts", F.to_timestamp("t"))
    assert sorted((r["event_type"], r["events"]) for r in intake.windowed_counts(events).collect()) == [("a", 2), ("b", 1)]


def test_delivery_skips_bad_tables_and_verifies(spark):
    rows = [("base", 0, "T", "A", "AAA", 2000, 1.0), ("base", 0, "T", "A", "AAA", 2001, 1.1), ("x", 1, "T", "A", "AAA", 2001, 9.0), ("y", 2, "T", "A", "AAA", 2001, 5.0), ("y", 2, "T", "A", "BBB", 2001, 5.0)]
    d = delivery.deliver(spark.createDataFrame(rows, BATCH))
    assert {(r["batch"], r["rule"]) for r in d.skipped.collect()} == {("y", "name_with_several_codes")}
    assert {(r["year"], r["value"], r["origin"]) for r in d.merged.collect()} == {(2000, 1.0, "base"), (2001, 9.0, "x")}
    assert d.mismatches.count() == 0 and d.counts.collect()[0]["revised"] == 1
    told = {(r["rule"], r["batch"], r["severity"]) for r in d.findings.collect()}
    assert ("aggregate_jump", "base", "review") not in told and all(s in ("error", "review", "info") for _, _, s in told)
    base = spark.createDataFrame(rows[:2], BATCH).drop("batch", "seq")
    assert "| T | 0 | 1 | 0 |" in delivery.report(d, base, base, "Delivery")
    evidence = delivery.quality(base, base.withColumn("value", F.col("value") * 1000), d.merged)
    assert all(df.limit(1).count() >= 0 for df in evidence.values()) and evidence["comparisons"].where("outcome = 'revised'").count() == 2
    with pytest.raises(ValueError, match="order"):
        delivery.ordered(spark.createDataFrame(rows, BATCH), ["x"])
    assert {r["seq"] for r in delivery.ordered(spark.createDataFrame(rows, BATCH), ["y", "x"]).where("batch = 'x'").collect()} == {2}


def test_number_classes(spark):
    df = spark.createDataFrame([(None,), (0.0,), (5.0,), (-999.0,), (float("inf"),), (float("nan"),)], "v double")
    assert [r[0] for r in df.select(panel.number_class(F.col("v"), [-999.0])).collect()] == ["sql_null", "numeric_zero", "numeric", "declared_numeric_token", "invalid_value", "invalid_value"]


def test_long_delivery_rules(spark):
    rows = spark.createDataFrame([("AAA", "POP", "0001", "1", "persons"), ("AAA", "POP", "3000", "1", "persons"), ("AAA", "POP", "2000", "1", None), ("AAA", "POP", "1000", "1", "persons")], "code string, indicator string, year string, value string, unit string")
    recipe = Recipe({**RECIPE.indicators, "GDP": Indicator("SeriesGdp")})
    got = {(r["year"], r["violation"]) for r in files.load_long(rows, recipe, roster(spark)).collect()}
    assert got == {(1, "year"), (1000, None), (2000, "unit"), (3000, "year"), (None, "absent")}


def test_references_and_mappings_that_contradict_themselves(spark):
    put = lambda *rows: spark.createDataFrame(rows, "Country string, FIPS_CODE string, source_code string")
    assert files.country_reference(put((" A ", "AA", "1"), ("A", "AA ", "2"), ("B", "BB", "3"))).count() == 3
    for bad in ([("A", "AA", "1"), ("B", "AA", "2")], [("A", "AA", "1"), ("A", "BB", "2")], [("A", "AA", "1"), ("B", "BB", "1")], [("A", None, "1")], [(" ", "AA", "1")]):
        with pytest.raises(ValueError):
            files.country_reference(put(*bad))
    named = lambda *rows: spark.createDataFrame(rows, "original_name string, matched_name string")
    got = files.reviewed_mapping(named((" Exampel A", "Example A"), ("Elsewhere", "")), roster(spark)).collect()
    assert {(r["original_name"], r["matched_code"]) for r in got} == {("Exampel A", "AAA"), ("Elsewhere", None)}
    for bad in ([("x", "Example A"), ("x ", "Example B")], [("x", "Nowhere")], [(" ", "Example A")]):
        with pytest.raises(ValueError):
            files.reviewed_mapping(named(*bad), roster(spark))
    with pytest.raises(ValueError, match="columns"):
        files.reviewed_mapping(named(("x", "y")).drop("matched_name"), roster(spark))


SHEET = '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1" t="inlineStr"><is><t>x</t></is></c></row><row r="3"><c r="B3"><f>1+1</f><v>2</v></c></row></sheetData></worksheet>'


def test_workbooks(spark, tmp_path):
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    with zipfile.ZipFile(tmp_path / "b.xlsx", "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns}><sheets><sheet name="Data" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>Coun</t><t>try</t></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", SHEET)
    got = {r["row_no"]: r["cells"] for r in files.read_xlsx(spark, str(tmp_path / "b.xlsx"), "Data").collect()}
    assert got == {1: ["Country", None, "x"], 3: [None, "2"]}


def test_catalog_and_discovery(spark, tmp_path):
    path = str(tmp_path / "DataImport_2024-03-01.db")
    with sqlite3.connect(path) as db:
        db.execute('CREATE TABLE SeriesA (Country, FIPS_CODE, "2000")')
        db.execute("CREATE TABLE SeriesB (Actor, Actor_FIPS, Partner, Partner_FIPS, '2024')")
        db.execute("CREATE TABLE seriesx (note)")
        db.execute("INSERT INTO SeriesA VALUES (1, 2, 3)")
    got = {r["name"]: (r["kind"], r["years"], r["rows"]) for r in files.catalog(spark, path).collect()}
    assert got == {"SeriesA": ("monadic", [2000], 1), "SeriesB": ("dyadic", [2024], 0), "seriesx": ("other", [], 0)}
    assert files.sqlite_tables(path) == ["SeriesA", "SeriesB"]
    (tmp_path / "DataImport_x.db").write_bytes(b"x")
    (tmp_path / "other.txt").write_text("x")
    found = files.discover(spark, str(tmp_path), r"^DataImport.*[.]db$").collect()
    assert [(r["file"].rsplit("/", 1)[1], str(r["day"])) for r in found] == [("DataImport_x.db", "None"), ("DataImport_2024-03-01.db", "2024-03-01")]


def test_lost_stream_state_is_an_error(spark, tmp_path):
    import shutil

    state = str(tmp_path / "state")
    row = lambda y, v: spark.createDataFrame([("A", 1, "T", "A", "AAA", y, v)], BATCH)
    intake.merge_round(row(2000, 1.0), 0, state)
    intake.merge_round(row(2001, 2.0), 1, state)
    assert intake.current(spark, state).count() == 2
    with pytest.raises(ValueError, match="round 3 needs"):
        intake.merge_round(row(2002, 3.0), 3, state)
    (tmp_path / "state" / "round=1" / "_SUCCESS").unlink()
    assert intake.current(spark, state).count() == 1, "an unfinished round isn't read"
    with pytest.raises(ValueError, match="round 2 needs"):
        intake.merge_round(row(2002, 3.0), 2, state)
    shutil.rmtree(state)
    (tmp_path / "state").mkdir()
    with pytest.raises(ValueError, match="no finished round"):
        intake.current(spark, state)


def test_quality_tells_by_evidence(spark):
    put = lambda *rows: spark.createDataFrame([("T", c, c, y, v) for c, y, v in rows], "table_name string, entity string, code string, year int, value double")
    base = put(("A", 2000, 10.0), ("A", 2001, 100.0), ("B", 2000, 5.0), ("B", 2001, None))
    incoming = put(("A", 2000, 10.0), ("A", 2001, 100.0), ("B", 2000, None), ("B", 2001, 50.0))
    final = put(("A", 2000, 10.0), ("A", 2001, 100.0), ("B", 2000, 5.0), ("B", 2001, 50.0)).withColumn("origin", F.when((F.col("code") == "B") & (F.col("year") == 2001), "x").otherwise("base"))
    got = delivery.quality(base, incoming, final)
    kinds = {(r["rule"], r["classification"]) for r in got["classified"].collect()}
    assert ("temporal_jump", "also_in_base") in kinds and ("temporal_jump", "dataset_specific_or_unresolved") in kinds and ("blending_boundary_jump", "blending_boundary") in kinds
    rules = {r["rule"] for r in got["findings"].collect()}
    assert {"incoming_missing", "lost_observation", "blending_boundary_jump", "temporal_jump"} <= rules
    assert set(got) == {"summary", "coverage", "membership", "aggregates", "available", "comparisons", "scales", "swaps", "checks", "findings", "classified", "observations"}
    assert {r["status"] for r in got["checks"].collect()} <= {"calculated", "insufficient_evidence"}
