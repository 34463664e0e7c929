import pytest
from pyspark.sql import functions as F

from panelforge.operators import units


def read(spark, texts):
    got = units.read_spellings(spark.createDataFrame([(t,) for t in texts], "phrase string")).collect()
    return {r["phrase"]: r["factor"] for r in got}


def test_spellings(spark):
    want = {
        "Persons": 1, "head count": 1, "人": 1, "чел.": 1, "ones": 1, "persons, unscaled": 1, "individual heads": 1, "'000": 1000, "Tsd. Einwohner": 1000, "1,000s of people": 1000,
        "10^3 persons": 1000, "тыс. чел.": 1000, "千人": 1000, "万人": 10_000, "tens of thousands": 10_000, "10 thousand persons": 10_000, "units of one hundred thousand persons": 100_000,
        "lakh": 100_000, "1 000 000 persons": 1_000_000, "1000 thousands": 1_000_000, "Mio. Einwohner": 1_000_000, "crore": 10_000_000, "units of ten million persons": 10_000_000,
        "persons (00)": 100, "x100 persons": 100, "hundred heads": 100, "thousnad persons": 1000, "milllions of persons": 1_000_000, "Inhabitnats": 1,
        "the number of the persons in units of one thousand of the people at the count": 1000,
    }
    assert read(spark, [*want, *want]) == want


def test_texts_that_name_no_unit(spark):
    assert read(spark, ["as published", "see notes", "n.a.", "varies", "", " ", None, "five thousand forms", "thirty persons moved", "x" * 5000, "per thousand inhabitants", "persons per household"]) == {}


def test_phrases_of_the_stored_figures_only(spark):
    texts = {
        "The source sheet was in hundreds; converted before storing. Stored in lakhs.": ["lakhs"], "revised by about two thousand after the recount": [], "some hundreds of forms were lost": [],
        "All columns hold crores. Figures are mid-year.": ["crores", "mid-year"], "Population, as of 1 July (tens of thousands)": ["tens of thousands"], None: [],
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", units._sentences(F.col("t")).alias("p"))
    for r in df.collect():
        assert set(texts[r["t"]]) <= set(r["p"]) and (texts[r["t"]] or not r["p"]), r


def test_order_of_sources_and_edges(spark):
    meta = "`Table` string, Units string, Definition string, Notes string, `Extended Source Defn` string, `Last IFs Update` string"
    rows = "row_id bigint, table_name string, remark string, `2023` double, factor string, phrase string"
    m = [("A", "thousands", "in millions", None, None, "2020/01/01"), ("A", "millions", None, None, None, "2019/01/01"), ("A", "thousands", "in millions", None, None, "2020/01/01"),
         ("B", "varies", "P, in lakhs", "Stored in crores.", None, None), ("C", None, "P", "The source sheet was in hundreds; converted before storing.", "Sheet header: 'single persons'", None), ("D", "n.a.", None, None, None, None), (None, "millions", None, None, None, None)]
    r = [(1, "A", None, 2.0), (2, "A", "row given in lakhs", 2.0), (3, "A", "some hundreds of forms were lost", 2.0), (4, "B", None, 2.0), (5, "C", None, 2.0), (6, "D", None, 2.0), (7, "E", "row given in crores", None), (8, None, None, 1.0), (1, "A", None, 2.0)]
    got = units.in_persons(spark.createDataFrame([(*x, "clash", "clash") for x in r], rows).drop("factor"), spark.createDataFrame(m, meta)).collect()
    assert {x["row_id"]: (x["factor"], x["told_by"]) for x in got} == {1: (1000, "units"), 2: (100_000, "remark"), 3: (1000, "units"), 4: (100_000, "text"), 5: (1, "text"), 6: (None, None), 7: (10_000_000, "remark"), 8: (None, None)}
    assert len(got) == len(r) and all(x["persons"] == x["stored"] * x["factor"] for x in got if x["factor"] and x["stored"] is not None)
    assert units.in_persons(spark.createDataFrame([], rows).drop("factor"), spark.createDataFrame(m, meta)).count() == 0


@pytest.mark.parametrize(("a", "b", "cost"), [("abc", "abc", 0), ("abc", "acb", 0.5), ("abc", "abbc", 0.5), ("cat", "cut", 0.7), ("abc", "xbc", 1), ("", "ab", 1.5 + 0.5)])
def test_weighted_edits(a, b, cost):
    assert units.weighted_edits(a, b) == pytest.approx(cost)
