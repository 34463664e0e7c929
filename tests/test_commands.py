"""The command line from an import to a release, and what an interrupted publication leaves."""

import json
import sqlite3

import pytest

from panelforge.__main__ import run
from panelforge.plans import delivery
from panelforge.sources import files, sinks

BATCH = "batch string, seq long, table_name string, entity string, code string, year int, value double"
ROWS = [("base", 0, "T", "A", "AAA", 2000, 1.0), ("base", 0, "T", "A", "AAA", 2001, 5.0), ("x", 1, "T", "A", "AAA", 2001, 9.0), ("y", 2, "T", "A", "AAA", 2002, 9.5)]


def test_from_batches_to_a_release(spark, tmp_path):
    at = lambda name: str(tmp_path / name)
    spark.createDataFrame(ROWS, BATCH).write.parquet(at("batches"))
    run(["deliver", at("batches"), at("candidate"), "--order", "y", "x"], spark)
    assert run(["verify", at("candidate")], spark) == []
    merged = {r["year"]: (r["value"], r["origin"]) for r in spark.read.parquet(at("candidate/merged")).collect()}
    assert merged == {2000: (1.0, "base"), 2001: (9.0, "x"), 2002: (9.5, "y")}
    review = [r["id"] for r in spark.read.parquet(at("candidate/findings")).where("severity = 'review'").collect()]
    (tmp_path / "decisions.csv").write_text("table_name,action,reason\nT,prefer_new_non_null,checked\n")
    (tmp_path / "accepted.csv").write_text("id\n" + "".join(f"{i}\n" for i in review[:-1]))
    shut = run(["gate", at("candidate"), at("decisions.csv"), at("accepted.csv")], spark)
    assert [(r["id"], r["why"]) for r in shut] == [(review[-1], "review finding not accepted")]
    (tmp_path / "accepted.csv").write_text("id\n" + "".join(f"{i}\n" for i in review))
    assert run(["gate", at("candidate"), at("decisions.csv"), at("accepted.csv")], spark) == []
    (tmp_path / "releases").mkdir()
    made = run(["publish", at("candidate"), at("releases"), "1.0"], spark)
    assert run(["verify", made], spark) == [] and not (tmp_path / "releases" / sinks.JOURNAL).exists()


def test_interrupted_publications_are_ended(spark, tmp_path):
    folder = tmp_path / "c"
    folder.mkdir()
    (folder / "x").write_text("1")
    sinks.seal(str(folder))
    releases = tmp_path / "r"
    (releases / ".1.0.part").mkdir(parents=True)
    (releases / sinks.JOURNAL).write_text(json.dumps({"label": "1.0"}))
    assert run(["recover", str(releases)], spark) == "1.0" and list(releases.iterdir()) == []
    assert run(["recover", str(releases)], spark) is None
    sinks.publish(str(folder), str(releases), "1.0")
    (releases / "1.0" / "x").write_text("2")
    (releases / sinks.JOURNAL).write_text(json.dumps({"label": "1.0"}))
    with pytest.raises(ValueError, match="sealed"):
        sinks.recover(str(releases))


def test_inspection_and_selection(spark, tmp_path):
    path = str(tmp_path / "i.db")
    with sqlite3.connect(path) as db:
        db.execute('CREATE TABLE SeriesA (Country, FIPS_CODE, "2000")')
        db.execute('CREATE TABLE SeriesB (Country, FIPS_CODE, "2000")')
        db.execute('CREATE TABLE DataDict ("Table", Units)')
        db.executemany("INSERT INTO DataDict VALUES (?, 'k')", [("SeriesA",), ("SeriesC",)])
        db.execute("INSERT INTO SeriesA VALUES ('A', 'AAA', 1.5)")
    assert {(r["name"], r["listed"], r["there"]) for r in run(["tables", path], spark)} == {("SeriesA", True, True), ("SeriesB", False, True), ("SeriesC", True, False)}
    assert [t["name"] for t in run(["inspect", path], spark)["tables"]] == ["DataDict", "SeriesA", "SeriesB"]
    assert files.read_selected(spark, path, ["SeriesA"]).count() == 1
    for bad in (None, ["SeriesB"], ["SeriesA", "SeriesA"]):
        with pytest.raises(ValueError, match="list"):
            files.read_selected(spark, path, bad)
    (tmp_path / "x.csv").write_text("a,b\n" + "1,2\n" * 9)
    told = files.inspect(spark, str(tmp_path / "x.csv"))
    assert told["columns"] == ["a", "b"] and len(told["first"]) == 5
    (tmp_path / "x.csv.generated").write_text("")
    assert set(sinks.inputs(str(tmp_path))) == {"i.db"}


def test_skips_discards_and_orders_stick(spark):
    b = spark.createDataFrame(ROWS, BATCH)
    skipped = spark.createDataFrame([("x", "T")], "batch string, table_name string")
    assert {r["year"]: r["origin"] for r in delivery.deliver(b, skipped_before=skipped).merged.collect()} == {2000: "base", 2001: "base", 2002: "y"}
    gone = spark.createDataFrame([("y", "withdrawn")], "batch string, reason string")
    assert {r["year"] for r in delivery.deliver(b, discarded=gone).merged.collect()} == {2000, 2001}
    with pytest.raises(ValueError, match="reason"):
        delivery.deliver(b, discarded=spark.createDataFrame([("y", " ")], "batch string, reason string"))
    order = lambda *names: spark.createDataFrame([(n, i + 1) for i, n in enumerate(names)], "batch string, seq int")
    earlier = spark.createDataFrame([("x", "y")], "earlier string, later string")
    why = lambda o: {(r["earlier"], r["later"], r["why"]) for r in delivery.order_conflicts(b, o, earlier).collect()}
    assert why(order("x", "y")) == set()
    assert why(order("y", "x")) == {("x", "y", "order_turned_round")}
    assert why(order("x")) == {("x", "y", "overlap_without_order")}
