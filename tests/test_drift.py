import datetime as dt
import json

from panelforge.operators import drift

SCHEMA = "record_id bigint, feed string, import_file string, seq int, received_at timestamp, line_no int, record string, field string, kind string"


def frame(spark, files, extra=()):
    """files: (feed, seq, records)."""
    rows, n = [], 0
    for feed, seq, records in files:
        for k, rec in enumerate(records):
            rows.append((n, feed, f"{feed}-{seq}", seq, dt.datetime(2022, 1, 1), k, rec if rec is None or isinstance(rec, str) else json.dumps(rec), "clash", "clash"))
            n += 1
    return spark.createDataFrame([*rows, *extra], SCHEMA)


def report(df):
    return {(r["import_file"], r["field"], r["change_kind"], r["old_field"]) for r in drift.drift(df)[0].collect()}


def entity(k, **fields):
    return {"Table": f"T{k}", "Variable": f"V{k}", **fields}


def test_added_removed_renamed_retyped(spark):
    old = [entity(k, Notes=f"note number {k}", CURRENCY="AB" + "CDEFGH"[k], Flag=k % 2, Gone=k) for k in range(6)]
    new = [entity(k, Remarks=f"note number {k}" + "!" * (k == 2), CURRENCY=k, Flag=k % 2, Fresh="x") for k in range(6)]
    got = report(frame(spark, [("f", 1, new), ("f", 0, old + old[:2])]))
    assert got == {("f-1", "Remarks", "renamed", "Notes"), ("f-1", "CURRENCY", "retyped", None), ("f-1", "Gone", "removed", None), ("f-1", "Fresh", "added", None)}


def test_rename_that_also_changes_type(spark):
    old = [entity(k, Code=str(100 + k)) for k in range(5)]
    new = [entity(k, CodeNo=100 + k) for k in range(5)]
    assert report(frame(spark, [("f", 0, old), ("f", 4, new)])) == {("f-4", "CodeNo", "renamed", "Code"), ("f-4", "CodeNo", "retyped", "Code")}


def test_case_counts_as_another_name_and_feeds_are_apart(spark):
    a = [entity(k, Notes=f"text {k}") for k in range(4)]
    b = [entity(k, NOTES=f"text {k}") for k in range(4)]
    assert report(frame(spark, [("f", 0, a), ("f", 1, b), ("g", 0, b)])) == {("f-1", "NOTES", "renamed", "Notes")}


def test_nulls_broken_records_and_empty_table(spark):
    files = [("f", 0, [entity(1, A=None, B="x"), None, "not json", "[1]", {"B": "y"}]), ("f", 1, [entity(1, A=5, B=None)])]
    assert report(frame(spark, files)) == set()
    assert report(frame(spark, [])) == set()


def test_correspondences_are_one_to_one(spark):
    old = [entity(k, A=f"same {k}", B=f"same {k}") for k in range(5)]
    new = [entity(k, A2=f"same {k}") for k in range(5)]
    got = report(frame(spark, [("f", 0, old), ("f", 1, new)]))
    assert {x[2] for x in got} == {"renamed", "removed"} and len(got) == 2


def test_consolidation_follows_chains_of_renames(spark):
    names = ["Notes", "Remarks", "Comments", "Notes2"]
    files = [("f", s, [entity(k, **{n: f"note {k}", "DP": True if s == 2 else k % 2}) for k in range(5)]) for s, n in enumerate(names)]
    got = drift.consolidate(frame(spark, files), {"Notes": "string", "DP": "bigint"}).collect()
    assert len(got) == 20 and all(r["Notes"] == f"note {r['line_no']}" for r in got)
    assert all(r["DP"] == (1 if r["seq"] == 2 else r["line_no"] % 2) for r in got)
    assert all(set(json.loads(r["other"])) == {"Table", "Variable"} for r in got)


def test_values_that_do_not_fit_stay_as_text(spark):
    got = drift.consolidate(frame(spark, [("f", 0, [entity(1, DP="many")])]), {"DP": "bigint"}).collect()[0]
    assert got["DP"] is None and json.loads(got["other"])["DP"] == "many"


NUMBER, TEXT = (("number",), frozenset()), (("string",), frozenset())


def test_flooding_converges():
    met = {("a", "x"): (5, 5), ("a", "y"): (5, 1), ("b", "x"): (5, 1), ("b", "y"): (5, 4)}
    graph = drift.schema_graph({"a": TEXT, "b": NUMBER}, {"x": TEXT, "y": NUMBER}, met)
    score, longer = drift.flood(*graph), drift.flood(*graph, settled=1e-9, rounds=5000)
    assert all(abs(score[p] - longer[p]) < 0.02 for p in score)
    assert score["field", "a", "x"] > score["field", "a", "y"] and score["field", "b", "y"] > score["field", "b", "x"]
    assert drift.flood({"root": 1.0}, []) == {"root": 1.0}


def test_only_flooding_tells_equal_values_apart(spark):
    """All values agree both ways and the names say nothing; types reach the pairs through the graph only."""
    old = [entity(k, Aaa=7, Bbb="7") for k in range(4)]
    new = [entity(k, Xxx="7", Yyy=7) for k in range(4)]
    assert report(frame(spark, [("f", 0, old), ("f", 1, new)])) == {("f-1", "Yyy", "renamed", "Aaa"), ("f-1", "Xxx", "renamed", "Bbb")}
    met = {(o, n): (4, 4) for o in ("Aaa", "Bbb") for n in ("Xxx", "Yyy")}
    start, links = drift.schema_graph({"Aaa": NUMBER, "Bbb": TEXT}, {"Xxx": TEXT, "Yyy": NUMBER}, met)
    assert start["field", "Aaa", "Xxx"] == start["field", "Aaa", "Yyy"]
    flooded = drift.flood(start, links)
    assert flooded["field", "Aaa", "Yyy"] > flooded["field", "Aaa", "Xxx"]


def test_nested_fields_tell_fields_without_common_entities_apart(spark):
    old = [entity(k, Contact={"phone": f"{k}", "name": {"first": "x"}}, Gone={"width": 1}) for k in range(3)]
    new = [entity(k + 10, Person={"phone": f"9{k}", "name": {"first": "y"}}, Fresh=[True]) for k in range(3)]
    assert report(frame(spark, [("f", 0, old), ("f", 1, new)])) == {("f-1", "Person", "renamed", "Contact"), ("f-1", "Gone", "removed", None), ("f-1", "Fresh", "added", None)}
    assert drift.nested_fields("OBJECT<a: OBJECT<x: DECIMAL(21,1), y: ARRAY<OBJECT<q: STRING>>>, b: BIGINT>") == {("a", "OBJECT"), ("a.x", "DECIMAL"), ("a.y", "ARRAY"), ("a.y.q", "STRING"), ("b", "BIGINT")}


def test_agreement_is_weighed_against_none(spark):
    half = [entity(k, Other=f"text {k}" if k % 2 else f"nothing of the kind {k}") for k in range(6)]
    old = [entity(k, Aaa=f"text {k}") for k in range(6)]
    assert {x[2] for x in report(frame(spark, [("f", 0, old), ("f", 1, half)]))} == {"added", "removed"}


def test_long_texts_differ_by_edits_too(spark):
    text = "many words of a note " * 200
    old, new = [entity(k, Notes=f"{k} {text}") for k in range(3)], [entity(k, Remark=f"{k} {text[:-40]}changed at the end") for k in range(3)]
    assert report(frame(spark, [("f", 0, old), ("f", 1, new)])) == {("f-1", "Remark", "renamed", "Notes")}
