import csv
import io
import itertools

from pyspark.sql import functions as F

from panelforge.operators import triage

LINES = "row_id bigint, import_file string, line_no int, raw_line string, reason string, parsed string"


def lines(spark, rows):
    # Extra columns whose names clash with the operator's own.
    return spark.createDataFrame([(*r, "kept", "kept") for r in rows], LINES)


def reasons(df):
    return {r["row_id"]: r["reason"] for r in df.select("row_id", "reason").collect()}


def fields_by_hand(line, d):
    """The fields of a line by the grammar, one character at a time; None if the quoting is broken."""
    out, i = [], 0
    while True:
        if line[i : i + 1] == '"':
            i, text = i + 1, ""
            while True:
                if i >= len(line):
                    return None
                if line[i] == '"':
                    if line[i + 1 : i + 2] == '"':
                        text, i = text + '"', i + 2
                        continue
                    i += 1
                    break
                text, i = text + line[i], i + 1
            if i < len(line) and line[i] != d:
                return None
        else:
            end = line.find(d, i)
            text = line[i:] if end < 0 else line[i:end]
            if '"' in text:
                return None
            i += len(text)
        out.append(text)
        if i >= len(line):
            return out
        i += 1


def test_structure_against_every_short_line(spark):
    texts = ["".join(p) for n in range(0, 7) for p in itertools.product('a,"', repeat=n)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", triage.well_quoted(F.col("t"), F.lit(",")).alias("ok"), triage.fields(F.col("t"), F.lit(",")).alias("f"), triage.field_count(F.col("t"), F.lit(",")).alias("n")
    )
    for r in df.collect():
        want = fields_by_hand(r["t"], ",")
        assert r["ok"] == (want is not None), r
        if want is not None:
            assert (r["f"], r["n"]) == (want, len(want)), r


def test_order_of_reasons_and_edges(spark):
    rows = [
        (0, "f", 0, '"Country";"2020"'), (1, "f", 1, 'A;"1"'), (2, "f", 2, 'A;"1'), (3, "f", 3, "A;1;"), (4, "f", 4, "A;x"), (5, "f", 5, ""), (6, "f", 6, None),
        (7, "f", 7, '"a;b";..'), (8, "f", 8, "A; "), (9, "f", 9, 'A"b;x;1'), (1, "f", 1, 'A;"1"'), (10, "nohead", 1, "A,1"), (11, "g", 0, "2020|Country"), (12, "g", 1, '1e999|"x""y"'), (13, None, 1, "a"),
    ]
    got = triage.triage_lines(lines(spark, rows).drop("reason", "parsed"))
    assert reasons(got) == {1: None, 2: "broken_quoting", 3: "column_count", 4: "invalid_value", 5: "column_count", 6: "column_count", 7: None, 8: None, 9: "broken_quoting", 10: "column_count", 12: "invalid_value", 13: "column_count"}
    assert got.where("row_id = 1").count() == 2
    assert {r["loaded"] for r in got.where("row_id = 1").collect()} == {1.0}


def test_very_long_line(spark):
    long = '"' + 'x""' * 200_000 + '",1'
    got = triage.triage_lines(lines(spark, [(0, "f", 0, "Country,2020"), (1, "f", 1, long)]).drop("reason", "parsed")).collect()
    assert got[0]["reason"] is None and len(got[0]["parsed"][0]) == 400_000


def test_fields_read_as_the_standard_module_reads_them(spark):
    values = [["a", 'q"q', "x,y"], ["", "\n", " "]]
    text = []
    for v in values:
        out = io.StringIO()
        csv.writer(out, lineterminator="").writerow(v)
        text.append((out.getvalue(),))
    df = spark.createDataFrame(text, "t string").select(triage.fields(F.col("t"), F.lit(",")).alias("f"))
    assert sorted(r["f"] for r in df.collect()) == sorted(values)


def test_values_by_type(spark):
    kinds = spark.createDataFrame([("POP", "integer"), ("R", "decimal"), ("F", "flag"), ("L", "label")], "indicator string, value_type string")
    rows = [(0, "pop ", "1"), (1, "POP", "1.5"), (2, "POP", "2.0"), (3, "R", "1e5"), (4, "R", "oops"), (5, "f", " YES"), (6, "F", "maybe"), (7, "L", "?"), (8, "X", "oops"), (9, None, "oops"), (10, "R", None), (11, "R", " .. "), (12, "POP", "9007199254740993"), (13, "R", "")]
    got = triage.triage_values(spark.createDataFrame([(*r, "kept") for r in rows], "row_id bigint, indicator string, value string, detail2 string"), kinds)
    assert {i for i, why in reasons(got).items() if why} == {1, 4, 6, 12}
    empty = triage.triage_values(spark.createDataFrame([], "row_id bigint, indicator string, value string"), kinds)
    assert empty.count() == 0
