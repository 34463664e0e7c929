"""p1_consistent types every field of datadict."""

import datetime as dt
import json

import __spark_entry__ as entry
from panelforge.plans.training import FIELDS
from panelforge.session import table

SCHEMA = "record_id bigint, feed string, import_file string, seq int, received_at timestamp, line_no int, record string"


def test_fields_are_those_of_datadict(spark):
    assert dict(table(spark, "/root/testdata/sf0.001", "datadict").dtypes) == FIELDS


def test_drifting_flags_become_numbers_and_only_unknown_fields_are_left(spark, tmp_path):
    flags = [("No", False, 0), ("Yes", "1", 1), (True, "0", None), (1, "many", "true")]
    rows = []
    for k, (nulls, used, other) in enumerate(flags):
        record = {"Table": f"T{k}", "Variable": f"V{k}", "TreatNullsAs0s": nulls, "UsedInPreprocessor": used, "CompareOtherForecast": other, "Cohort": f"C{k}", "Formula": "*100", "Licence": "closed"}
        rows.append((k, "f", "f-0", 0, dt.datetime(2022, 1, 1), k, json.dumps(record)))
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/datadict_files.parquet")
    got = {r["record_id"]: r for r in entry.queries()["p1_consistent"](spark, str(tmp_path)).collect()}
    assert [got[k]["TreatNullsAs0s"] for k in range(4)] == [0, 1, 1, 1]
    assert [got[k]["UsedInPreprocessor"] for k in range(4)] == [0, 1, 0, None]
    assert [got[k]["CompareOtherForecast"] for k in range(4)] == [0, 1, None, 1]
    assert [(got[k]["Cohort"], got[k]["Formula"]) for k in range(4)] == [(f"C{k}", "*100") for k in range(4)]
    assert [json.loads(got[k]["other"]) for k in range(4)] == [{"Licence": "closed"}] * 3 + [{"Licence": "closed", "UsedInPreprocessor": "many"}]
