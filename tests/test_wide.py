import datetime as dt
import random

from panelforge.operators import wide

KEYS = ["dataset", "code", "yr"]
NAMES = ["POP", "R", "F", "L"]
SCHEMA = "dataset string, code string, yr int, indicator string, received_at timestamp, row_id bigint, cell string"


def at(day):
    return dt.datetime(2022, 1, 1) + dt.timedelta(days=day)


def rows(n=400, seed=3):
    r = random.Random(seed)
    return [("d", r.choice("AB"), r.choice([1990, 1991]), r.choice(["POP", "R", "F", "L"]), at(r.randrange(900)), i, str(r.randrange(9))) for i in range(n)]


def test_latest_version_wins_in_any_split(spark):
    data = rows()
    data.append(data[7])  # a repeated row
    want = {}
    for d, c, y, i, t, k, v in data:
        want[d, c, y, i] = max(want.get((d, c, y, i), (t, -1, "")), (t, k, v))
    df = spark.createDataFrame(data, SCHEMA)
    run = lambda part: wide.deltas(part, KEYS, "indicator", NAMES)
    whole = wide.compact([run(df)], KEYS, NAMES)
    halves = wide.compact([run(df.where("row_id % 3 = 1")), run(df.where("row_id % 3 <> 1")), run(df.where("row_id < 50"))], KEYS, NAMES)
    again = wide.compact([halves, whole], KEYS, NAMES)
    for got in (whole, halves, again):
        cells = {(*(r[c] for c in KEYS), name): r[f"_cell{i}"]["cell"] for r in got.collect() for i, name in enumerate(NAMES) if r[f"_cell{i}"]}
        assert cells == {k: v[2] for k, v in want.items()}
        assert {tuple(r) for r in wide.filled(got, KEYS, "indicator", NAMES).collect()} == set(want)


def test_runs_are_sparse_sorted_and_stored(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    run = wide.deltas(df, KEYS, "indicator", NAMES)
    got = [tuple(r[c] for c in [*KEYS, "run"]) for r in run.collect()]
    assert len(got) == len(set(got)), "one row per key and run"
    assert all(part == sorted(part) for part in run.select(*KEYS, "run").rdd.map(tuple).glom().collect())
    assert "Scan ExistingRDD" in run._jdf.queryExecution().executedPlan().toString(), "read back from the shared folder"
    assert all(sum(r[f"_cell{i}"] is not None for i in range(4)) >= 1 for r in run.collect())


def test_versions_decide(spark):
    """A late batch with older receipts doesn't overwrite; without versions it would."""
    new, old = [("d", "A", 1990, "POP", at(9), 1, "new")], [("d", "A", 1990, "POP", at(1), 99, "old"), ("d", "A", 1990, "R", at(1), 98, "kept")]
    runs = [wide.deltas(spark.createDataFrame(x, SCHEMA), KEYS, "indicator", NAMES) for x in (new, old)]
    got = wide.widen(wide.compact(runs, KEYS, NAMES), KEYS, dict.fromkeys(NAMES, "label")).collect()
    assert [(r["POP"], r["R"], r["F"]) for r in got] == [("new", "kept", None)]


def test_typed_columns_and_empty_table(spark):
    data = [("d", "A", 1990, "POP", at(1), 1, "2.0"), ("d", "A", 1990, "F", at(1), 2, "No"), ("d", "A", 1990, "R", at(1), 3, " 1e2 "), ("d", "A", 1990, "L", at(1), 4, " x "), ("d", "B", 1990, "POP", at(1), 5, "1" + "0" * 30)]
    columns = {"POP": "integer", "R": "decimal", "F": "flag", "L": "label"}
    got = {r["code"]: r for r in wide.widen(wide.compact([wide.deltas(spark.createDataFrame(data, SCHEMA), KEYS, "indicator", NAMES)], KEYS, NAMES), KEYS, columns).collect()}
    assert (got["A"]["POP"], got["A"]["F"], got["A"]["R"], got["A"]["L"]) == (2, False, 100.0, " x ")
    assert (got["B"]["POP"], got["B"]["R"]) == (None, None)
    none = wide.widen(wide.compact([wide.deltas(spark.createDataFrame([], SCHEMA), KEYS, "indicator", NAMES)], KEYS, NAMES), KEYS, columns)
    assert none.count() == 0 and none.columns == [*KEYS, *columns]
