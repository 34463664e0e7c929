import datetime as dt
import random

from panelforge.operators.snapshots import snapshot_changes

SCHEMA = "row_id bigint, snapshot_no int, received_at timestamp, table_name string, Country string, FIPS_CODE string, `2022` double, `2023` double, name string, idx int"


def frame(spark, rows):
    return spark.createDataFrame([(i, no, dt.datetime(2022, 1, 1, 0, 0, sec), t, c, f, 0.0, v, "clash", 5) for i, (no, sec, t, c, f, v) in enumerate(rows)], SCHEMA)


def found(df):
    return {(r["table_name"], r["snapshot_no"], r["fips_code"], r["change_kind"]) for r in snapshot_changes(df).collect()}


def by_hand(rows):
    last, nos = {}, {}
    for i, (no, sec, t, c, f, v) in enumerate(rows):
        if t is None or no is None:
            continue
        nos.setdefault(t, set()).add(no)
        k = (f or "").strip().upper()
        if k:
            new = (sec, i, None if c is None else " ".join(c.split()).lower(), v)
            last[t, no, k] = max(last.get((t, no, k), new), new, key=lambda x: x[:2])
    out = set()
    for t, ns in nos.items():
        ns = sorted(ns)
        for a, b in zip(ns, ns[1:]):
            old = {k: x for (tt, n, k), x in last.items() if (tt, n) == (t, a)}
            new = {k: x for (tt, n, k), x in last.items() if (tt, n) == (t, b)}
            out |= {(t, b, k, "added") for k in new.keys() - old.keys()} | {(t, b, k, "removed") for k in old.keys() - new.keys()}
            for k in new.keys() & old.keys():
                (_, _, n0, v0), (_, _, n1, v1) = old[k], new[k]
                if n0 != n1 or (v0 is None) != (v1 is None) or (v0 is not None and abs(v0 - v1) > 1e-9 * max(abs(v0), abs(v1))):
                    out.add((t, b, k, "changed"))
    return out


def test_against_brute_force(spark):
    r = random.Random(1)
    rows = [(r.choice([0, 1, 2, 4, None]), r.randrange(3), r.choice(["T", "U", None]), r.choice(["A", " a ", "B", None]), r.choice(["X", " x", "Y", "Z", "", None]), r.choice([1.0, 1.0 + 1e-12, 2.0, -1.0, 0.0, None])) for _ in range(160)]
    assert found(frame(spark, rows + rows[:9])) == by_hand(rows + rows[:9])


def test_empty_and_single(spark):
    assert found(frame(spark, [])) == set()
    assert found(frame(spark, [(3, 0, "T", "A", "X", 1.0)])) == set()
