import random

from panelforge.operators.spikes import flagged

YEARS = [str(y) for y in range(2004, 2024)]
SCHEMA = "row_id bigint, FIPS_CODE string, " + ", ".join(f"`{y}` double" for y in YEARS) + ", code string, s string"


def series(r, move=0.01, drift=0.01, n=20):
    v, out = 100.0, []
    for _ in range(n):
        out.append(v)
        v *= 1 + r.gauss(drift, move)
    return out


def run(spark, rows):
    df = spark.createDataFrame([(*x, "clash", "clash") for x in rows], SCHEMA)
    return {(r["row_id"], r["yr"]): r["reason"] for r in flagged(df, YEARS).collect()}


def test_planted_faults_and_nothing_else(spark):
    r = random.Random(5)
    rows, want = [], {}
    for c, move in (("CALM", 0.01), ("WILD", 0.2)):
        rows += [(len(rows) + k, c if k % 2 else f" {c.lower()} ", *series(r, move)) for k in range(60)]
    rows = [(i, *x[1:]) for i, x in enumerate(rows)]

    def put(i, changes, reason):
        row = list(rows[i])
        for year, f in changes.items():
            k = YEARS.index(str(year)) + 2
            row[k] = f(row[k]) if callable(f) else f
            if reason:
                want[i, year] = reason
        rows[i] = tuple(row)

    put(3, {2010: lambda v: v * 10}, "spike")
    put(4, {2010: lambda v: v * 1.4, 2011: lambda v: v * 1.4}, "spike")
    put(5, {2023: lambda v: v / 100}, "spike")
    put(6, {2012: 0.0, 2013: -4.0}, "impossible")
    put(7, {y: (lambda v: v * 1.5) for y in range(2012, 2024)}, None)  # a lasting move
    put(8, {2009: None, 2010: lambda v: v * 10}, "spike")
    want.pop((8, 2009))
    put(63, {2010: lambda v: v * 1000}, "spike")
    put(9, {y: rows[9][2 + YEARS.index("2008")] for y in range(2009, 2013)}, "stuck")
    put(10, {y: rows[10][2 + YEARS.index("2008")] for y in range(2009, 2011)}, None)  # three equal readings are none
    assert run(spark, rows) == want


def test_sources_that_stand_still_are_not_stuck(spark):
    rows = [(i, "STILL", *[float(100 + k // 5 + i) for k in range(20)]) for i in range(30)]
    assert run(spark, rows) == {}


def test_nulls_short_rows_and_empty_table(spark):
    rows = [(1, None, *[5.0] * 20), (2, "", *[5.0] * 20), (3, "A", *[None] * 20), (4, "A", 5.0, *[None] * 19), (5, "A", -1.0, *[None] * 19), (6, "A", float("nan"), *[None] * 19)]
    assert run(spark, rows) == {(5, 2004): "impossible"}
    assert run(spark, []) == {}


def test_repeated_rows_are_judged_alike(spark):
    r = random.Random(2)
    rows = [(i, "A", *series(r)) for i in range(40)]
    bad = list(rows[0])
    bad[9] *= 50
    got = run(spark, [tuple(bad), *rows[1:], (99, *bad[1:])])
    assert got == {(0, 2011): "spike", (99, 2011): "spike"}


def test_the_tail_decides(spark):
    """Cutoffs follow the risk and each source's own tail; the floor decides for none that has readings enough."""
    from panelforge.operators.spikes import EVEN, LEAST, behaviour
    from panelforge.operators.spikes import series as ready

    r = random.Random(2)
    rows = []
    for k in range(1200):
        # Moves of LIGHT are even, those of HEAVY now and then ten times as large.
        code = "HEAVY" if k % 2 else "LIGHT"
        v, out = 100.0, []
        for _ in range(20):
            out.append(v)
            v *= 1 + (r.uniform(-0.01, 0.01) if code == "LIGHT" else r.gauss(0, 0.005) * (10 if r.random() < 0.12 else 1))
        rows.append((k, code, *out))
    rows.append((9999, "THIN", *[100.0 * 1.01**k for k in range(20)]))
    df = spark.createDataFrame([(*x, "clash", "clash") for x in rows], SCHEMA)
    at = lambda risk: {x["code"]: x for x in behaviour(ready(df, YEARS), YEARS, risk).collect()}
    usual, rarer = at(1e-5), at(1e-7)
    for c in ("LIGHT", "HEAVY"):
        assert rarer[c]["cut_one"] > 1.2 * usual[c]["cut_one"] > 1.2 * LEAST * EVEN / (EVEN + 3000) * usual[c]["base"]
    assert usual["HEAVY"]["cut_one"] / usual["HEAVY"]["base"] > 1.5 * usual["LIGHT"]["cut_one"] / usual["LIGHT"]["base"]
    assert usual["HEAVY"]["shape_end"] > usual["LIGHT"]["shape_end"]
    assert usual["THIN"]["cut_one"] > 0
    few, many = (len({(x["row_id"], x["yr"]) for x in flagged(df, YEARS, risk).collect()}) for risk in (1e-5, 1e-3))
    assert many > few
