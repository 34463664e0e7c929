"""Names beyond ASCII in the queries over whole tables, against brute force."""

import unicodedata
from collections import Counter, defaultdict

import pytest

import __spark_entry__ as entry

COUNTRIES = [("Côte d'Ivoire", "IVO", ["Ivory Coast", "ＩＶＯＲＹ ＣＯＡＳＴ"]), ("Österreich", "AUS", ["Austria", "Shared é"]), ("Straße", "STR", None), ("Plain", "PLA", ["Shared É", "", None])]
NAMES = ["CÔTE D'IVOIRE", "Co\u0302te d'Ivoire", "Ivory Coast", "\u00a0Österreich\u2003", "ÖSTERREICH", "Osterreich", "STRASSE", "ｐｌａｉｎ", "Plain", "Plain", "Рlain", "SHARED É", "\u00a0", "", None, "a\tb"]
CODES = ["IVO", " IVO", None, "AUS", None, "XXX", "PLA", "PLA", "PLA", "", "PLA", "AUS", None, "PLA", "AUS", None]


def fold(t):
    return " ".join(unicodedata.normalize("NFKC", t).casefold().split())


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("names"))
    rows = [(i, "T", n, c) for i, (n, c) in enumerate(zip(NAMES, CODES, strict=True))]
    spark.createDataFrame(rows, "row_id bigint, table_name string, Country string, FIPS_CODE string").write.parquet(f"{d}/seriesdemopopulation.parquet")
    spark.createDataFrame(COUNTRIES, "ifs_name string, ifs_fipscode string, alternative_names array<string>").write.parquet(f"{d}/country_data.parquet")
    return d


def choices():
    """Folded name: its codes, and whether it is a country's own."""
    codes, own = defaultdict(set), {fold(n) for n, _, _ in COUNTRIES}
    for n, code, others in COUNTRIES:
        for a in [n, *(others or [])]:
            if a and a.strip():
                codes[fold(a)].add(code)
    return codes, own


def matches():
    codes, _ = choices()
    out = {}
    for n, rows in Counter(n.strip() for n in NAMES if n and n.strip()).items():
        to = codes[fold(n)]
        out[n] = (rows, min(to) if len(to) == 1 else None, "matched" if len(to) == 1 else "ambiguous" if to else "unresolved")
    return out


def test_concordance_of_all_names(spark, folder):
    got = {r["original_name"]: (r["rows"], r["code"], r["status"]) for r in entry.queries()["concordance_match"](spark, folder).collect()}
    assert got == matches()
    assert got["STRASSE"] == (1, "STR", "matched") and got["Рlain"][2] == "unresolved" and got["SHARED É"][2] == "ambiguous"


def test_convergence_and_status_of_all_names(spark, folder):
    to = defaultdict(list)
    for n, (_, code, _) in matches().items():
        to[code].append(n)
    want = {(c, len(n), ";".join(sorted(n))) for c, n in to.items() if c and len(n) > 1}
    assert {(r["code"], r["sources"], r["names"]) for r in entry.queries()["converging_targets"](spark, folder).collect()} == want
    assert {c for c, _, _ in want} == {"AUS", "IVO", "PLA"}
    assert [r["status"] for r in entry.queries()["concordance_status"](spark, folder).collect()] == ["blocked"]


def test_a_name_beyond_ascii_alone_blocks(spark, tmp_path):
    spark.createDataFrame([(0, "T", "Plain", "PLA"), (1, "T", "Рlain", "PLA")], "row_id bigint, table_name string, Country string, FIPS_CODE string").write.parquet(f"{tmp_path}/seriesdemopopulation.parquet")
    spark.createDataFrame(COUNTRIES, "ifs_name string, ifs_fipscode string, alternative_names array<string>").write.parquet(f"{tmp_path}/country_data.parquet")
    assert [r["status"] for r in entry.queries()["concordance_status"](spark, str(tmp_path)).collect()] == ["blocked"]


def decided(name, code):
    """The decision of one row, and its code, without reviews."""
    codes, own = choices()
    known, given = {fold(c): c for _, c, _ in COUNTRIES}, fold(code or "")
    label = fold(name or "")
    to = codes.get(label, set()) if label else set()
    if to and label not in own:
        return "error_alias_needs_review", None
    if len(to) > 1 or (to and given in known and to != {known[given]}):
        return "error_conflict", None
    if given in known:
        return "canonical_code", known[given]
    if given:
        return "error_unknown_code", None
    return ("recovered_code", min(to)) if to else ("error_unknown_name", None)


def test_repair_decides_every_row(spark, folder):
    got = {r["row_id"]: (r["decision"], r["fixed_code"]) for r in entry.queries()["repair_identity"](spark, folder).collect()}
    assert got == {i: decided(n, c) for i, (n, c) in enumerate(zip(NAMES, CODES, strict=True))}
    assert got[1] == ("canonical_code", "IVO") and got[4] == ("recovered_code", "AUS") and got[5] == ("error_unknown_code", None)
