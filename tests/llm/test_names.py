import itertools
import random

import pytest

from panelforge.llm import names

ENTRIES = [
    ("NTV", "North Voxfounand", ["north voxfounand rep.", "kingdom of north voxfounand"]), ("LON", "Lower Voxfounand", ["lower  voxfounand "]), ("TZE", "Teikgeavy Islands", None),
    ("IIF", "Isle of Wosquuia", []), ("ZAU", "Zynclaelark Union", None), ("KIR", "Kineiark", ["the kineiark", "former rukmenia", None, ""]), ("RBI", "Republic of Driquinand", None), ("HEX", "Hegonisk", ["hegoñisk"]),
]
BOOK = names.Book([(c, n, [x for x in (a or []) if x]) for c, n, a in ENTRIES])


@pytest.mark.parametrize(
    ("typed", "code"),
    [
        ("KINEIARK ", "KIR"), ("The Kineiark", "KIR"), ("Kneiark", "KIR"), ("Kinieark", "KIR"), ("K1neiark", "KIR"), ("Кineiаrk", "KIR"), ("Kíneìark", "KIR"), ("Kineiark [b]", "KIR"), ("Kineiark (est.)", "KIR"), ("Kineiark 1/", "KIR"),
        ("Kineiark 2021", "KIR"), ("Kineiark - total", "KIR"), ("Kineiark, all areas", "KIR"), ("Kineiark, Republic of", "KIR"), ("Repubic Of Kineiark", "KIR"), ("Govt. of Kineiark", "KIR"), ("KIR Kineiark", "KIR"), ("Rukmenia", "KIR"),
        ("Voxfounand (North)", "NTV"), ("N. Voxfounand", "NTV"), ("Voxfounand, Lower", "LON"), ("Low. Voxfounand", "LON"), ("Nroth Voxfounandd", "NTV"), ("Voxfounand", "NONE"), ("East Voxfounand", "NONE"), ("Islands (Teikgeavy)", "TZE"),
        ("I. of Wosquuia", "IIF"), ("Zynclaelark Un.", "ZAU"), ("Rep. Driquinand", "RBI"), ("Driquinand", "RBI"), ("Kineiark and Hegonisk", "NONE"), ("Kineiark / Hegonisk", "NONE"), ("Kineiark & Hegonisk combined", "NONE"),
        ("Kineiark, city of", "NONE"), ("Kineiark province", "NONE"), ("World", "NONE"), ("Nolskaora", "NONE"), ("", "NONE"), ("  ", "NONE"), ("-", "NONE"), ("x" * 5000, "NONE"), ("TOTAL", "NONE"), (" " * 300 + "Kineiark" + " " * 300, "KIR"), ("Kineiark " + "x" * 300, "NONE"),
    ],
)
def test_meaning(typed, code):
    assert BOOK.find(typed)[0] == code


def plain_distance(a, b):
    """Unrestricted Damerau-Levenshtein with unit costs, by the textbook."""
    far = len(a) + len(b)
    d = {(-1, -1): far}
    for i in range(len(a) + 1):
        d[i, -1], d[i, 0] = far, i
    for j in range(len(b) + 1):
        d[-1, j], d[0, j] = far, j
    last = {}
    for i in range(1, len(a) + 1):
        col = 0
        for j in range(1, len(b) + 1):
            k, m = last.get(b[j - 1], 0), col
            cost = 0 if a[i - 1] == b[j - 1] else 1
            if not cost:
                col = j
            d[i, j] = min(d[i - 1, j - 1] + cost, d[i, j - 1] + 1, d[i - 1, j] + 1, d[k - 1, m - 1] + (i - k - 1) + 1 + (j - m - 1))
        last[a[i - 1]] = i
    return d[len(a), len(b)]


def test_dictionary_finds_all_within_two_edits():
    r = random.Random(3)
    words = {"".join(r.choice("abc") for _ in range(r.randrange(6, 10))) for _ in range(120)}
    index = names.Book._index({w: None for w in words})
    book = names.Book([("A", w, []) for w in words])
    for _ in range(150):
        typed = "".join(r.choice("abc") for _ in range(r.randrange(6, 10)))
        got = {w for c, w in book._near(typed, index, 2)}
        assert {w for w in words if plain_distance(typed, w) <= 2} == got


def test_weighted_distance_bounds_the_plain_one():
    for a, b in itertools.product(["", "ab", "ba", "abcd", "acbd", "axcbd"], repeat=2):
        w, p = names.distance(a, b, 9), plain_distance(a, b)
        assert p * 0.9 - 1e-9 <= w <= p + 1e-9


def test_rows_nulls_repeats_and_clashing_columns(spark):
    rows = spark.createDataFrame([(1, "Kneiark", "clash"), (1, "Kneiark", "clash"), (2, None, "clash"), (3, "??", "clash")], "row_id bigint, Country string, code string")
    roster = spark.createDataFrame([(n, c, a) for c, n, a in ENTRIES] + [(None, None, None), (None, "QQQ", ["Qaxolia"])], "ifs_name string, ifs_fipscode string, alternative_names array<string>")
    got = sorted((r["row_id"], r["ifs_fipscode"]) for r in names.resolve_rows(rows, roster).collect())
    assert got == [(1, "KIR"), (1, "KIR"), (3, "NONE")]
    assert names.resolve_rows(rows.limit(0), roster).count() == 0
    assert [r["ifs_fipscode"] for r in names.resolve_rows(rows.limit(1), roster.limit(0)).collect()] == ["NONE"]


def test_every_word_may_hold_an_edit():
    book = names.Book([("UKD", "United Kingdom", []), ("KIR", "Kineiark", [])])
    assert book.find("Unitd Kingdm")[0] == "UKD"
    assert book.find("Untd Kngdm")[0] == "NONE"


def test_join_decides_as_the_dictionary_does(spark):
    r = random.Random(5)
    typed = [t for c, n, a in ENTRIES for t in [c, n, *(a or [])] if t]
    for t in list(typed):
        for _ in range(6):
            k = r.randrange(len(t))
            typed.append(r.choice([t[:k] + t[k + 1 :], t[:k] + "z" + t[k:], t + " (est.)", "The " + t, t + " and " + r.choice(typed), t.replace(" ", "")]))
    typed += ["", "  ", "World", "x" * 3000, "Nolskaora"]
    countries = spark.createDataFrame(ENTRIES, "ifs_fipscode string, ifs_name string, alternative_names array<string>")
    texts = spark.createDataFrame([(t,) for t in typed] + [(None,)], "typed string")
    pick = lambda df: {r["typed"]: tuple(r) for r in df.collect()}
    got = pick(names.resolve(texts, countries, most=3))
    assert got == pick(names.resolve(texts, countries)) and len(got) == len(set(typed))
    assert pick(names.resolve_by_join(texts.limit(0), countries)) == {}
    assert {v[1] for v in pick(names.resolve_by_join(texts, countries.limit(0))).values()} == {"NONE"}
