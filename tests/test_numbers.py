from decimal import Decimal

from hypothesis import given
from hypothesis import strategies as st

from panelforge.functions.numbers import NUMBER, PLAIN, reason_against


def test_known_texts():
    fine = ["1", "1e22", "0.1", "0e3", "0e99999999999999999999", "-3.9e1", "5.", ".5", " 7\t", "1e-300", "+0", "9007199254740992"]
    bad = {"": "syntax", ".": "syntax", "e5": "syntax", "1\n": "syntax", "１": "syntax", "1_000": "syntax", "NaN": "syntax", "1e999": "overflow", "4e-999": "underflow", "1e23": "precision", "9007199254740993": "precision", "0.1234567890123456789": "precision", "9" * 5000: "overflow"}
    assert [t for t in fine if reason_against(t)] == []
    assert {t: reason_against(t) for t in bad} == bad
    assert reason_against(None) == "syntax"


@given(st.floats(allow_nan=False, allow_infinity=False))
def test_shortest_form_is_held(x):
    assert reason_against(repr(x)) in (None, "precision")
    if x != int(x) if abs(x) < 1e300 else False:
        assert reason_against(repr(x)) is None


@given(st.from_regex(r"[+-]?[0-9]{1,8}(\.[0-9]{1,7})?", fullmatch=True))
def test_plain_texts_need_no_verdict(t):
    import re

    assert re.match(PLAIN.replace(r"\z", r"\Z"), t) and NUMBER.fullmatch(t)
    assert reason_against(t) is None
    assert Decimal(repr(float(t))) == Decimal(t)
