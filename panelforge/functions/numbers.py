"""Exact reading of decimal text: what a DOUBLE holds unchanged, and what it does not."""

from __future__ import annotations

import re
from collections.abc import Iterator
from decimal import Decimal, InvalidOperation

import pandas as pd
from pyspark.sql import Column, DataFrame

NUMBER = re.compile(r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?")
#: At most 15 digits and no exponent: every such text is held by a DOUBLE, which shows it again.
PLAIN = r"^[ \t]*[+-]?(?=[0-9.]{1,16}[ \t]*\z)([0-9]{1,15}|[0-9]{1,14}\.[0-9]{0,14}|\.[0-9]{1,15})[ \t]*\z"
PLAIN_WHOLE = r"^[ \t]*[+-]?[0-9]{1,15}[ \t]*\z"


def reason_against(text: str | None) -> str | None:
    """Why a text is no number that a DOUBLE holds unchanged, or None if it is one.

    syntax: not ASCII digits with optional sign, point and exponent. overflow: not finite. underflow: non-zero text that
    becomes zero. precision: the shortest decimal form differs, or a whole number isn't held exactly.
    """
    if text is None:
        return "syntax"
    text = text.strip(" \t")
    if not NUMBER.fullmatch(text):
        return "syntax"
    mantissa = re.split("[eE]", text)[0]
    if not re.search("[1-9]", mantissa):
        return None
    held = float(text)
    if held in (float("inf"), float("-inf")):
        return "overflow"
    if held == 0:
        return "underflow"
    try:
        exact = Decimal(text)
    except InvalidOperation:
        return "precision"
    if Decimal(repr(held)) != exact:
        return "precision"
    if exact == exact.to_integral_value() and Decimal(held) != exact:
        return "precision"
    return None


def has_fraction(text: str) -> bool:
    """Whether a text that `reason_against` accepts has digits other than 0 behind the point, by value."""
    exact = float(text.strip(" \t"))
    return exact != int(exact)


def judge(once: DataFrame, whole: str | None = None, settled: str | None = None) -> DataFrame:
    """The rows (distinct texts in `value`) that are no such numbers, with `detail`.

    Where the boolean column `whole` holds, a number with a fraction is `fraction`. A text whose column `settled` isn't null
    is invalid for that reason, number or not. A map over batches rather than a
    function in a filter: the planner would push the latter below the distinct and judge every row.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            asked = batch[whole] if whole else [False] * len(batch)
            known = batch[settled] if settled else [None] * len(batch)
            detail = [s or reason_against(t) or ("fraction" if w and has_fraction(t) else None) for t, w, s in zip(batch["value"], asked, known)]
            batch = batch.assign(detail=detail)
            yield batch[batch["detail"].notna()]

    kinds = ", ".join(f"`{c}` {t}" for c, t in once.dtypes)
    return once.mapInPandas(run, f"{kinds}, detail string")


def is_plain(c: Column) -> Column:
    """Whether a text surely is a number that a DOUBLE holds unchanged; false says nothing."""
    return c.rlike(PLAIN)
