"""Problem 4: quantities recorded in different units and scales, converted to common units.

Units are named in a row's own remark, in its metadata's Units, or in other metadata text. Phrases that may name a unit are
cut out, and each distinct spelling is read once: its words are mapped to a dictionary of scale and count words, exactly or
through a character n-gram inverted index whose candidates a weighted edit distance verifies; the product of the scales is
the factor. The resulting dictionary of spellings is joined to all rows.

Defined results. A phrase names a unit only if each of its words is known and one is a scale or a counted thing; else it
says nothing and the next source counts; so does a rate (per thousand inhabitants). Digits, scripts without letters' case and words under five letters are never
guessed. Of several metadata rows of a table the last updated counts (null stamps first, of equal ones the largest text).
A row whose unit nobody names has a null factor and isn't converted. Null quantities stay null. Repeated rows keep their own
result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.functions.columns import salted_lookup

# Words for scales, counted things and fillers, in the languages of the tables.
SCALES = {
    1: ["one", "single", "individual", "individually", "unscaled", "ones", "whole", "eins"],
    10: ["ten", "tens", "zehn", "dix", "diez", "dizaines", "decenas", "十"],
    12: ["dozen", "dozens"],
    100: ["hundred", "hundreds", "cent", "cents", "centaines", "cientos", "hundert", "сот", "сотен", "сотни", "百", "00"],
    1_000: ["thousand", "thousands", "thous", "thsd", "k", "ths", "tsd", "tausend", "millier", "milliers", "mille", "mil", "miles", "тыс", "тысяч", "тысячи", "тысяча", "千", "000", "1k"],
    10_000: ["万", "萬", "myriad", "myriads"],
    100_000: ["lakh", "lakhs", "lac", "lacs"],
    1_000_000: ["million", "millions", "mio", "mn", "mln", "mill", "mm", "millionen", "millones", "millón", "milhões", "milioni", "млн", "миллион", "миллионов", "百万", "000000"],
    10_000_000: ["crore", "crores"],
    100_000_000: ["亿", "億"],
    1_000_000_000: ["billion", "billions", "bn", "bln", "mrd", "milliard", "milliards", "milliarden", "млрд"],
}
COUNTED = ["person", "persons", "people", "inhabitant", "inhabitants", "head", "heads", "habitant", "habitants", "habitantes", "personne", "personnes", "persona", "personas", "pessoas", "persone", "abitanti", "einwohner", "personen", "человек", "чел", "人", "individuals", "residents", "населения", "口"]
FILLERS = ["of", "unit", "units", "in", "x", "the", "a", "de", "des", "d", "s", "number", "numbers", "count", "counts", "at", "only", "figures"]
#: Text that tells of the source's unit or of a conversion, not of the stored figures.
ELSEWHERE = r"(?i)\b(source sheet|source file|source table|source was|source is|source's|originally|converted|conversion|were lost|revised by)\b"
#: Where a unit may be named in running text; the group is the phrase.
IN_TEXT = [
    r"(?i)\b(?:stored )?figures:\s*([^.;]+)",
    r"(?i)\bfigures (?:of this row |here )?(?:are|given in|stored in|in)\s+([^.;]+)",
    r"(?i)\b(?:stored|given|reported|reports|expressed|recorded|held|values|report|counted|measured)\s+(?:are\s+)?in\s+([^.;]+)",
    r"(?i)\bhold\s+([^.;]+)",
    r"(?i)\bheader:\s*'([^']+)'",
    r"(?i)\bNB:\s*(.+?)\s+here\b",
    r"(?i),\s*in\s+([^.;()]+)$",
    r"\(([^()]+)\)\s*$",
    r"(?i)\bunits?(?: is| are|:)\s+([^.;]+)",
]
#: Most weighted edits of a guessed word, and its least length: a shorter one is too much like others.
EDITS, SHORTEST = 2, 5
#: A guessed word shares at least this part of its n-grams with the known one.
SHARED = 0.4
TEXTS = ("Definition", "Notes", "Extended Source Defn")


def words(phrase: Column) -> Column:
    """The words of a phrase: digit groups closed up, powers of ten written out, ideographs one by one."""
    text = F.lower(F.trim(phrase))
    for k in range(2, 10):
        text = F.regexp_replace(text, rf"10\^{k}(?![0-9])", "1" + "0" * k)
        text = F.regexp_replace(text, "10" + "⁰¹²³⁴⁵⁶⁷⁸⁹"[k], "1" + "0" * k)
    text = F.regexp_replace(text, r"(?<=[0-9])[ ,.'  ](?=[0-9]{3}(?![0-9]))", "")
    return F.regexp_extract_all(text, F.lit(r"([一-鿿]|[0-9]+|[\p{L}&&[^一-鿿]]+)"), 1)


def grams(word: str) -> set[str]:
    """Distinct character trigrams of a word with marked ends."""
    padded = f"^{word}$"
    return {padded[i : i + 3] for i in range(len(padded) - 2)} or {padded}


def weighted_edits(a: str, b: str) -> float:
    """Damerau-Levenshtein distance: swapped neighbours and doubled letters cost 0.5, vowels for vowels 0.7, all else 1."""
    vowels = set("aeiouyäöüéèáíóúаеиоуы")
    rows = [[0.0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        rows[i][0] = float(i)
    for j in range(1, len(b) + 1):
        rows[0][j] = float(j)
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            x, y = a[i - 1], b[j - 1]
            swap = 0.0 if x == y else 0.7 if x in vowels and y in vowels else 1.0
            drop = 0.5 if i > 1 and a[i - 2] == x else 1.0
            add = 0.5 if j > 1 and b[j - 2] == y else 1.0
            best = min(rows[i - 1][j - 1] + swap, rows[i - 1][j] + drop, rows[i][j - 1] + add)
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                best = min(best, rows[i - 2][j - 2] + 0.5)
            rows[i][j] = best
    return rows[-1][-1]


class Words:
    """The dictionary of unit words with an inverted index of the trigrams of those that may be guessed."""

    def __init__(self) -> None:
        self.known: dict[str, tuple[float | None, str]] = {"1" + "0" * k: (10.0**k, "scale") for k in range(10)}
        for factor, words in SCALES.items():
            self.known |= {w: (float(factor), "scale") for w in words}
        self.known |= dict.fromkeys(COUNTED, (None, "counted")) | dict.fromkeys(FILLERS, (None, "filler"))
        self.grams = {w: grams(w) for w in self.known if len(w) >= SHORTEST}
        self.index: dict[str, list[str]] = {}
        for w, own in self.grams.items():
            for g in own:
                self.index.setdefault(g, []).append(w)
        self.longest = max(map(len, self.known)) + EDITS
        self.read: dict[str, tuple[float | None, str] | None] = {}

    def match(self, token: str) -> tuple[float | None, str] | None:
        """Scale and kind of a word that is known or close enough to one known word; two at the same distance with other
        scales decide nothing."""
        if token in self.known:
            return self.known[token]
        if token not in self.read:
            self.read[token] = self._guess(token)
        return self.read[token]

    def _guess(self, token: str) -> tuple[float | None, str] | None:
        # A word longer than all known ones by more than the edits allowed is none of them.
        if not SHORTEST <= len(token) <= self.longest or not token.isalpha():
            return None
        own = grams(token)
        shared: dict[str, int] = {}
        for g in own:
            for w in self.index.get(g, ()):
                shared[w] = shared.get(w, 0) + 1
        near = [w for w, n in shared.items() if 2 * n / (len(own) + len(self.grams[w])) >= SHARED]
        close = sorted(x for x in ((weighted_edits(token, w), w) for w in near) if x[0] <= (EDITS if len(token) >= 8 else 1))
        if not close or len({self.known[w][0] for cost, w in close if cost == close[0][0]}) > 1:
            return None
        return self.known[close[0][1]]

    def factor(self, tokens: list[str]) -> int | None:
        """The product of the scales of a phrase, if each of its words is known and one is a scale or a counted thing."""
        read = [self.match(t) for t in tokens]
        if None in read or not any(kind in ("scale", "counted") for _, kind in read):
            return None
        product = 1.0
        for scale, _ in read:
            product *= scale or 1.0
        return round(product) if product < 2**63 else None


def read_spellings(spellings: DataFrame) -> DataFrame:
    """phrase and factor of each distinct phrase that names a unit, each read once."""
    each = spellings.select("phrase").where("phrase IS NOT NULL").distinct().withColumn("tokens", words(F.col("phrase"))).where(F.size("tokens") > 0)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        book = Words()
        for batch in batches:
            factors = [book.factor(list(t)) for t in batch["tokens"]]
            told = [f is not None for f in factors]
            yield pd.DataFrame({"phrase": batch["phrase"][told], "factor": [f for f in factors if f is not None]})

    return each.mapInPandas(run, "phrase string, factor bigint")


def phrases(text: Column, patterns: list[str] = IN_TEXT) -> Column:
    """Phrases of a running text that may name the unit of what is stored, in the order of the patterns."""
    found = F.array(*[F.nullif(F.trim(F.regexp_extract(text, p, 1)), F.lit("")) for p in patterns])
    return F.when(text.isNull() | text.rlike(ELSEWHERE), F.array().cast("array<string>")).otherwise(F.array_compact(found))


def _sentences(text: Column) -> Column:
    """Phrases of all sentences of a text, so that one about the source doesn't hide the next."""
    parts = F.split(F.coalesce(text, F.lit("")), r"(?<=[.!?])\s+")
    return F.flatten(F.transform(parts, lambda t: phrases(t)))


def latest_metadata(datadict: DataFrame) -> DataFrame:
    """One metadata row per Table: the last updated."""
    rest = [c for c in ("Units", *TEXTS) if c in datadict.columns]
    top = datadict.where("`Table` IS NOT NULL").groupBy("Table").agg(F.max(F.struct(F.coalesce(F.col("`Last IFs Update`"), F.lit("")).alias("stamp"), *[F.col(f"`{c}`") for c in rest])).alias("m"))
    return top.select(F.col("Table").alias("table_name"), *[F.col(f"m.`{c}`").alias(c) for c in rest])


def unit_factors(rows: DataFrame, datadict: DataFrame) -> DataFrame:
    """rows with `factor`, the number of persons in one unit of their figures, and `told_by` (remark, units, text), or nulls."""
    meta = latest_metadata(datadict)
    order = [F.array(F.col("Units"))] + [_sentences(F.col(f"`{c}`")) for c in TEXTS]
    said = meta.select("table_name", F.filter(F.concat(*order), lambda x: x.isNotNull()).alias("said"), F.col("Units").isNotNull().alias("has_units"))
    remarks = rows.where("remark IS NOT NULL").select("remark").distinct().withColumn("said", _sentences(F.col("remark")))
    every = reduce(DataFrame.union, [d.select(F.explode("said").alias("phrase")) for d in (said, remarks)])
    book = read_spellings(every)

    def first_named(df: DataFrame, key: str) -> DataFrame:
        flat = df.select(key, F.posexplode("said").alias("pos", "phrase")).join(book, "phrase")
        return flat.groupBy(key).agg(F.min_by("factor", "pos").alias("factor"), F.min("pos").alias("pos"))

    by_table = first_named(said, "table_name").join(said.select("table_name", "has_units"), "table_name").select(
        "table_name", F.col("factor").alias("_t"), F.when(F.col("has_units") & (F.col("pos") == 0), "units").otherwise("text").alias("_by"))
    by_remark = first_named(remarks, "remark").select("remark", F.col("factor").alias("_r"))
    with_remark = salted_lookup(rows.where("remark IS NOT NULL"), by_remark, ["remark"])
    both = with_remark.unionByName(rows.where("remark IS NULL").withColumn("_r", F.lit(None).cast("bigint")))
    known = salted_lookup(both, by_table, ["table_name"])
    return known.withColumns({"factor": F.coalesce("_r", "_t"), "told_by": F.when(F.col("_r").isNotNull(), "remark").when(F.col("_t").isNotNull(), F.col("_by"))}).drop("_r", "_t", "_by")


def in_persons(rows: DataFrame, datadict: DataFrame, value: str = "2023") -> DataFrame:
    """row_id, factor, told_by, the value as stored and in persons; the latter null where nobody names the unit."""
    known = unit_factors(rows, datadict)
    return known.select("row_id", "table_name", "factor", "told_by", F.col(f"`{value}`").alias("stored"), (F.col(f"`{value}`") * F.col("factor")).alias("persons"))
