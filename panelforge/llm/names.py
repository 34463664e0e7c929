"""Problem 5: free-entered values mapped to the closest entry of a reference list, with the unmatched reported.

A name is read as its qualifiers (north, islands, isle), its form of government (no part of the meaning) and its core word.
Cores are looked up in a symmetric-delete dictionary of the reference's cores: every deletion of up to two characters of a
known core points at it, so a typed core finds all cores within two edits by its own deletions alone. Candidates are ranked
by weighted Damerau-Levenshtein distance, then by how often the reference bears the word. Each distinct text is looked up
once. The dictionary holds some hundred deletions per reference word; up to MOST_NAMES entries it is carried to the tasks. A
longer list is joined as a table of deletions: each text meets the entries that share a deletion, a code or a name with it,
and is then decided among them as it would be among all.

Defined results. Null texts aren't looked up. A text that holds a word which is no part of a known name, two names, or a core
that several entries share without their qualifiers is `NONE`. Empty and blank texts are `NONE`. Texts may have any length;
blanks around them don't count. A tie between entries at equal distance and frequency is `NONE`. Repeated rows
get the same result.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.functions.columns import salted_lookup

NONE = "NONE"
#: Most edits between a typed and a known core, and for cores shorter than SHORT.
EDITS, SHORT, SHORT_EDITS = 2, 6, 1
#: Most edits in a whole text without its blanks: one, or two from so many characters on.
WHOLE_EDITS, LONG = 2, 10
#: A reference of up to so many entries is carried in the closure (some kB of deletions each); a longer one is joined.
MOST_NAMES = 20_000

# Words that name no place by themselves.
GOVERNMENT = ["republic", "kingdom", "state", "federation", "commonwealth", "united", "provinces", "democratic", "mainland", "former", "government", "govt", "the", "of"]
QUALIFIERS = ["north", "south", "east", "west", "upper", "lower", "new", "saint", "islands", "isle", "union", "central", "island"]
SHORT_FORMS = {"rep": "republic", "repub": "republic", "dem": "democratic", "fed": "federation", "kgdm": "kingdom", "n": "north", "s": "south", "e": "east", "w": "west", "no": "north", "so": "south", "st": "saint", "un": "union", "is": "islands", "isl": "islands", "isls": "islands", "up": "upper", "low": "lower", "i": "isle", "lr": "lower", "lwr": "lower", "nw": "new", "utd": "united", "prov": "provinces", "comm": "commonwealth"}
#: Words for a part of a place, or for a group of them.
ELSEWHERE = ["province", "city", "district", "region", "county", "municipality", "town", "territory", "department", "coast", "capital", "economies", "countries", "states", "members", "world"]
#: Remarks beside a name that don't change what it means.
REMARKS = ["total", "est", "estimate", "estimated", "provisional", "prov", "revised", "note", "all", "areas", "whole", "country", "p", "r", "f"]
#: Letters of other scripts that look like Latin ones.
LOOKALIKES = str.maketrans("авеёкмнорстухіјѕӏԁԛԝһαβεηικνορτυχϲ", "abeekmhopctyxijsldqwhabenikvoptuxc")
#: Digits typed for the letters they resemble.
DIGITS = str.maketrans("0135", "olez".replace("z", "s"))
TOGETHER = re.compile(r"[/&+;|]|\b(?:and|with|plus)\b")
FOOTNOTE = re.compile(r"\[[^\]]*\]|[*†‡§]+|\b\d+/|\(\s*(?:[a-z]|\d+|est\.?|p|r|prov\.?|rev\.?)\s*\)|\d{4}(?:[-/]\d{2,4})?\s*$|^\s*\d{4}\b")


def fold(text: str) -> str:
    """Lower case, compatibility forms resolved, accents and look-alike letters replaced, footnotes and spacing gone."""
    t = unicodedata.normalize("NFKC", text).casefold().replace("_", " ")
    t = "".join(c for c in unicodedata.normalize("NFD", t) if unicodedata.category(c) not in ("Mn", "Cf"))
    t = t.translate(LOOKALIKES).replace("ø", "o").replace("ł", "l").replace("đ", "d").replace("ı", "i")
    t = FOOTNOTE.sub(" ", t)
    return " ".join(t.split())


def distance(a: str, b: str, most: float) -> float:
    """Weighted, unrestricted Damerau-Levenshtein: swaps 0.9 even with edits between, vowel for vowel 0.9, else 1."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    vowels = "aeiouy"
    far = float(len(a) + len(b))
    d = [[far] * (len(b) + 2) for _ in range(len(a) + 2)]
    for i in range(len(a) + 1):
        d[i + 1][1] = float(i)
    for j in range(len(b) + 1):
        d[1][j + 1] = float(j)
    last_row: dict[str, int] = {}
    for i, x in enumerate(a, 1):
        last_col = 0
        for j, y in enumerate(b, 1):
            k, m = last_row.get(y, 0), last_col
            cost = 0.0 if x == y else 0.9 if x in vowels and y in vowels else 1.0
            swap = d[k][m] + (i - k - 1) + 0.9 + (j - m - 1) if k and m else far
            d[i + 1][j + 1] = min(d[i][j] + cost, d[i][j + 1] + 1, d[i + 1][j] + 1, swap)
            if x == y:
                last_col = j
        last_row[x] = i
    return d[-1][-1]


def deletions(word: str, most: int) -> set[str]:
    """word and all that is left of it when up to `most` characters are deleted."""
    out, edge = {word}, {word}
    for _ in range(most):
        edge = {w[:i] + w[i + 1 :] for w in edge for i in range(len(w))}
        out |= edge
    return out


class Book:
    """The reference: exact texts, and a symmetric-delete dictionary of core words with the qualifiers they are known with."""

    def __init__(self, entries: list[tuple[str, str, list[str]]]) -> None:
        """entries: code, name and other names."""
        self.exact: dict[str, set[str]] = defaultdict(set)
        self.cores: dict[str, dict[tuple[str, ...], set[str]]] = defaultdict(lambda: defaultdict(set))
        self.often: Counter[str] = Counter()
        self.codes = {code.casefold() for code, _, _ in entries}
        self.joined: dict[str, set[str]] = defaultdict(set)
        self.words = {w: w for w in [*GOVERNMENT, *QUALIFIERS]}
        for code, name, others in entries:
            for text in {fold(t) for t in [name, *others] if t and t.strip()}:
                self.exact[" ".join(re.findall(r"\w+", text))].add(code)
                self.joined["".join(re.findall(r"\w+", text))].add(code)
                tokens = [SHORT_FORMS.get(w, w) for w in re.findall(r"\w+", text)]
                core = [w for w in tokens if w not in GOVERNMENT and w not in QUALIFIERS]
                if core:
                    # A name of several core words is one core with blanks.
                    c = " ".join(core)
                    self.cores[c][tuple(sorted(w for w in tokens if w in QUALIFIERS))].add(code)
                    self.often[c] += 1
        self.known = self._index(self.cores)
        self.helpers = self._index({w: None for w in self.words if len(w) >= 3})
        self.whole = self._index(self.joined)
        self.longest = max(map(len, [*self.cores, *self.joined, *self.words]), default=0)

    @staticmethod
    def _index(words: dict) -> dict[str, list[str]]:
        index: dict[str, list[str]] = defaultdict(list)
        for w in words:
            for d in deletions(w, EDITS if len(w) >= SHORT else SHORT_EDITS):
                index[d].append(w)
        return dict(index)

    def _near(self, word: str, index: dict[str, list[str]], most: int) -> list[tuple[float, str]]:
        """Indexed words within `most` edits, by their distance; one that is longer than all of them by more has none."""
        if len(word) > self.longest + most:
            return []
        seen = {w for d in deletions(word, most) for w in index.get(d, ())}
        close = [(distance(word, w, most), w) for w in seen]
        return sorted(x for x in close if x[0] <= min(most, EDITS if len(x[1]) >= SHORT else SHORT_EDITS))

    def _helper(self, word: str) -> str | None:
        """The government word or qualifier that a typed word is, up to an edit or two in long ones."""
        if word in self.words:
            return word
        if len(word) < 3:
            return None
        near = self._near(word, self.helpers, EDITS if len(word) >= 7 else 1)
        # A word typed closer to a known core is that core.
        return near[0][1] if near and len({w for c, w in near if c == near[0][0]}) == 1 else None

    def _choose(self, cores: list[tuple[float, str]], qualifiers: tuple[str, ...]) -> tuple[str, float, str] | None:
        """The one code of the closest core that is known with these qualifiers, its distance and core."""
        fit = [(cost, -self.often[c], c, self.cores[c][qualifiers]) for cost, c in cores if qualifiers in self.cores[c]]
        if not fit:
            return None
        fit.sort(key=lambda x: x[:3])
        best = set().union(*[codes for cost, n, _, codes in fit if (cost, n) == fit[0][:2]])
        return (next(iter(best)), fit[0][0], fit[0][2]) if len(best) == 1 else None

    def find(self, text: str) -> tuple[str, float, str]:
        """code (or NONE), distance and the way it was found."""
        t = fold(text)
        bare = " ".join(re.findall(r"\w+", t))
        if not bare:
            return NONE, 0.0, "no name"
        if len(codes := self.exact.get(bare, set())) == 1:
            return next(iter(codes)), 0.0, "exact"
        if TOGETHER.search(t):
            return NONE, 0.0, "several"
        tokens = bare.split()
        # A digit inside a word stands for the letter that it resembles.
        tokens = [w.translate(DIGITS) if re.search("[a-z]", w) and re.search(r"\d", w) else w for w in tokens]
        tokens = [w for w in tokens if not w.isdigit()]
        if any(w in ELSEWHERE for w in tokens):
            return NONE, 0.0, "another place"
        if len(tokens) > 1:
            first, last = tokens[0], tokens[-1]
            if first in self.codes and first not in self.words:
                tokens = tokens[1:]
            elif last in self.codes and last not in self.words:
                tokens = tokens[:-1]
        qualifiers, core = [], []
        for w in tokens:
            w = SHORT_FORMS.get(w, w)
            near = self._near(w, self.known, EDITS if len(w) >= SHORT else SHORT_EDITS) if w not in self.words else []
            helper = self._helper(w)
            if helper and not (near and near[0][0] == 0):
                if helper in QUALIFIERS:
                    qualifiers.append(helper)
            elif w in REMARKS:
                continue
            else:
                core.append((w, near))
        if len(core) == 1 and core[0][1]:
            key = tuple(sorted(qualifiers))
            if found := self._choose(core[0][1], key):
                return found[0], found[1], "core"
            if not key:
                # Without its qualifier a core means an entry only if no other entry has that core.
                cost, c = core[0][1][0]
                codes = set().union(*self.cores[c].values())
                if len(codes) == 1:
                    return next(iter(codes)), cost, "bare core"
            return NONE, 0.0, "other qualifier"
        # Blanks lost or set within a word: the whole text without blanks.
        joined = "".join(tokens)
        near = self._near(joined, self.whole, _whole_edits(joined)) if len(core) != 1 or len(joined) >= SHORT else []
        if near:
            codes = set().union(*[self.joined[w] for cost, w in near if cost == near[0][0]])
            if len(codes) == 1:
                return next(iter(codes)), near[0][0], "joined"
        return NONE, 0.0, "unknown"


def _whole_edits(joined: str) -> int:
    return WHOLE_EDITS if len(joined) >= LONG else 1


def entry_keys(code: str, names: list[str]) -> set[str]:
    """What leads to an entry: its code, its names, and the deletions of its cores and of its names without blanks."""
    own = Book([(code, "", names)])
    marked = {"a": own.exact, "c": own.known, "j": own.whole}
    return {f"k{code.casefold()}"} | {kind + key for kind, keys in marked.items() for key in keys}


def text_keys(text: str, longest: int) -> set[str]:
    """What a text may meet an entry by. Words longer than any key of the reference by more than the edits meet none."""
    bare = " ".join(re.findall(r"\w+", fold(text)))
    tokens = [w.translate(DIGITS) if re.search("[a-z]", w) and re.search(r"\d", w) else w for w in bare.split()]
    tokens = [w for w in tokens if not w.isdigit()]
    keys = {"a" + bare} | {"k" + w for w in tokens}
    for w in {SHORT_FORMS.get(w, w) for w in tokens}:
        if len(w) <= longest + EDITS:
            keys |= {"c" + d for d in deletions(w, EDITS if len(w) >= SHORT else SHORT_EDITS)}
    for joined in {"".join(tokens), "".join(tokens[1:]), "".join(tokens[:-1])}:
        if len(joined) <= longest + WHOLE_EDITS:
            keys |= {"j" + d for d in deletions(joined, _whole_edits(joined))}
    return keys


def resolve_by_join(texts: DataFrame, countries: DataFrame) -> DataFrame:
    """The same as `resolve` for a reference list of any length, which never leaves the cluster."""
    listed = countries.where("ifs_fipscode IS NOT NULL").select("ifs_fipscode", "ifs_name", "alternative_names")

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [(k, r.ifs_fipscode) for r in batch.itertuples() for k in entry_keys(r.ifs_fipscode, _names(r.ifs_name, r.alternative_names))]
            yield pd.DataFrame(found, columns=["key", "code"])

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([(t, k) for t in batch["typed"] for k in text_keys(t, longest)], columns=["typed", "key"])

    def decide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [Book([(e["code"], e["ifs_name"] or "", _names(None, e["alternative_names"])) for e in (entries if entries is not None else [])]).find(t) for t, entries in zip(batch["typed"], batch["entries"])]
            yield pd.DataFrame({"typed": batch["typed"], "ifs_fipscode": [f[0] for f in found], "edits": [f[1] for f in found], "how": [f[2] for f in found]})

    once = texts.select("typed").where("typed IS NOT NULL").distinct()
    keyed = listed.mapInPandas(index, "key string, code string")
    longest = keyed.agg(F.max(F.length("key"))).first()[0] or 0
    met = once.mapInPandas(ask, "typed string, key string").join(keyed, "key").select("typed", "code").distinct()
    entries = met.join(listed.withColumnRenamed("ifs_fipscode", "code"), "code").groupBy("typed").agg(F.collect_list(F.struct("code", "ifs_name", "alternative_names")).alias("entries"))
    return once.join(entries, "typed", "left").mapInPandas(decide, RESOLVED)


def _names(name: str | None, others: object) -> list[str]:
    return [x for x in [name, *(others if others is not None else [])] if x]


RESOLVED = "typed string, ifs_fipscode string, edits double, how string"


def reference(countries: DataFrame, most: int = MOST_NAMES) -> list[tuple[str, str, list[str]]] | None:
    """The reference list, or None if it has more than `most` entries."""
    rows = countries.where("ifs_fipscode IS NOT NULL").select("ifs_fipscode", "ifs_name", "alternative_names").limit(most + 1).collect()
    return None if len(rows) > most else [(r[0], r[1] or "", _names(None, r[2])) for r in rows]


def resolve(texts: DataFrame, countries: DataFrame, most: int = MOST_NAMES) -> DataFrame:
    """typed, ifs_fipscode (or NONE), edits and how, for each distinct non-null text of the column `typed`."""
    entries = reference(countries, most)
    if entries is None:
        return resolve_by_join(texts, countries)

    def look_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        book = Book(entries)
        for batch in batches:
            found = [book.find(t) for t in batch["typed"]]
            yield pd.DataFrame({"typed": batch["typed"], "ifs_fipscode": [f[0] for f in found], "edits": [f[1] for f in found], "how": [f[2] for f in found]})

    # Distinct texts are small, so that they would be put together into one task; by the column itself the planner would merge both.
    once = texts.select("typed").where("typed IS NOT NULL").distinct().repartition(2 * texts.sparkSession.sparkContext.defaultParallelism, F.xxhash64("typed"))
    return once.mapInPandas(look_up, RESOLVED)


def resolve_rows(rows: DataFrame, countries: DataFrame, column: str = "Country") -> DataFrame:
    """rows with a non-null `column`, each with ifs_fipscode (or NONE), edits and how."""
    named = rows.where(F.col(f"`{column}`").isNotNull()).withColumn("typed", F.col(f"`{column}`"))
    return salted_lookup(named, resolve(named, countries), ["typed"]).drop("typed")
