"""Problem 9: evaluation passages that appear, whole or in part, word for word or paraphrased, in documents.

Latent semantic retrieval over passages. Both sides are cut into overlapping passages of twenty words, one begun every ten
(forty letters every twenty for Chinese and Japanese), so that any ten consecutive words lie whole in a passage. The
passages of the items form a TF-IDF matrix, weighted by document frequencies counted over all documents; a distributed
randomised SVD of it gives the latent space; all passages of all documents are projected into it, and the item passages
within a cosine of NEAR are candidates. Candidates are then checked on the words themselves: by the longest common
subsequence with the document's text around the passage, by the windows of ten consecutive words (twenty letters) that both
hold, and by the item's answers, which are its numbers and the words that hardly another item has. Nothing is found that retrieval doesn't bring up.

A passage with fewer known terms than a window has can pass no check and isn't projected.

Defined results. Case, punctuation, spacing, line ends, compatibility forms and invisible characters don't count. Null and
empty texts hold nothing; items shorter than a window can't leak. Repeated documents and items are each reported. A passage
with less than two answers leaks as a paraphrase only if they and nearly all of its words are there. Any number of items is searched, in blocks
of ITEMS_AT_ONCE with one pass over the documents each.
"""

from __future__ import annotations

import re as ascii_re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import regex as re
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.session import spread

#: A window: so many consecutive words, or letters and digits, are a leak. Passages are two windows long and begin at each.
WORDS, LETTERS = 10, 20
RANK, OVERSAMPLE, POWER, SEED = 96, 16, 2, 7
#: Least cosine of a candidate. Passages that share a window had 0.79 or more on check_s.
NEAR = 0.5
#: Least part of an item passage that a paraphrase holds in order, with answers and with less than two to check.
LIKE, LIKE_WITHOUT_ANSWERS = 0.7, 0.9
#: Least part of the answers of an item passage that a paraphrase keeps. Answers are numbers, and words that at most this share
#: of the documents and this share of the items (or two) hold: what an item says, rather than how such items are put.
ANSWERED, RARE, OWN = 0.6, 0.002, 0.01
ITEMS_AT_ONCE = 5_000
#: Document passages compared with the item passages at a time.
BLOCK = 2048

_TOKEN = re.compile(r"[\p{L}\p{M}\p{N}]+")
_PLAIN_TOKEN = ascii_re.compile(r"[a-z0-9]+")
_CONTROL = ascii_re.compile(r"[\x00-\x08\x0e-\x1f\x7f]")
_HIDDEN = re.compile(r"[\p{Cf}\p{Cc}&&[^\t\n\r\v\f]]+", re.V1)
_WIDE = re.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}]")


def tokens(text: str) -> list[str]:
    """The words of a text, folded."""
    if text.isascii() and not _CONTROL.search(text):
        return _PLAIN_TOKEN.findall(text.lower())
    return _TOKEN.findall(unicodedata.normalize("NFKC", _HIDDEN.sub("", text)).casefold())


def _is_wide(lang: str | None, passage: str) -> bool:
    return (lang or "").strip().lower()[:2] in ("zh", "ja") or len(_WIDE.findall(passage)) > len(passage) / 3


def terms(units: list[str] | str) -> list[str]:
    """What a passage is weighted by: its words, or the pairs of its letters."""
    return units if isinstance(units, list) else [units[i : i + 2] for i in range(len(units) - 1)]


def passages(units: list[str] | str, step: int) -> list:
    """Overlapping passages of two steps, one begun every step; together they hold every run of a step's length."""
    return [units[i : i + 2 * step] for i in range(0, max(1, len(units) - step), step)]


def common_subsequence(masks: dict[str, int], length: int, units: list[str] | str) -> int:
    """Length of the longest common subsequence of `units` and a passage of `length` units, given its places by unit as bits."""
    row = full = (1 << length) - 1
    for u in units:
        m = masks.get(u)
        if m:
            met = row & m
            row = ((row + met) | (row - met)) & full
    return length - row.bit_count()


@dataclass(frozen=True)
class Passage:
    item: int
    units: list[str] | str
    windows: frozenset
    masks: dict[str, int]
    repeats: int


class Passages:
    """The passages of all items, words first, with their vocabulary."""

    def __init__(self, rows: list[tuple[int, str | None, str | None]]) -> None:
        worded: list[Passage] = []
        lettered: list[Passage] = []
        for item, lang, passage in rows:
            units: list[str] | str = tokens(passage or "")
            step, out = WORDS, worded
            if _is_wide(lang, passage or ""):
                units, step, out = "".join(units), LETTERS, lettered
            if len(units) >= step:
                out += [self._passage(item, p, step) for p in passages(units, step)]
        self.all, self.worded = worded + lettered, len(worded)
        self.terms = {t: i for i, t in enumerate(sorted({t for p in self.all for t in terms(p.units)}))}

    def by_item(self) -> dict[int, set[str]]:
        """The terms of each item."""
        out: dict[int, set[str]] = {}
        for p in self.all:
            out.setdefault(p.item, set()).update(terms(p.units))
        return out

    @staticmethod
    def _passage(item: int, units: list[str] | str, step: int) -> Passage:
        masks: dict[str, int] = {}
        for k, u in enumerate(units):
            masks[u] = masks.get(u, 0) | 1 << k
        return Passage(item, units, frozenset(windows(units, step)), masks, len(units) - len(masks))


def windows(units: list[str] | str, size: int) -> list:
    return [units[i : i + size] if isinstance(units, str) else tuple(units[i : i + size]) for i in range(len(units) - size + 1)]


def streams(text: str, letters: bool) -> list[tuple[list[str] | str, int]]:
    """The words of a text with the step of their passages, and its letters where it has such and they are asked for."""
    words = tokens(text)
    return [(words, WORDS), ("".join(words), LETTERS)] if letters and _WIDE.search(text) else [(words, WORDS)]


def document_frequencies(documents: DataFrame, known: Passages) -> tuple[int, dict[str, int]]:
    """The number of documents, and of those that hold each term, over all documents. Bounded by the terms of the items."""
    vocabulary, letters = frozenset(known.terms), known.worded < len(known.all)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count: Counter[str] = Counter()
        for batch in batches:
            count["\n"] += len(batch)
            for text in batch["text"]:
                if text:
                    for units, _ in streams(text, letters):
                        count.update(vocabulary.intersection(terms(units)))
        if count:
            yield pd.DataFrame({"term": list(count), "n": list(count.values())})

    counted = spread(documents.select("doc_id", "text"), "doc_id").mapInPandas(run, "term string, n bigint")
    found = {r["term"]: r["n"] for r in counted.groupBy("term").agg(F.sum("n").alias("n")).collect()}
    return found.pop("\n", 0), found


def weigh(rows: list[list[str]], index: dict[str, int], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, term and weight of the normed TF-IDF vectors of passages, given their terms."""
    at, cols, vals = [], [], []
    for r, row in enumerate(rows):
        c = Counter(index[t] for t in row if t in index)
        w = np.array([n * idf[t] for t, n in c.items()])
        norm = float(np.sqrt((w * w).sum())) or 1.0
        at += [r] * len(c)
        cols += list(c)
        vals += list(w / norm)
    return np.array(at, dtype=int), np.array(cols, dtype=int), np.array(vals)


def _times(rows: np.ndarray, cols: np.ndarray, vals: np.ndarray, n: int, dense: np.ndarray) -> np.ndarray:
    """The product of a sparse matrix of n rows with a dense one, in blocks of entries."""
    out = np.zeros((n, dense.shape[1]))
    for a in range(0, len(rows), 50_000):
        s = slice(a, a + 50_000)
        np.add.at(out, rows[s], vals[s, None] * dense[cols[s]])
    return out


def latent_space(table: DataFrame, index: dict[str, int], idf: np.ndarray, rank: int = RANK) -> np.ndarray:
    """Right singular vectors (terms by rank) of the TF-IDF matrix whose rows are the passages in `terms`, by randomised SVD.

    Each round multiplies a tall orthonormal basis by A'A: tasks do it for their own rows, partial products are summed in
    blocks of terms, and only the basis (terms by rank) is orthonormalised on the driver.
    """
    width = min(rank + OVERSAMPLE, len(index))
    basis = np.random.default_rng(SEED).standard_normal((len(index), width))

    def multiply(q: np.ndarray) -> np.ndarray:
        def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros_like(q)
            for batch in batches:
                rows = [list(t) for t in batch["terms"]]
                r, c, v = weigh(rows, index, idf)
                total += _times(c, r, v, len(index), _times(r, c, v, len(rows), q))
            blocks = range(0, len(total), 4096)
            yield pd.DataFrame({"block": list(blocks), "data": [total[b : b + 4096].tobytes() for b in blocks]})

        def add(pdf: pd.DataFrame) -> pd.DataFrame:
            total = sum(np.frombuffer(d) for d in pdf["data"])
            return pd.DataFrame({"block": [pdf["block"].iloc[0]], "data": [np.asarray(total).tobytes()]})

        parts = table.select("terms").mapInPandas(part, "block int, data binary").groupBy("block").applyInPandas(add, "block int, data binary").collect()
        return np.concatenate([np.frombuffer(r["data"]).reshape(-1, q.shape[1]) for r in sorted(parts, key=lambda r: r["block"])])

    q = np.linalg.qr(basis)[0]
    for _ in range(POWER):
        q = np.linalg.qr(multiply(q))[0]
    values, vectors = np.linalg.eigh(q.T @ multiply(q))
    keep = np.argsort(values)[::-1][:rank]
    keep = keep[values[keep] > 1e-10 * values[keep[0]]]
    return q @ vectors[:, keep]


def _normed(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)


@dataclass(frozen=True)
class Finder:
    """The retrieval of one block of items: passages, the vectors of terms in the latent space, and those of the passages."""

    known: Passages
    space: np.ndarray
    target: np.ndarray
    answers: list[frozenset]
    near: float = NEAR

    def of_texts(self, texts: list[str | None]) -> Iterator[tuple[int, int, int, float, float]]:
        """Place of the text, item, shared windows, best subsequence share and share of answers kept of each leak."""
        whole = [(i, *s) for i, t in enumerate(texts) if t for s in streams(t, self.known.worded < len(self.known.all))]
        for step in (WORDS, LETTERS):
            mine = [(i, units) for i, units, of in whole if of == step and len(units) >= step]
            if mine:
                yield from self._search(mine, step)

    def _search(self, mine: list[tuple[int, list[str] | str]], step: int) -> Iterator[tuple[int, int, int, float, float]]:
        first, last = (0, self.known.worded) if step == WORDS else (self.known.worded, len(self.known.all))
        if first == last:
            return
        # All terms of all texts in one array, each text padded to whole steps, so that a passage is two steps of it.
        get = self.known.terms.get
        ids, owner, start = [], [], []
        for k, (_, units) in enumerate(mine):
            row = [get(t, -1) for t in terms(units)]
            row += [-1] * (-len(row) % step)
            ids += row
            count = len(row) // step
            owner += [k] * count
            start += range(0, count * step, step)
        place = np.array(ids, dtype=np.int64).reshape(-1, step)
        owners, starts = np.array(owner), np.array(start)
        follows = np.append(owners[1:] == owners[:-1], False)
        held = (place >= 0).sum(axis=1)
        full = held + np.where(follows, np.append(held[1:], 0), 0)
        # A window of letters holds one pair less than letters.
        asked = np.flatnonzero(full >= (step if step == WORDS else step - 1))
        hits: dict[tuple[int, int], list] = {}
        for a in range(0, len(asked), BLOCK):
            part = asked[a : a + BLOCK]
            both = np.concatenate([place[part], np.where(follows[part][:, None], place[np.minimum(part + 1, len(place) - 1)], -1)], axis=1)
            # The last row of the space is zero and stands for unknown terms.
            vectors = _normed(self.space[both].sum(axis=1))
            rows, cols = np.nonzero(vectors @ self.target[first:last].T >= self.near)
            at = np.searchsorted(rows, np.arange(len(part) + 1))
            for r in np.flatnonzero(np.diff(at)).tolist():
                self._check(mine[owners[part[r]]], int(starts[part[r]]), (first + cols[at[r] : at[r + 1]]).tolist(), step, hits)
        for (text, item), (shared, share, kept) in hits.items():
            yield text, item, len(shared), share, kept

    def _check(self, text: tuple[int, list[str] | str], start: int, candidates: list[int], step: int, hits: dict) -> None:
        """Check the candidates of a document passage on their words; kept are windows that both sides hold and paraphrases."""
        no, units = text
        around = units[max(0, start - step) : start + 3 * step]
        there = frozenset(around)
        mine = None
        for c in candidates:
            passage = self.known.all[c]
            # Without a window's length in common there is neither a window nor a paraphrase; shared words bound that length.
            if len(there & passage.masks.keys()) + passage.repeats < step:
                continue
            size = len(passage.units)
            share = common_subsequence(passage.masks, size, around) / size
            if share * size < step:
                continue
            mine = windows(units[start : start + 2 * step], step) if mine is None else mine
            shared = passage.windows.intersection(mine)
            answers = self.answers[c]
            kept = sum(1 for t in answers if t in around) / len(answers) if answers else 0.0
            alike = share >= LIKE and kept >= ANSWERED if len(answers) > 1 else share >= LIKE_WITHOUT_ANSWERS and kept == len(answers)
            if shared or alike:
                old = hits.setdefault((no, passage.item), [set(), 0.0, 0.0])
                old[0] |= shared
                old[1], old[2] = max(old[1], share), max(old[2], kept)


def finder(documents: DataFrame, rows: list[tuple[int, str | None, str | None]], near: float = NEAR) -> Finder | None:
    """The retrieval for some items, with the document frequencies of `documents`; None if no item is long enough."""
    known = Passages(rows)
    if not known.all:
        return None
    total, counts = document_frequencies(documents, known)
    idf = np.array([np.log((1 + total) / (1 + counts.get(t, 0))) + 1 for t in known.terms])
    each = [terms(p.units) for p in known.all]
    table = documents.sparkSession.createDataFrame(pd.DataFrame({"terms": each}), "terms array<string>").repartition(max(1, min(64, len(each) // 2000)))
    space = latent_space(table, known.terms, idf)
    target = _normed(_times(*weigh(each, known.terms, idf), len(each), space)).astype(np.float32)
    held = Counter(t for item_terms in known.by_item().values() for t in item_terms)
    rare, own = max(1.0, RARE * total), max(2.0, OWN * len(rows))
    answers = [frozenset(t for t in terms(p.units) if t.isdigit() or counts.get(t, 0) <= rare and held[t] <= own) for p in known.all]
    weighted = np.concatenate([idf[:, None] * space, np.zeros((1, space.shape[1]))]).astype(np.float32)
    return Finder(known, weighted, target, answers, near)


def leaks(documents: DataFrame, items: DataFrame, near: float = NEAR) -> DataFrame:
    """doc_id, item_id, windows (distinct windows of the item that the document holds), share, answers and kind of each leak.

    kind is `verbatim` where a window is shared, else `paraphrase`. share is the largest part of an item passage that the
    document holds in order, answers the largest part of a passage's numbers and rare words.
    """
    schema = "doc_id bigint, item_id bigint, windows bigint, share double, answers double"
    blocks = max(1, -(-items.count() // ITEMS_AT_ONCE))
    found = []
    for k in range(blocks):
        block = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k)
        one = finder(documents, [tuple(r) for r in block.select("item_id", "lang", "passage").collect()], near)
        if one is not None:
            found.append(spread(documents.select("doc_id", "text"), "doc_id").mapInPandas(_search_with(one), schema))
    if not found:
        return documents.sparkSession.createDataFrame([], schema + ", kind string")
    every = reduce(DataFrame.unionByName, found).groupBy("doc_id", "item_id").agg(*[F.max(c).alias(c) for c in ("windows", "share", "answers")])
    return every.withColumn("kind", F.when(F.col("windows") > 0, "verbatim").otherwise("paraphrase"))


def _search_with(one: Finder):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = list(one.of_texts(list(batch["text"])))
            if rows:
                at, item, shared, share, kept = zip(*rows)
                yield pd.DataFrame({"doc_id": batch["doc_id"].to_numpy()[list(at)], "item_id": item, "windows": shared, "share": share, "answers": kept})

    return run
