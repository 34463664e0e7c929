"""Problem 8: texts of varying length combined into containers of a fixed capacity with as little unused space as possible.

Minimum bin slack. Each bin takes the longest text left and then the combination of the other lengths that fills it best,
found by a bounded subset-sum over a bitset; the combination is removed. The search runs over how many texts have each
length, not over the texts: a combination is used as often as the counts allow, so its cost depends on the capacity and
not on the number of texts. What reaches the driver is at most one count per length up to the capacity. Texts find their
bin by their rank among those of equal length, computed in parts so that a length held by a third of all texts is spread.

Defined results. Null texts are not packed. Empty texts have no tokens and go into bin 0. A text longer than the capacity
is cut into pieces of the capacity and a rest, and only such a text is. Ties are broken by doc_id; repeated texts are each
packed. An empty table gives no rows.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelforge.session import cut, spread

#: Ranks to the tokenizer's vocabulary, one `base64 rank` a line; a path that every executor can read.
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: the split pattern that belongs to the vocabulary.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Parts into which the texts of one length are divided for ranking.
PARTS = 128


def token_counts(documents: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id and tokens of each non-null text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import tiktoken

        with open(vocabulary, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        coder = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "tokens": [len(coder.encode_ordinary(t)) for t in batch["text"]]})

    return spread(documents.where("text IS NOT NULL").select("doc_id", "text"), "doc_id").mapInPandas(run, "doc_id bigint, tokens bigint")


def pieces(counts: DataFrame, capacity: int) -> DataFrame:
    """doc_id, piece_no, first_token and tokens: whole texts, or the pieces of those beyond the capacity."""
    c = F.lit(capacity)
    n = F.greatest(F.ceil(F.col("tokens") / c), F.lit(1)).cast("int")
    each = counts.select("doc_id", "tokens", F.explode(F.sequence(F.lit(0), n - 1)).alias("piece_no"))
    first = F.col("piece_no").cast("bigint") * c
    return each.select("doc_id", "piece_no", first.alias("first_token"), F.least(F.col("tokens") - first, c).alias("tokens"))


def fullest(left: dict[int, int], lengths: list[int], room: int) -> dict[int, int]:
    """How many of each length fill `room` best without exceeding it; `lengths` descending, those with any left."""
    reach, full = 1, (1 << (room + 1)) - 1
    steps: list[tuple[int, int, int]] = []
    goal = 1 << room
    for size in lengths:
        if size > room:
            continue
        most, bundle = min(left[size], room // size), 1
        while most > 0 and not reach & goal:
            take = min(bundle, most)
            grown = (reach | reach << (size * take)) & full
            if grown != reach:
                steps.append((size, take, reach))
                reach = grown
            most -= take
            bundle *= 2
        if reach & goal:
            break
    at = reach.bit_length() - 1
    used: dict[int, int] = {}
    for size, take, before in reversed(steps):
        # A sum that was reachable before this bundle doesn't need it.
        if not before >> at & 1:
            used[size] = used.get(size, 0) + take
            at -= size * take
    return used


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, dict[int, int]]]:
    """(first bin, number of bins, texts of each length per bin) of all bins, in the order in which they were filled."""
    left = {s: n for s, n in counts.items() if s > 0 and n > 0}
    out, bin_no = [], 0
    lengths = sorted(left, reverse=True)
    while lengths:
        top = lengths[0]
        left[top] -= 1
        mix = fullest(left, lengths if left[top] else lengths[1:], capacity - top)
        left[top] += 1
        mix[top] = mix.get(top, 0) + 1
        times = min(left[s] // n for s, n in mix.items())
        out.append((bin_no, times, mix))
        bin_no += times
        for s, n in mix.items():
            left[s] -= n * times
        lengths = [s for s in lengths if left[s] > 0]
    return out


def _slots(bins: list[tuple[int, int, dict[int, int]]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per length and stretch of ranks: a sortable key, the first rank, how many a bin takes, and the first bin."""
    seen: dict[int, int] = {}
    rows = []
    for first, times, mix in bins:
        for size, n in mix.items():
            start = seen.get(size, 0)
            rows.append(((size << 44) + start, start, n, first))
            seen[size] = start + n * times
    rows.sort()
    table = np.array(rows, dtype=np.int64).reshape(-1, 4)
    return table[:, 0], table[:, 1], table[:, 2], table[:, 3]


def pack_counts(counts: DataFrame, capacity: int, parts: int = PARTS) -> DataFrame:
    """doc_id, piece_no, first_token, tokens and bin_id of every piece; counts holds doc_id and tokens."""
    items = pieces(counts, capacity).withColumn("part", F.pmod(F.xxhash64("doc_id", "piece_no"), F.lit(parts)).cast("int"))
    # One row per length and part; lengths are bounded by the capacity.
    by_part = cut(items.groupBy("tokens", "part").agg(F.count("*").alias("n")))
    histogram = {r["tokens"]: r["n"] for r in by_part.groupBy("tokens").agg(F.sum("n").alias("n")).collect()}
    keys, starts, each, firsts = _slots(plan(histogram, capacity))
    order = Window.partitionBy("tokens").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = by_part.select("tokens", "part", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("tokens", "part").orderBy("doc_id", "piece_no")) - 1
    ranked = items.withColumn("within", within).join(before, ["tokens", "part"]).select("doc_id", "piece_no", "first_token", "tokens", (F.col("before") + F.col("within")).alias("rank"))

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            size, rank = batch["tokens"].to_numpy(np.int64), batch["rank"].to_numpy(np.int64)
            bins = np.zeros(len(batch), dtype=np.int64)
            some = size > 0
            if some.any():
                k = np.searchsorted(keys, (size[some] << 44) + rank[some], side="right") - 1
                bins[some] = firsts[k] + (rank[some] - starts[k]) // each[k]
            yield batch.drop(columns="rank").assign(bin_id=bins)

    return ranked.mapInPandas(assign, "doc_id bigint, piece_no int, first_token bigint, tokens bigint, bin_id bigint")


def pack(documents: DataFrame, capacity: int, vocabulary: str = VOCABULARY) -> DataFrame:
    """Every text of documents in a bin of the given capacity."""
    return pack_counts(cut(token_counts(documents, vocabulary)), capacity)


def slack(packed: DataFrame, capacity: int) -> DataFrame:
    """bins, tokens, the least number of bins that could hold them, and the share of space left unused."""
    sums = packed.where("tokens > 0").agg(F.countDistinct("bin_id").alias("bins"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"))
    return sums.select("bins", "tokens", F.ceil(F.col("tokens") / capacity).cast("bigint").alias("least_bins"), F.when(F.col("bins") > 0, 1 - F.col("tokens") / (F.col("bins") * capacity)).alias("unused"))
