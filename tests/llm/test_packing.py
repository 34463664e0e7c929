import itertools
import random

from panelforge.llm import packing


def test_fullest_against_all_subsets():
    r = random.Random(2)
    for _ in range(200):
        left = {s: r.randrange(1, 4) for s in r.sample(range(1, 25), r.randrange(1, 6))}
        room = r.randrange(0, 60)
        best = max(t for t in (sum(s * n for s, n in zip(left, ns)) for ns in itertools.product(*[range(n + 1) for n in left.values()])) if t <= room)
        used = packing.fullest(left, sorted(left, reverse=True), room)
        assert sum(s * n for s, n in used.items()) == best
        assert all(n <= left[s] for s, n in used.items())


def test_plan_places_everything_once():
    r = random.Random(5)
    counts = {r.randrange(1, 300): r.randrange(1, 2000) for _ in range(90)}
    counts[37] = 1_000_000  # a third of all and more
    bins = packing.plan(counts, 300)
    placed = {}
    for first, times, mix in bins:
        assert times >= 1 and sum(s * n for s, n in mix.items()) <= 300
        for s, n in mix.items():
            placed[s] = placed.get(s, 0) + n * times
    assert placed == counts
    number = sum(t for _, t, _ in bins)
    assert [f for f, _, _ in bins] == list(itertools.accumulate([0, *[t for _, t, _ in bins][:-1]]))
    # 8 times 37 leave 4 of 300 unused, whatever fills the other bins
    assert number <= 1.015 * sum(s * n for s, n in counts.items()) / 300 + 1
    assert packing.plan({}, 10) == [] and packing.plan({0: 5}, 10) == []


def test_rows_pieces_empty_texts_and_ties(spark):
    r = random.Random(1)
    sizes = [r.choice([0, 3, 5, 7, 7, 7, 11, 64, 65, 200]) for _ in range(500)]
    counts = spark.createDataFrame(list(enumerate(sizes)), "doc_id bigint, tokens bigint")
    got = packing.pack_counts(counts, 64, parts=5).collect()
    by_doc, load = {}, {}
    for x in got:
        by_doc.setdefault(x["doc_id"], []).append(x)
        load[x["bin_id"]] = load.get(x["bin_id"], 0) + x["tokens"]
    assert max(load.values()) <= 64
    for doc, size in enumerate(sizes):
        parts = sorted(by_doc[doc], key=lambda x: x["piece_no"])
        assert sum(p["tokens"] for p in parts) == size and len(parts) == max(1, -(-size // 64))
        assert [p["first_token"] for p in parts] == [64 * k for k in range(len(parts))]
    assert len(load) <= -(-sum(sizes) // 64) + 1
    again = packing.pack_counts(counts.repartition(7), 64, parts=5).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))
    assert packing.pack_counts(counts.limit(0), 64).count() == 0


def test_whole_texts_are_counted(spark):
    docs = spark.createDataFrame([(1, "One two three.", "x"), (2, None, "x"), (3, "", "x"), (4, "语" * 3000, "x"), (5, "word " * 20000, "x")], "doc_id bigint, text string, tokens string")
    got = {r["doc_id"]: r["tokens"] for r in packing.token_counts(docs).collect()}
    assert got.keys() == {1, 3, 4, 5} and got[3] == 0 and got[1] == 4 and got[5] >= 20000 and got[4] > 1000
    stats = packing.slack(packing.pack(docs, 512), 512).collect()[0]
    assert stats["bins"] == stats["least_bins"] and stats["tokens"] == sum(got.values())
