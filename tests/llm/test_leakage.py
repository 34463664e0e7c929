import random

from panelforge.llm import leakage

LATIN = "Old Ostkezwex clocks strike 986 times when Zorbolhib sends mail, a habit that Dappashtez mocked and Umbyedgol later copied."
OTHER = "Old Golkezwex clocks strike 12 times when Fenbolhib sends mail, a habit that Rukpashtez mocked and Vimyedgol later copied."
CHINESE = "每位珩棹汐的教师都听说砚茗岚有759口井，可是翊珏渚的地图和槿岚霁的记录并不相同。"


def brute(docs, items):
    out = set()
    for d, text in docs:
        words = leakage.tokens(text or "")
        flat = "".join(words)
        for i, lang, passage in items:
            own = leakage.tokens(passage or "")
            if leakage._is_wide(lang, passage or ""):
                whole = "".join(own)
                hit = any(whole[k : k + 20] in flat for k in range(len(whole) - 19))
            else:
                hit = any(words[k : k + 10] == own[j : j + 10] for j in range(len(own) - 9) for k in range(len(words) - 9))
            if hit:
                out.add((d, i))
    return out


def frames(spark, docs, items):
    a = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], "doc_id bigint, text string, key string, n int")
    b = spark.createDataFrame([(*i, "x") for i in items], "item_id bigint, lang string, passage string, key string")
    return a, b


def run(spark, docs, items, kind="verbatim", near=leakage.NEAR):
    got = leakage.leaks(*frames(spark, docs, items), near=near).collect()
    assert len({(r["doc_id"], r["item_id"]) for r in got}) == len(got)
    return {(r["doc_id"], r["item_id"]) for r in got if r["kind"] == kind}


def test_forms_that_do_not_count_and_near_misses(spark):
    words = LATIN.split()
    items = [(1, "en", LATIN), (2, "en", OTHER), (3, "zh", CHINESE), (4, "en", LATIN), (5, "en", "too short"), (6, "en", None)]
    docs = [
        (1, LATIN.upper()), (2, "x " + " \r\n".join(words[2:12]) + " y"), (3, " ".join(words[2:11])), (4, "​".join(LATIN)), (5, LATIN.replace("habit", "ha­bit").replace(",", " --")), (6, None), (7, ""), (8, CHINESE[3:24]),
        (9, CHINESE[3:22]), (10, CHINESE[2:12] + " ，\n" + CHINESE[12:30]), (11, " ".join(words[:6] + ["zebra"] + words[6:13] + ["zebra"] + words[13:])), (12, "ＯＬＤ" + LATIN[3:]), (13, "filler words. " * 3000 + LATIN), (14, " ".join(words[8:18]) + " mocked"), (15, LATIN + OTHER),
    ]
    got = run(spark, docs, items)
    assert got == brute(docs, items)
    assert {d for d, _ in got} == {1, 2, 4, 5, 8, 10, 12, 13, 14, 15}


def test_random_texts_against_brute_force(spark):
    r = random.Random(8)
    vocabulary = [f"w{k}" for k in range(12)]
    say = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    items = [(k, "en", say(r.randrange(8, 30))) for k in range(25)]
    docs = []
    for k in range(60):
        p = r.choice(items)[2].split()
        a = r.randrange(len(p))
        docs.append((k, say(r.randrange(30)) + " " + " ".join(p[a : a + r.randrange(7, 14)]) + " " + say(r.randrange(30))))
    docs += [(100 + k, docs[0][1]) for k in range(30)]  # copies of one text
    assert run(spark, docs, items) == brute(docs, items)


def test_empty_tables(spark):
    assert run(spark, [], [(1, "en", LATIN)]) == set()
    assert run(spark, [(1, LATIN)], []) == set()


def varied(words, every, r):
    """The words with one in `every` replaced."""
    return " ".join(r.choice(["perhaps", "often", "then"]) if k % every == every // 2 else w for k, w in enumerate(words))


def test_paraphrases_are_found_and_only_by_retrieval(spark):
    r = random.Random(3)
    name = lambda: "".join(r.choice(["gol", "mir", "tez", "plo", "dru", "vex"]) for _ in range(4)) + str(r.randrange(10**6))
    put = lambda: f"The clerks of {name()} counted {r.randrange(1000)} sealed columns and carried them to {name()} before {name()} closed its gates and billed the millers of {name()} for rope"
    items = [(k, "en", put()) for k in range(40)]
    filler = "Ports and roads and wells were counted again by the desk in that year without any note. "
    docs = [(k, filler * 3 + varied(items[k][2].split(), 9, r) + ". " + filler) for k in range(40)]
    docs += [(100 + k, filler + put() + ". " + filler) for k in range(40)]  # put alike, but about other places
    pairs = run(spark, docs, items, "paraphrase") | run(spark, docs, items)
    assert sum((k, k) in pairs for k in range(40)) >= 36, "recall of planted paraphrases of at least 0.9"
    assert not [p for p in pairs if p[0] >= 100 or p[0] != p[1]]
    assert brute(docs, items) == run(spark, docs, items) and not brute(docs, items)
    # Without candidates nothing is found, word for word or not.
    assert run(spark, [*docs, (500, items[0][2])], items, "paraphrase", near=1.1) == run(spark, [(500, items[0][2])], items, near=1.1) == set()


def test_common_subsequence_is_that_of_the_table():
    r = random.Random(1)
    for _ in range(200):
        a, b = ([r.choice("abcd") for _ in range(r.randrange(1, 25))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert leakage.common_subsequence(leakage.Passages._passage(1, a, 10).masks, len(a), b) == table[-1][-1]


def test_items_beyond_one_block(spark, monkeypatch):
    monkeypatch.setattr(leakage, "ITEMS_AT_ONCE", 2)
    items = [(k, "en", LATIN if k % 2 else OTHER) for k in range(7)]
    docs = [(1, LATIN), (2, OTHER), (3, "nothing here")]
    assert run(spark, docs, items) == brute(docs, items)


def test_latent_space_is_that_of_the_matrix(spark):
    import numpy as np

    known = leakage.Passages([(k, "en", " ".join(f"t{(k * 7 + j * j) % 23}" for j in range(25))) for k in range(12)])
    each = [leakage.terms(p.units) for p in known.all]
    idf = np.ones(len(known.terms))
    table = spark.createDataFrame([(t,) for t in each], "terms array<string>").repartition(3)
    space = leakage.latent_space(table, known.terms, idf, rank=5)
    dense = np.zeros((len(each), len(known.terms)))
    rows, cols, vals = leakage.weigh(each, known.terms, idf)
    dense[rows, cols] = vals
    values = np.linalg.svd(dense, compute_uv=False)[:5]
    assert np.allclose(np.linalg.norm(dense @ space, axis=0), values, rtol=0.02)
    assert np.allclose(space.T @ space, np.eye(5), atol=1e-8)
