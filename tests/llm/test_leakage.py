import random

import numpy as np

from sheafline.llm import leakage as Q


def brute(docs, items, run, share):
    out = set()
    for d, text in docs:
        w = Q.words(text)
        grams = {tuple(w[i : i + run]) for i in range(len(w) - run + 1)}
        for n, item in items:
            v = Q.words(item)
            hit = {j for i in range(len(v) - run + 1) if tuple(v[i : i + run]) in grams for j in range(i, i + run)}
            if v and len(hit) >= share * len(v) and hit:
                out.add((d, n))
    return out


def test_suffix_array_orders_suffixes():
    rng = np.random.default_rng(0)
    for _ in range(20):
        ids = rng.integers(0, 3, rng.integers(1, 60))
        order = Q.suffix_array(ids, 64)
        suffixes = [tuple(ids[i:]) for i in order]
        assert suffixes == sorted(suffixes)


def test_equals_brute_force(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(12)]
    items = [(n, " ".join(rng.choices(vocabulary, k=rng.randrange(3, 30)))) for n in range(12)] + [(99, None), (98, ""), (3, "w1 w2")]
    docs = []
    for d in range(60):
        t = rng.choices([*vocabulary, "x", "y."], k=rng.randrange(0, 40))
        if d % 3 == 0:
            v = (items[rng.randrange(12)][1]).split()
            a = rng.randrange(len(v))
            t[5:5] = v[a : a + rng.randrange(1, 30)]
        docs.append((d, " ".join(t)))
    docs += [(200, None), (201, ""), (202, items[0][1] + " " + items[0][1])]
    df, it = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    want = brute(docs, [i for i in items if i[1]], 4, 0.5)
    for shard, block in ((10**6, 10**6), (30, 40)):
        got = Q.matches(df, it, 4, shard, block).where("covered >= 0.5 * item_words").select("doc_id", "item_id").distinct()
        assert {tuple(r) for r in got.collect()} == want
    best = Q.matches(df.where("doc_id = 202"), it.where("item_id = 0"), 4).first()
    assert (best.longest, best.doc_word, best.item_word, best.covered) == (best.item_words, 0, 0, best.item_words)
    assert Q.found(df, it.limit(0)).count() == 0 and Q.found(df.limit(0), it).count() == 0
    assert Q.without_leaks(df, it, 4).where("doc_id = 202").count() == 0


def test_items_in_parts_give_the_same():
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(6)]
    tests = Q.Tests([(n, " ".join(rng.choices(vocabulary, k=rng.randrange(3, 20)))) for n in range(15)], 3)
    docs = [(d, np.array([tests.vocabulary.get(w, 0) for w in rng.choices(vocabulary, k=25)], np.int32)) for d in range(10)]
    whole = sorted(r for part in Q._shard_matches(docs, tests, 3) for r in part)
    parts = list(Q._shard_matches(docs, tests, 3, at_once=1))
    assert whole and len(parts) > 5 and sorted(r for part in parts for r in part) == whole
