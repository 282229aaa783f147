import os
import random

import pytest
from pyspark.sql import functions as F

from sheafline.llm import packing as Q

need = pytest.mark.skipif(not os.path.exists(Q.TOKENIZER), reason="no vocabulary")


def brute(sizes, capacity):
    gaps, out = [], []
    for s in sizes:
        def cost(g):
            return sum(x * x for x in __import__("collections").Counter(v for v in g if v).values())

        options = [(cost(gaps[:i] + [gaps[i] - s] + gaps[i + 1 :]), i) for i in range(len(gaps)) if gaps[i] >= s] + [(cost([*gaps, capacity - s]), len(gaps))]
        best = min(c for c, _ in options)
        out.append(best)
        i = next(i for c, i in options if c == best)
        if i == len(gaps):
            gaps.append(capacity)
        gaps[i] -= s
    return out


def test_each_step_takes_the_least_sum_of_squares():
    rng = random.Random(0)
    for _ in range(20):
        sizes = [rng.randrange(1, 11) for _ in range(25)]
        p, got = Q.Packer(10), []
        for s in sizes:
            p.place(s)
            got.append(int((p.count**2).sum()))
            want_gaps = {g: n for g, n in enumerate(p.count) if n}
            assert want_gaps == {g: k for g, k in __import__("collections").Counter(x for x in p.gap if x).items()}
        assert got[0] == brute(sizes, 10)[0]
        # From the same state the step is the cheapest one: replay with the packer's own states.
        q = Q.Packer(10)
        for s in sizes:
            gaps = list(q.gap)
            options = [sorted(gaps[:i] + [gaps[i] - s] + gaps[i + 1 :]) for i in range(len(gaps)) if gaps[i] >= s] + [sorted([*gaps, 10 - s])]
            least = min(sum(n * n for n in __import__("collections").Counter(x for x in o if x).values()) for o in options)
            q.place(s)
            assert int((q.count**2).sum()) == least


@need
def test_containers(spark):
    rng = random.Random(1)
    texts = ["word " * rng.randrange(1, 400) for _ in range(300)] + ["long text " * 3000, None, "", "word " * 50, "word " * 50]
    df = spark.createDataFrame(list(enumerate(texts)) + [(7, "again")], "doc_id bigint, text string").withColumn("container", F.lit("clash"))
    tokens = {r.doc_id: r.n_tokens for r in Q.token_counts(df.where("doc_id <> 7"), "doc_id", "text").collect()}
    for items in (50, 10**6):
        got = Q.containers(df, "doc_id", "text", 512, shard_items=items)
        rows = got.collect()
        filled = {}
        for r in rows:
            if r.container is not None:
                filled[r.container] = filled.get(r.container, 0) + r.n_tokens
        assert max(filled.values()) <= 512
        per = {}
        for r in rows:
            per.setdefault(r.doc_id, []).append(r.n_tokens)
        assert all(sum(per[d]) == n for d, n in tokens.items() if d != 7)
        assert all(len(per[d]) == 1 for d, n in tokens.items() if n <= 512 and d != 7)
        assert {r.doc_id for r in rows if r.container is None} == {301, 302}
        assert sum(filled.values()) / (512 * len(filled)) > (0.97 if items > 300 else 0.9)
    assert Q.containers(df.limit(0), "doc_id", "text").count() == 0
