"""Evaluation passages in training text: suffix arrays over shards of the corpus, searched by every test suffix.

A task cuts its documents into shards of about ``shard_words`` words (a document is never cut), keeps of each the runs of
at least ``min_run`` words that all occur in some test item, and sorts the suffixes of these runs. Every suffix of every
test item is then found by binary search, all at once; neighbours that share ``min_run`` words are verbatim matches, and
matches that go on diagonally give the longest ones. Nothing is shuffled: a document's matches lie in its own shard.

Test items go to the tasks in blocks of at most ``block_words`` words, so what is broadcast is bounded however large the
test collection grows; each block reads the corpus once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

WORD = re.compile(r"[^\W_]+")
MATCHES = "doc_id BIGINT, item_id BIGINT, covered INT, item_words INT, longest INT, doc_word INT, item_word INT"


def words(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def suffix_array(ids: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``ids`` in the order of their suffixes' first ``depth`` values (at least), by prefix doubling."""
    rank = np.unique(ids, return_inverse=True)[1].astype(np.int64) + 1
    order, h = np.argsort(rank, kind="stable"), 1
    while h < depth:
        after = np.zeros_like(rank)
        after[:-h] = rank[h:]
        key = rank * (len(ids) + 2) + after
        order = np.argsort(key, kind="stable")
        new = np.empty_like(rank)
        new[order] = np.concatenate(([1], 1 + np.cumsum(np.diff(key[order]) > 0)))
        rank, h = new, 2 * h
        if rank.max() == len(rank):
            break
    return order


def _bounds(shard: np.ndarray, order: np.ndarray, test: np.ndarray, at: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """For each test suffix the range of ``order`` whose suffixes begin with its first ``depth`` words."""
    want = test[at[:, None] + np.arange(depth)]
    padded = np.concatenate((shard, np.zeros(depth, shard.dtype)))

    def search(upper: bool) -> np.ndarray:
        lo, hi = np.zeros(len(at), np.int64), np.full(len(at), len(order), np.int64)
        while (busy := lo < hi).any():
            mid = (lo + hi) // 2
            have = padded[order[np.minimum(mid, len(order) - 1)][:, None] + np.arange(depth)]
            differ = have != want
            first = np.where(differ.any(1), differ.argmax(1), depth - 1)
            row = np.arange(len(at))
            less = have[row, first] < want[row, first]
            right = busy & (less | (upper & ~differ.any(1)))
            lo, hi = np.where(right, mid + 1, lo), np.where(busy & ~right, mid, hi)
        return lo

    return search(False), search(True)


class Tests:
    """The words of a block of test items as one array of ids; 0 ends an item."""

    def __init__(self, items: list[tuple[int, str]], min_run: int) -> None:
        self.vocabulary: dict[str, int] = {}
        ids: list[int] = []
        owner, place, sizes, self.names = [], [], [], []
        for name, text in items:
            w = words(text)
            for i, x in enumerate(w):
                ids.append(self.vocabulary.setdefault(x, len(self.vocabulary) + 1))
                owner.append(len(sizes))
                place.append(i)
            ids.append(0)
            owner.append(len(sizes))
            place.append(len(w))
            sizes.append(len(w))
            self.names.append(name)
        self.ids = np.array([*ids, *[0] * min_run], np.int32)
        self.owner, self.place, self.sizes = np.array(owner, np.int64), np.array(place, np.int64), np.array(sizes, np.int64)
        self.starts = np.flatnonzero(self.place + min_run <= self.sizes[self.owner]) if sizes else np.zeros(0, np.int64)


def _shard_matches(docs: list[tuple], tests: Tests, min_run: int, at_once: int = 2_000_000) -> Iterator[list[tuple]]:
    """(doc_id, item_id, covered, item_words, longest, doc_word, item_word) of each document and item that share a run, for some
    items at a time: about ``at_once`` matching places, or one item's."""
    ids = np.concatenate([np.append(d, 0) for _, d in docs])
    doc_of = np.repeat(np.arange(len(docs)), [len(d) + 1 for _, d in docs])
    start_of = np.concatenate(([0], np.cumsum([len(d) + 1 for _, d in docs])))
    # Runs of words that all occur in test items, each with the 0 that ends it.
    gap = np.flatnonzero(ids == 0)
    length = np.diff(np.concatenate(([-1], gap)))
    keep = np.repeat(length > min_run, length)
    kept = np.flatnonzero(keep)
    if not len(kept) or not len(tests.starts):
        return
    shard = ids[kept]
    order = suffix_array(shard, min_run)
    lo, hi = _bounds(shard, order, tests.ids, tests.starts, min_run)
    # An item's suffixes follow each other and stay together.
    ends = np.flatnonzero(np.append(np.diff(tests.owner[tests.starts]) != 0, True)) + 1
    upto = np.concatenate(([0], np.cumsum(hi - lo)))[ends]
    a, done = 0, 0
    while a < len(ends):
        b = max(a + 1, int(np.searchsorted(upto, done + at_once, side="right")))
        part = slice(ends[a - 1] if a else 0, ends[b - 1])
        suffix = np.repeat(tests.starts[part], (hi - lo)[part])
        if len(suffix):
            yield _pairs_of(docs, tests, min_run, suffix, lo[part], hi[part], kept[order], doc_of, start_of)
        a, done = b, int(upto[b - 1])


def _pairs_of(docs: list[tuple], tests: Tests, min_run: int, suffix: np.ndarray, lo: np.ndarray, hi: np.ndarray, places: np.ndarray, doc_of: np.ndarray, start_of: np.ndarray) -> list[tuple]:
    """The rows of the places ``places[lo:hi]`` that each test suffix matches."""
    n = hi - lo
    where = places[np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
    item, doc = tests.owner[suffix], doc_of[where]
    # Covered words: the union of the matched windows of one document and item.
    pair = doc * len(tests.sizes) + item
    by = np.lexsort((tests.place[suffix], pair))
    p, k = pair[by], tests.place[suffix][by]
    new = np.append(True, p[1:] != p[:-1])
    step = np.where(new, min_run, np.minimum(min_run, np.diff(k, prepend=0)))
    first = np.flatnonzero(new)
    covered = np.add.reduceat(step, first)
    # Longest match: windows that follow each other on one diagonal.
    diagonal = where - suffix
    at = np.lexsort((suffix, diagonal, pair))
    q, d, s = pair[at], diagonal[at], suffix[at]
    head = np.append(True, (q[1:] != q[:-1]) | (d[1:] != d[:-1]) | (s[1:] != s[:-1] + 1))
    heads = np.flatnonzero(head)
    run = np.diff(np.append(heads, len(at))) + min_run - 1
    best = np.lexsort((-run, q[heads]))
    best = best[np.append(True, q[heads][best][1:] != q[heads][best][:-1])]
    out = []
    for i, b in enumerate(best):
        g, t = divmod(int(p[first[i]]), len(tests.sizes))
        j = heads[b]
        out.append((docs[g][0], tests.names[t], int(covered[i]), int(tests.sizes[t]), int(run[b]), int(where[at[j]] - start_of[g]), int(tests.place[s[j]])))
    return out


def matches(documents: DataFrame, items: DataFrame, min_run: int = 12, shard_words: int = 500_000, block_words: int = 2_000_000) -> DataFrame:
    """One row per document and test item that share at least ``min_run`` consecutive words: words of the item covered by
    such runs, the item's words, the longest match and where it begins in both (0-based words; ties: the first).

    ``documents`` has doc_id and text, ``items`` item_id and text. Null and empty texts and items shorter than
    ``min_run`` words match nothing. Items repeating an id are separate passages with a row each.
    """
    spark = documents.sparkSession
    sized = items.where("text is not null").select("item_id", "text")
    total = sized.agg(F.sum(F.size(F.split("text", " ")))).first()[0] or 0
    blocks = 1 + total // block_words
    out = None
    for b in range(blocks):
        block = [(r["item_id"], r["text"]) for r in sized.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()]
        tests = spark.sparkContext.broadcast(Tests(sorted(block, key=str), min_run))

        def search(batches: Iterator[pd.DataFrame], tests=tests) -> Iterator[pd.DataFrame]:
            names = [c.split()[0] for c in MATCHES.split(", ")]
            known, docs, size = tests.value.vocabulary, [], 0
            for batch in batches:
                for doc, text in zip(batch["doc_id"], batch["text"]):
                    ids = np.array([known.get(w, 0) for w in words(text)], np.int32)
                    if len(ids) >= min_run:
                        docs.append((doc, ids))
                        size += len(ids)
                    if size >= shard_words:
                        for rows in _shard_matches(docs, tests.value, min_run):
                            yield pd.DataFrame(rows, columns=names)
                        docs, size = [], 0
            if docs:
                for rows in _shard_matches(docs, tests.value, min_run):
                    yield pd.DataFrame(rows, columns=names)

        part = documents.select("doc_id", "text").mapInPandas(search, MATCHES)
        out = part if out is None else out.unionByName(part)
    return out


def found(documents: DataFrame, items: DataFrame, min_run: int = 12, share: float = 0.5) -> DataFrame:
    """Documents and the items of which runs of ``min_run`` words cover at least ``share``."""
    hit = matches(documents, items, min_run).where(F.col("covered") >= share * F.col("item_words"))
    return hit.select("doc_id", "item_id").distinct()


def without_leaks(documents: DataFrame, items: DataFrame, min_run: int = 12, share: float = 0.5) -> DataFrame:
    """``documents`` without those that hold a leaked item; rows with a null doc_id stay."""
    leaked = found(documents, items, min_run, share).select("doc_id").where("doc_id is not null").distinct()
    return documents.join(leaked, "doc_id", "left_anti")


def oracle_sql(min_run: int = 12) -> str:
    """The same pairs by joining all windows of ``min_run`` words."""
    tokens = "regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')"
    window = f"array_to_string(list_slice(w, k, k + {min_run - 1}), ' ')"
    return f"""WITH e AS (SELECT item_id, {tokens} AS w FROM eval_items),
  ek AS (SELECT item_id, w, unnest(range(1, len(w) - {min_run - 2})) AS k FROM e WHERE len(w) >= {min_run}),
  eg AS (SELECT item_id, k, len(w) AS n, {window} AS g FROM ek),
  d AS (SELECT doc_id, {tokens} AS w FROM documents),
  dk AS (SELECT doc_id, w, unnest(range(1, len(w) - {min_run - 2})) AS k FROM d WHERE len(w) >= {min_run}),
  dg AS (SELECT DISTINCT doc_id, {window} AS g FROM dk),
  m AS (SELECT DISTINCT doc_id, item_id, n, unnest(range(k, k + {min_run})) AS place FROM dg JOIN eg USING (g))
SELECT doc_id, item_id FROM m GROUP BY doc_id, item_id, n HAVING count(DISTINCT place) >= 0.5 * n"""
