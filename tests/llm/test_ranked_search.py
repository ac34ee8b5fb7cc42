import math
from collections import Counter

import brute
import numpy as np
import pytest
from quizlog.llm import ranked_search as R

ITEMS = [(1, "the river of stone"), (2, "nothing Évident here"), (3, None), (None, "der und mit haus"), (3, ""), (4, "THE the, The-river"),
         (5, "x"), (1, "the river of stone"), (6, "und und le et pas " * 30)]


def want(docs, items, k):
    terms = [(i, Counter(brute.ALNUM.findall(brute.lower(t or "")))) for i, t in docs]
    terms = [x for x in terms if x[1]]
    n_docs, total = len(terms), sum(sum(c.values()) for _, c in terms)
    df = Counter(w for _, c in terms for w in c)
    rows = []
    for item, text in items:
        scored = []
        for doc, c in terms:
            m = 100 - 50 + (50 * sum(c.values()) * n_docs) // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((10**9 * c[w]) // (1000 * c[w] + 20 * m))
                    for w in set(brute.ALNUM.findall(brute.lower(text or ""))) if w in c)
            if s > 0:
                scored.append((-s, doc is None, doc or 0, doc))
        for r, (s, _, _, doc) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1):
            rows.append((item, r, doc, -s))
    return sorted(rows, key=str)


@pytest.mark.parametrize("k, shard, block", [(50, 1 << 22, 1 << 18), (3, 40, 1 << 18), (5, 1, 6), (1, 400, 1 << 18)])
def test_against_brute_force(spark, corpus, k, shard, block):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = sorted(map(tuple, R.search(corpus, items, k=k, shard_postings=shard, block_words=block).collect()), key=str)
    assert got == want([(r["doc_id"], r["text"]) for r in corpus.collect()], ITEMS, k)


def test_nra_against_full_sums():
    r = np.random.default_rng(3)
    for trial in range(300):
        n, t, k = int(r.integers(1, 60)), int(r.integers(0, 6)), int(r.integers(1, 12))
        full, lists = np.zeros(n, np.int64), []
        for _ in range(t):
            docs = r.permutation(n)[: r.integers(0, n + 1)]
            c = -np.sort(-r.integers(1, 9 if trial % 2 else 10**9, docs.size))
            full[docs] += c
            lists.append((docs, c))
        ids = r.permutation(n)
        order = np.lexsort((ids, -full))
        order = order[full[order] > 0][:k]
        best, score = R.nra(lists, n, k, ids)
        assert best.tolist() == order.tolist() and score.tolist() == full[order].tolist()


def test_lists_are_read_no_further_than_needed():
    """A rare term settles the first place; the rest of a long list stays
    unread."""
    class Counted(np.ndarray):
        reads = 0

        def __getitem__(self, k):
            if isinstance(k, slice):
                Counted.reads = max(Counted.reads, k.stop)
            return np.asarray(super().__getitem__(k))

    many = np.arange(100_000)
    rare = (np.array([7]), np.array([10**9]))
    best, score = R.nra([rare, (many.view(Counted), many[::-1] + 1)], many.size, 1, many)
    assert best.tolist() == [7] and score.tolist() == [10**9 + 100_000 - 7]
    assert 7 < Counted.reads <= 50_001


def test_clashing_and_empty(spark, corpus, clashing, empty):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    extra = items.selectExpr("*", "1 AS doc_id", "2 AS _w", "3 AS score", "4 AS query")
    assert sorted(map(str, R.search(clashing, extra).collect())) == sorted(map(str, R.search(corpus, items).collect()))
    assert R.search(empty, items).count() == 0
    assert R.search(corpus, items.limit(0)).count() == 0
