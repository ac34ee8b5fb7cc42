import random
import re

import numpy as np
import pyarrow as pa
import pytest

import brute
from quizlog.llm import decontaminate as D


def overlap(equal, identity):
    """(start, end, matches) of the longest stretch, the first of equal ones."""
    best = (0, 0, 0)
    for j in range(len(equal)):
        for i in range(j + 1):
            same = sum(equal[i : j + 1])
            if equal[i] and equal[j] and same >= identity * (j - i + 1) - 1e-9 and j + 1 - i > best[1] - best[0]:
                best = (i, j + 1, int(same))
    return best


def test_longest_against_brute_force():
    r = random.Random(5)
    for identity in (0.8, 1.0):
        equal = np.array([[r.random() < p for _ in range(25)] for p in (r.choice([0, 0.3, 0.8, 0.95, 1]) for _ in range(300))])
        a, z = D.longest(equal, np.full(300, identity))
        for row, i, j in zip(equal, a, z):
            assert (i, j) == overlap(row.tolist(), identity)[:2]


UNSPACED = "[" + "".join(f"{chr(a)}-{chr(z)}" for a, z in D.UNSPACED_CHARS) + "]"
WORD = re.compile(UNSPACED + "|(?:(?!" + UNSPACED + ")[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F])+")


def split(text):
    return WORD.findall(brute.lower(text or ""))


def test_words_of_scripts_without_spaces():
    texts = ["", None, "ab\u4e2d\u6587cd \u0e01\u0e02 x", "\u3042", "\u4e2d", "\u4e2d\u6587", "caf\u00e9 \U00020001\U0001f600z", "\u10d0\u1000\ud55c\uae00 \uf900!"]
    w = D.words(pa.array(texts, pa.string()))
    got = [[bytes(w.data[w.start[k] : w.end[k]]).decode() for k in range(a, z)] for a, z in zip(w.first[:-1], w.first[1:])]
    assert got == [split(t) for t in texts]


def test_masks_meet_in_every_pattern():
    """Any 10 to 19 words with 80 % equal ones, so any longer stretch too
    (cut into such parts, one part keeps the share); and whole short items."""
    from itertools import combinations
    from math import ceil

    masks = [(int(m[::-1], 2), len(m)) for m in D.MASKS]
    for size in range(D.MIN_ITEM_WORDS, 20):
        inner = range(1, size - 1) if size < 10 else range(size)  # an overlap starts and ends equal
        for other in combinations(inner, size - ceil(0.8 * size - 1e-9)):
            differ = sum(1 << i for i in other)
            assert any(not (m << p) & differ for m, span in masks for p in range(size - span + 1))


@pytest.fixture(scope="module")
def tables(spark):
    r = random.Random(9)
    vocab = [f"w{k}" for k in range(300)]
    common = ["the", "of", "and", "to"]
    text = lambda n: " ".join(r.choice(vocab + common * 60) for _ in range(n))
    items = [(k, text(r.randint(15, 50))) for k in range(30)] + [(30, "too short an item"), (31, None), (33, ""), (34, "\u4ec0\u4e48\u662f\u673a\u5668\u5b66\u4e60\u7684\u57fa\u672c\u6982\u5ff5\u548c\u65b9\u6cd5\u5462\u8bf7\u95ee"), (35, "who wrote the old green book first"), (36, "yes"), (None, text(25))]
    docs = []
    for k in range(30):
        words = items[k][1].split()
        docs.append((k, text(40) + " " + " ".join(words) + " " + text(30)))  # whole
        changed = [w if i % 6 != 3 else "zz" for i, w in enumerate(words)]
        docs.append((100 + k, text(10).upper() + ", " + " -- ".join(changed).upper() + "\n" + text(5)))  # one in six replaced
        docs.append((200 + k, text(200)))  # clean
        docs.append((300 + k, " ".join(words[:6]) + " " + text(60)))  # too little
    docs += [(400, None), (401, ""), (None, items[3][1]), (402, items[-1][1]), (0, docs[0][1]), (403, text(20000) + " " + items[5][1]),
             (404, text(9) + ". Who wrote the OLD green book first? Yes!"), (405, "who wrote the old green novel first"),
             (406, "\u95ee\uff1a" + items[33][1] + "\u7b54"), (407, text(5) + " " + items[4][1] + " " + items[4][1])]
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), docs, items


def want_pairs(docs, items):
    """The best of all alignments, whether a seed hits them or not."""
    out = []
    for doc, text in docs:
        w = split(text)
        at = {}
        for i, x in enumerate(w):
            at.setdefault(x, []).append(i)
        for item, t in items:
            b = split(t)
            short = len(b) < D.MIN_ITEM_WORDS
            need, share = (len(b), 1.0) if short else (min(D.MIN_WORDS, len(b)), D.IDENTITY)
            found = []
            for z in {i - k for k, x in enumerate(b) for i in at.get(x, ())}:
                equal = [0 <= z + k < len(w) and w[z + k] == x for k, x in enumerate(b)]
                if sum(equal) >= share * need - 1e-9:
                    s, e, same = overlap(equal, share)
                    if e - s >= need:
                        found.append((s - e, -same, z + s, s))
            if found:
                n, same, i, k = min(found)
                out.append((doc, item, i, k, -n, -same))
    return out


def test_overlaps_against_all_alignments(tables):
    docs, bench, d, b = tables
    rows = [tuple(r) for r in D.overlaps(docs, bench).collect()]
    assert sorted(rows, key=str) == sorted(want_pairs(d, b), key=str)
    found = {r[0] for r in rows}
    assert set(range(30)) | set(range(100, 130)) | {None, 402, 403} <= found
    assert {(404, 35), (404, 36), (406, 34)} <= {r[:2] for r in rows} and (405, 35) not in {r[:2] for r in rows}
    assert not found & (set(range(200, 230)) | set(range(300, 330)) | {400, 401})


def test_blocks_of_the_benchmark_change_nothing(tables):
    docs, bench, _, _ = tables
    a = sorted(map(str, D.overlaps(docs, bench).collect()))
    assert sorted(map(str, D.overlaps(docs, bench, block_words=120).collect())) == a


def test_repeated_words_against_all_alignments(spark):
    """More hits than alignments: runs and periods of equal words."""
    texts = ["a " * 40, "a b " * 30, "a b c d e f g h " * 8 + "x", "a a b " * 20, "b " * 11, "a " * 11, "a", "a b"]
    table = [(k, t) for k, t in enumerate(texts)]
    docs, items = (spark.createDataFrame(table, f"{c} long, text string") for c in ("doc_id", "item_id"))
    rows = [tuple(r) for r in D.overlaps(docs, items).collect()]
    assert sorted(rows) == sorted(want_pairs(table, table))


def test_a_million_equal_words_end_soon():
    import time

    index = D.Index(pa.array(["a " * 200, "a b c " * 60]), D.MASKS, D.MIN_ITEM_WORDS)
    at = time.monotonic()
    got = index.search(D.words(pa.array(["a " * 1_000_000])), D.MIN_WORDS, D.IDENTITY)
    assert got == [(0, 0, 0, 0, 200, 200)]
    assert time.monotonic() - at < 60


def test_stage_with_several_blocks(spark, clashing, sf_dir, monkeypatch):
    one = sorted(map(str, D.stage(spark, clashing, sf_dir).collect()))
    monkeypatch.setattr(D, "BLOCK_WORDS", 5)
    assert sorted(map(str, D.stage(spark, clashing, sf_dir).collect())) == one


def test_stage_and_empty(spark, clashing, empty, sf_dir):
    kept = D.stage(spark, clashing, sf_dir)
    assert kept.columns == clashing.columns
    gone = {str(r["doc_id"]) for r in clashing.collect()} - {str(r["doc_id"]) for r in kept.collect()}
    assert gone == {"6"}
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    assert {r["doc_id"] for r in D.overlaps(clashing, bench).collect()} == {6}
    assert D.stage(spark, empty, sf_dir).count() == 0
    assert D.overlaps(clashing, bench.limit(0)).count() == 0
