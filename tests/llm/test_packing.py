import itertools
import random
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

import brute
from quizlog.llm import best_fit_packing as P
from quizlog.llm import subwords
from quizlog.llm import token_output as T
from quizlog.llm.shared import scratch_path


def check_bins(bins, sizes, cap):
    assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in b) <= cap for b in bins)


def test_bin_completion_is_optimal_on_small_sets():
    r = random.Random(1)
    better = 0
    for _ in range(80):
        sizes = [r.randint(12, 70) for _ in range(r.randint(1, 10))]
        bins = P.pack(sizes, 100)
        check_bins(bins, sizes, 100)
        assert len(bins) == brute.fewest_bins(sizes, 100)
    # best-fit decreasing needs 3 bins here, completion finds 2
    sizes = [44, 44, 24, 24, 24, 22, 8, 5, 5]
    first = P.best_fit_decreasing(sizes, 100)
    better = P.bin_completion(sizes, 100, first)
    assert len(first) == 3 and len(better) == 2
    check_bins(better, sizes, 100)


@pytest.mark.parametrize("n", [28, 40, 50, 100, 200])
def test_many_small_pieces_end_at_once(n):
    """Small pieces that all fit beside one another have one undominated
    filling, and exact packings are found without visiting the others."""
    r = random.Random(n)
    sizes = r.sample(range(1, 2 * n), n - 2) if n <= 50 else [x % 30 + 1 for x in range(n - 2)]
    rest = 4096 - sum(sizes)
    sizes += [rest // 2, rest - rest // 2]
    at = time.monotonic()
    bins = P.pack(sizes)
    assert time.monotonic() - at < 1
    check_bins(bins, sizes, P.CAPACITY)
    assert len(bins) == 2


def test_fillings_are_undominated_and_fullest_first():
    r = random.Random(2)
    for _ in range(60):
        have = Counter(r.randint(1, 12) for _ in range(r.randint(0, 7)))
        values = sorted(have, reverse=True)
        counts, room = [have[v] for v in values], r.randint(0, 25)
        got = list(P.fillings(values, counts, room, 0, [10**6]))
        assert [s for s, _ in got] == sorted((s for s, _ in got), reverse=True)
        assert len({f for _, f in got}) == len(got)
        each = [f for f in itertools.product(*[range(c + 1) for c in counts]) if sum(v * u for v, u in zip(values, f)) <= room]
        want = [f for f in each if not P._dominated(values, counts, f, room - sum(v * u for v, u in zip(values, f)))]
        assert sorted(f for _, f in got) == sorted(want)


def test_lower_bound_is_a_bound():
    r = random.Random(6)
    for _ in range(80):
        sizes = [r.randint(1, 100) for _ in range(r.randint(0, 9))]
        assert -(-sum(sizes) // 100) <= P.lower_bound(sizes, 100) <= brute.fewest_bins(sizes, 100)
    assert P.lower_bound([60, 60, 60, 30, 30], 100) == 3 and P.lower_bound([70, 70, 35, 35, 35], 100) == 4


def test_a_large_group_is_searched_whole():
    """Three pieces a bin, where best-fit decreasing takes the wrong ones."""
    r = random.Random(1)
    sizes = [r.randint(500, 900) for _ in range(2500)]
    first, bins = P.best_fit_decreasing(sizes, P.CAPACITY), P.pack(sizes)
    check_bins(bins, sizes, P.CAPACITY)
    assert len(bins) < 0.97 * len(first)


def test_best_fit_places_by_hand():
    for f in (P.best_fit_decreasing, lambda s, c: T.best_fit_decreasing(np.array(s), c)):
        bins = f([6, 5, 4, 3, 2], 10)
        assert sorted(sorted(b) for b in bins) == [[0, 2], [1, 3, 4]]


def test_segment_tree_finds_least_room():
    r = random.Random(4)
    tree, rooms = T.RoomTree(50), []
    for _ in range(3000):
        if rooms and r.random() < 0.5:
            size = r.randint(0, 50)
            fit = [x for x in rooms if x >= size]
            got = tree.take(size)
            assert (got[0] if got else None) == (min(fit) if fit else None)
            if got:
                rooms.remove(got[0])
        else:
            room = r.randint(0, 50)
            rooms.append(room)
            tree.add(room, 0)


@pytest.fixture(scope="module")
def encoded(corpus):
    t = Tokenizer.from_file(subwords.default_path())
    return [(r["doc_id"], t.encode(r["text"] or "", add_special_tokens=False).ids + [0]) for r in corpus.collect()]


def pieces_of(encoded, cap):
    out = []
    for doc, ids in encoded:
        for k in range(0, len(ids), cap):
            p = ids[k : k + cap]
            out.append((doc, k // cap, k, len(p), zlib.crc32(np.array(p, "<u4").tobytes())))
    return sorted(out, key=str)


def check_table(rows, want, cap):
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows), key=str) == want
    seqs = {}
    for r in rows:
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for s in seqs.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= cap
    return len(seqs)


@pytest.mark.parametrize("cap,group", [(2048, 50_000), (128, 20)])
def test_pack_documents(corpus, clashing, encoded, cap, group):
    want = pieces_of(encoded, cap)
    for docs in (corpus, clashing):
        n = check_table(P.pack_documents(docs, capacity=cap, group=group).collect(), want, cap)
        # no worse than best-fit decreasing over all pieces at once, but for
        # less than one sequence a group
        assert n <= len(P.best_fit_decreasing([w[3] for w in want], cap)) + len(want) // group


def test_packed_matrices_round_trip(spark, corpus, clashing, encoded):
    for docs, cap, buffer in ((corpus, 2048, 1 << 22), (clashing, 64, 3000)):
        path = scratch_path(spark)
        T.write(T.pack_ids(docs, capacity=cap, buffer_tokens=buffer), path)
        rows = T.read_pieces(spark, path).collect()
        check_table(rows, pieces_of(encoded, cap), cap)
        assert all(r["positions_ok"] for r in rows)
        for r in spark.read.parquet(path).collect():
            assert len(r["ids"]) == len(r["positions"]) == 2 * cap
            cu = np.frombuffer(r["cu_seqlens"], "<i4")
            assert cu[0] == 0 and cu[-1] == r["n_tokens"] and len(cu) == len(r["doc_ids"]) + 1


def test_empty(empty, spark):
    assert P.pack_documents(empty).count() == 0
    path = scratch_path(spark)
    T.write(T.pack_ids(empty), path)
    assert T.read_pieces(spark, path).count() == 0
    with pytest.raises(ValueError):
        T.pack_ids(empty, capacity=1 << 17)
