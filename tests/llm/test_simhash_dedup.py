import random

import numpy as np
from pyspark.sql import functions as F

import brute
from quizlog.llm import simhash_dedup as S
from quizlog.llm.components import components


def test_all_documents_against_brute_force(corpus, clashing):
    rows = corpus.collect()
    for docs in (corpus, clashing):
        got = sorted(((r["doc_id"], r["fp"] & (2**64 - 1), r["component_id"]) for r in S.near_duplicates(docs).collect()), key=str)
        fps = [brute.fingerprint(r["text"]) for r in rows]
        best = brute.groups(fps)
        ids = [r["doc_id"] for r in rows]
        least = {}
        for i, b in enumerate(best):
            if ids[i] is not None:
                least[b] = min(least.get(b, ids[i]), ids[i])
        want = sorted(((ids[i], fps[i], least.get(best[i])) for i in range(len(rows))), key=str)
        assert got == want


def test_tiles_find_every_link(spark):
    """Random balls of near fingerprints, with tiles far smaller than a ball."""
    r = random.Random(3)
    fps = []
    for _ in range(12):
        centre = r.getrandbits(64)
        for _ in range(40):
            x = centre
            for _ in range(r.randint(0, 4)):
                x ^= 1 << r.randrange(64)
            fps.append(x)
    fps += [0, 1, 2**64 - 1, 2**63, 3 << 62]
    fps = sorted(set(fps))
    r.shuffle(fps)
    signed = [int(np.array([f], np.uint64).view(np.int64)[0]) for f in fps]
    prints = spark.createDataFrame([(f,) for f in signed], "fp long")
    for radius in (0, 1, 2, 3):
        for tile in (8, 1024):
            got = {x["node"]: x["component"] for x in components(S.links(prints, radius, tile=tile)).collect()}
            best = brute.groups(fps, radius)
            label = [got.get(f, f) for f in signed]
            # the same groups, whatever names them
            assert len(set(zip(label, best))) == len(set(label)) == len(set(best))


def test_null_ids_bridge_and_ids_on_two_texts_do_not(spark):
    """0 - 3 - 15: two bits each; the middle print has no id.  Documents 7 are
    two texts, far apart."""
    far = (1 << 40) - 1
    fps = spark.createDataFrame([(1, 0), (None, 3), (5, 15), (7, far << 20), (7, 15 << 8), (None, -1)], "doc_id long, fp long")
    got = {(r["fp"]): (r["component_id"], r["first_fp"]) for r in S.print_groups(fps).collect()}
    assert got == {0: (1, 0), 3: (1, 0), 15: (1, 0), far << 20: (7, far << 20), 15 << 8: (7, 15 << 8), -1: (None, -1)}


def test_a_bucket_is_compared_in_one_shuffle_by_its_key(spark):
    """Without a hot bucket: no pair of tiles, six rows a print."""
    assert len(S.part_masks(2)) == 6 and all(bin(m).count("1") == 32 for m in S.part_masks(2))
    r = random.Random(1)
    prints = spark.createDataFrame([(r.getrandbits(62),) for _ in range(200)], "fp long")
    plan = S.links(prints)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_stage_decides_by_id_and_text(spark):
    """Ids that repeat on other texts, copies without an id, repeated rows."""
    text = {k: " ".join(f"{k}{i % 17}w{i * i % 23}" for i in range(60)) for k in "abcde"}
    rows = [(1, "a"), (1, "b"), (2, "a"), (None, "a"), (None, "c"), (None, "c"), (3, "d"), (3, "d"), (4, "b"), (5, "e"), (5, "d")]
    docs = spark.createDataFrame([(i, text[k], k) for i, k in rows], "doc_id long, text string, name string")
    got = sorted(((r["doc_id"], r["name"]) for r in S.stage(spark, docs, "").collect()), key=str)
    assert got == sorted([(1, "a"), (1, "b"), (None, "c"), (3, "d"), (5, "e")], key=str)


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(70)] + [(100, k) for k in range(101, 180)] + [(200, 200), (None, 3)]
    got = {x["node"]: x["component"] for x in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(71)}, **{k: 100 for k in range(100, 180)}}


def test_empty(empty):
    assert S.near_duplicates(empty).count() == 0
    assert S.stage(empty.sparkSession, empty, "").count() == 0


def test_stage_keeps_one_of_each_group(spark, clashing):
    kept = S.stage(spark, clashing, "")
    assert kept.columns == clashing.columns
    found = S.near_duplicates(clashing).collect()
    names = {(r["component_id"], r["fp"]) for r in found}
    got = [r["doc_id"] for r in kept.where("doc_id is not null").collect()]
    assert sorted(got) == sorted({c for c, _ in names if c is not None})
    assert 60 not in got and 0 in got  # the copy goes, its first stays
    assert kept.where(F.col("doc_id") == 61).count() <= 1
