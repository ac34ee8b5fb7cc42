import math

from pyspark.sql import functions as F

import brute
from quizlog.llm import bytetext as B
from quizlog.llm import language_id as L
from quizlog.llm import wordstats


def test_word_table_counts_every_word(corpus):
    from collections import Counter

    want = Counter()
    for r in corpus.collect():
        want.update((w, (r["doc_id"] or 0) % 2) for w in brute.SPACE.findall(brute.lower(r["text"])))
    got = wordstats.word_table(corpus, F.coalesce(F.col("doc_id") % 2, F.lit(0)), 2, B.SPACE_WORDS).collect()
    assert {(r["word"], g): r[f"c{g}"] for r in got for g in (0, 1) if r[f"c{g}"]} == dict(want)


def test_held_out_accuracy(spark, corpus, clashing):
    for docs in (corpus, clashing):
        got = {r["doc_id"]: r for r in L.identify(docs, (F.col("doc_id") % 4) != 2).collect()}
        assert len(got) == corpus.select("doc_id").distinct().count()
        for r in corpus.where("doc_id < 60").collect():
            assert got[r["doc_id"]]["lang_pred"] == r["lang"]
            assert 0.9 < got[r["doc_id"]]["score"] <= 1
        for i in (62, 63, 64):
            assert (got[i]["lang_pred"], got[i]["score"]) == ("und", 0.0)
        assert got[None]["lang_pred"] == "fr"
        assert got[65]["lang_pred"] == "en"


def test_scores_against_brute_force(spark):
    docs = spark.createDataFrame(
        [(1, "aa bb aa", "x"), (2, "cc bb", "y"), (3, "aa zz", None), (4, "bb", None), (5, "aa aa cc 7", "q")], "doc_id long, text string, lang string")
    train = F.col("doc_id") <= 2
    got = {r["doc_id"]: r for r in L.identify(docs, train).collect()}
    count = {"x": {"aa": 2, "bb": 1}, "y": {"cc": 1, "bb": 1}}
    total, vocab = {"x": 3, "y": 2}, 3
    logp = lambda w, l: math.log((count[l].get(w, 0) + L.SMOOTH) / (total[l] + L.SMOOTH * vocab))
    for doc, words in ((1, "aa bb aa"), (4, "bb"), (5, "aa aa cc")):
        s = {l: sum(logp(w, l) for w in words.split()) for l in "xy"}
        best = max("xy", key=s.get)
        assert got[doc]["lang_pred"] == best
        assert abs(got[doc]["score"] - 1 / sum(math.exp(v - s[best]) for v in s.values())) < 1e-9


def test_rare_words_take_the_join_path(corpus):
    """With no room for frequent words every word is joined: same result."""
    vectors = wordstats.word_table(corpus, F.lit(0), 1, B.SPACE_WORDS).select("h", F.col("c0").alias("n"), F.col("c0").cast("double").alias("v0"))
    a = wordstats.word_sums(corpus, ["doc_id"], vectors, 1, B.SPACE_WORDS, hot_words=0)
    b = wordstats.word_sums(corpus, ["doc_id"], vectors, 1, B.SPACE_WORDS)
    key = lambda r: str(r)
    assert sorted(map(tuple, a.collect()), key=key) == sorted(map(tuple, b.collect()), key=key)


def test_unseen_words_back_off_to_ngrams(spark):
    rows = [(i, w, lang) for lang, ws in (("en", "washing walking talking sleeping"), ("de", "waschung heizung zeitung leitung"))
            for i, w in enumerate(ws.split() * 3)]
    docs = spark.createDataFrame(rows + [(100, "jumping", None), (101, "wohnung", None), (102, "q", None)], "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["lang_pred"] for r in L.identify(docs, F.col("doc_id") < 100).collect() if r["doc_id"] >= 100}
    assert got[100] == "en" and got[101] == "de" and got[102] in ("de", "en")


def test_nothing_to_learn_from_and_empty(corpus, empty):
    got = L.identify(corpus, F.lit(False)).collect()
    assert {(r["lang_pred"], r["score"]) for r in got} == {("und", 0.0)}
    assert L.identify(empty, F.lit(True)).count() == 0


def test_stage_drops_only_what_has_no_language(spark, clashing, empty):
    kept = L.stage(spark, clashing, "")
    assert kept.columns == clashing.columns
    gone = {62, 63, 64}
    want = sorted(str(r["doc_id"]) for r in clashing.collect() if r["doc_id"] not in gone)
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == want
    assert L.stage(spark, empty, "").count() == 0


def test_backoff_is_exact_for_many_ngrams(spark):
    """Far more n-grams than the 65,536 buckets once used; any share of them in the broadcast table."""
    import random
    from collections import Counter

    r = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyz"
    make = lambda n: "".join(r.choice(letters) for _ in range(n))
    train = {make(9) for _ in range(30_000)}
    extra = [make(3) for _ in range(200)] + [make(6) for _ in range(200)] + ["çça", "7q", "日本", "b日本c"]
    unseen = sorted(set(extra) - train)

    def grams(w, n):
        marked = "\x02" + w + "\x03"
        return [g for g in (marked[i : i + n] for i in range(len(marked) - n + 1)) if n > 1 or g not in "\x02\x03"]

    count = {n: [Counter(), Counter()] for n in L.ORDERS}
    rows = []
    for i, w in enumerate(sorted(train)):
        rows.append((i, w, i % 2 + 1, 2 - i % 2, 0))
        for n in L.ORDERS:
            for k in (0, 1):
                for g in grams(w, n):
                    count[n][k][g] += rows[-1][2 + k]
    rows += [(10**6 + i, w, 0, 0, 1) for i, w in enumerate(unseen)]
    words = spark.createDataFrame(rows, "h long, word string, c0 long, c1 long, c2 long").repartition(3)
    assert len(count[4][0] + count[4][1]) > 1 << 16

    room = {n: [sum(c.values()) + L.SMOOTH * len(count[n][0].keys() | count[n][1].keys()) + 1 for c in count[n]] for n in L.ORDERS}

    def value(w, k):
        for n in L.ORDERS:
            hits = [g for g in grams(w, n) if count[n][0][g] + count[n][1][g]]
            if hits:
                return sum(math.log((count[n][k][g] + L.SMOOTH) / room[n][k]) for g in hits) / n
        return 0.0

    for hot in (L.HOT_NGRAMS, 500, 0):
        got = {r["h"]: r for r in L.word_scores(words, 2, hot).where("h >= 1000000").collect()}
        assert len(got) == len(unseen)
        for i, w in enumerate(unseen):
            for k in (0, 1):
                assert abs(got[10**6 + i][f"v{k}"] - value(w, k)) < 1e-9, (hot, w)
