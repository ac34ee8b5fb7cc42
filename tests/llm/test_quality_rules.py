import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import brute
from quizlog.llm import quality_rules as Q

LINE = st.text(alphabet="ab \t#é", max_size=6)
TEXT = st.one_of(st.none(), st.lists(LINE, max_size=12).map("\n".join), st.lists(st.sampled_from("abc"), max_size=40).map(" ".join))


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXT, max_size=8))
def test_counts(texts):
    got = Q.rule_counts(pa.array(texts, pa.string()))
    for i, t in enumerate(texts):
        assert {k: int(v[i]) for k, v in got.items()} == brute.rules(t)


@pytest.fixture(scope="module")
def labelled(spark):
    good = [(i, f"The river runs past garden number {i} and the people of the town walk there in the evening light", 1) for i in range(120)]
    bad = [(200 + i, " ".join(f"### {i} $$$ BUY%{k}%" for k in range(12)), 0) for i in range(60)]
    docs = spark.createDataFrame([(a, b) for a, b, _ in good + bad], "doc_id long, text string")
    labels = spark.createDataFrame([(a, c, 0) for a, _, c in good + bad] + [(None, 1, 0), (9999, 0, 1)], "doc_id long, quality int, toxic int")
    return docs, labels


def test_model_separates_held_out_rows(labelled):
    docs, labels = labelled
    train = labels.where("doc_id % 3 <> 0")
    got = Q.score(docs, Q.train(docs, train)).where("doc_id % 3 = 0").toPandas()
    assert got[got.doc_id < 200].kept.mean() > 0.95
    assert got[got.doc_id >= 200].kept.mean() < 0.05
    assert got.quality_probability.between(0, 1).all()


def test_bound_on_training_rows(labelled):
    docs, labels = labelled
    assert Q.train(docs, labels, rows=8) is not None


def test_rules_alone_without_labels(corpus, clashing, empty):
    labels = corpus.sparkSession.createDataFrame([], "doc_id long, quality int, toxic int")
    assert Q.train(corpus, labels) is None
    for docs in (corpus, clashing):
        got = Q.score(docs, None).toPandas()
        rows = corpus.collect()
        assert len(got) == len(rows)
        want = {}
        for r in rows:
            b = brute.rules(r["text"])
            failed = b["n_words"] < 10 or 100 * b["n_repeat_words"] > 20 * b["n_words"]
            want[str(r["doc_id"])] = (*b.values(), failed)
        for x in got.itertuples():
            i = "None" if x.doc_id != x.doc_id else str(int(x.doc_id))
            assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words, x.base_failed) == want[i]
            assert x.kept == (not x.base_failed)
    assert Q.score(empty, None).count() == 0


def test_stage_returns_kept_rows_unchanged(spark, clashing, empty, sf_dir):
    kept = Q.stage(spark, clashing, sf_dir)
    assert kept.columns == clashing.columns
    model = Q.train(clashing, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    want = sorted(str(r["doc_id"]) for r in Q.score(clashing, model).where("kept").collect())
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == want
    assert Q.stage(spark, empty, sf_dir).count() == 0
