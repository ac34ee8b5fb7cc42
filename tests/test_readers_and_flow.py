"""Readers' contract, and training separated from scoring."""

import math
import os

import pytest
from pyspark.sql import functions as F

from log_helpers import SF01
from quizlog.operators import vocab
from quizlog.plans import flagship
from quizlog.sources import io
from quizlog.sources.fixture import interactions, split_logs


def write_csv(path, rows):
    with open(path, "w") as f:
        f.write("userID,assessmentItemID,testId,answerCode,Timestamp,KnowledgeTag\n")
        f.writelines(f"{u},A0{u % 9}0001001,A0{u % 9}0000001,{u % 2},2024-01-01 00:00:{u % 60:02d},{n}\n" for u, n in rows)


def test_file_order_does_not_depend_on_splits(spark, tmp_path):
    """Three files of unequal size, read with two split sizes: numbers follow
    the files' names and lines."""
    n = 0
    for name, count in (("a.csv", 10), ("b.csv", 5000), ("c.csv", 200)):
        write_csv(os.path.join(tmp_path, name), [(n + i, n + i) for i in range(count)])
        n += count
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    got = []
    try:
        for size in ("128m", "60k"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            got.append(sorted((r["event_id"], r["KnowledgeTag"]) for r in io.read_interactions_csv(spark, str(tmp_path)).collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got[0] == got[1] == [(i, i) for i in range(n)]


def test_parquet_reader_types_checks_and_nan(spark, tmp_path):
    p = str(tmp_path / "log")
    log = interactions(spark, SF01).limit(20)
    odd = log.withColumn("answerCode", F.when(F.col("event_id") % 2 == 0, float("nan")).otherwise(F.col("answerCode").cast("double")))
    odd.withColumn("extra", F.lit(1)).withColumn("userID", F.col("userID").cast("int")).write.parquet(p)
    back = io.read_interactions_parquet(spark, p)
    assert back.dtypes == list(io.LOG_COLUMNS.items())
    assert back.where("answerCode is null").count() == log.where("event_id % 2 = 0").count()
    named = io.read_interactions_parquet(spark, p, tie="extra")
    assert named.where("event_id <> 1").count() == 0
    log.drop("event_id", "testId").write.parquet(p + "2")
    with pytest.raises(ValueError, match="event_id, testId"):
        io.read_interactions_parquet(spark, p + "2")


def test_csv_reader_refuses_other_columns(spark, tmp_path):
    with open(tmp_path / "x.csv", "w") as f:
        f.write("userID,when\n1,2\n")
    with pytest.raises(Exception):
        io.read_interactions_csv(spark, str(tmp_path)).collect()


def test_vocabulary_round_trip_and_missing_column(spark, tmp_path):
    train, test = split_logs(interactions(spark, SF01))
    v = vocab.fit_vocabulary(train)
    vocab.save_vocabulary(v, str(tmp_path / "v"))
    back = vocab.load_vocabulary(spark, str(tmp_path / "v"))
    assert back.exceptAll(v).count() == 0 and v.exceptAll(back).count() == 0
    with pytest.raises(ValueError, match="school"):
        vocab.apply_vocabulary(test.withColumn("school", F.lit("x")), v, ["testId", "school"])


@pytest.mark.parametrize("k", [None, 3])
def test_scores_from_the_saved_folder_equal_fresh_ones(spark, tmp_path, k):
    train, test = split_logs(interactions(spark, SF01))
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    flagship.train(train, a, k=k)
    first = {r["userID"]: r["prediction"] for r in flagship.infer(test, a).collect()}
    again = {r["userID"]: r["prediction"] for r in flagship.infer(test, a).collect()}
    flagship.train(train, b, k=k)
    fresh = {r["userID"]: r["prediction"] for r in flagship.infer(test, b).collect()}
    assert first == again and len(first) == test.select("userID").distinct().count()
    assert all(math.isclose(first[u], fresh[u], abs_tol=1e-9) for u in first)


def test_training_on_augmented_windows(spark, tmp_path):
    train, test = split_logs(interactions(spark, SF01))
    plain = flagship.train(train, str(tmp_path / "p"), n=6)
    wide = flagship.train(train, str(tmp_path / "w"), n=6, augmentation={"kind": "slide", "stride": 2})
    assert wide.count() > plain.count() and "window" in wide.columns
    assert wide.select("seq_id").distinct().count() == plain.count()
    # the last window of a sequence is its own end: the same example
    last = wide.join(wide.groupBy("seq_id").agg(F.max("window").alias("window")), ["seq_id", "window"])
    cols = ["seq_id", "label", "interaction", "user_acc", "test_mean"]
    assert last.select(cols).exceptAll(plain.select(cols)).count() == 0
    assert flagship.infer(test, str(tmp_path / "w")).where("prediction between 0 and 1").count() == 15


def test_unseen_items_count_as_average(spark):
    from quizlog.operators import model

    rows = [(1.0, 1.0), (0.0, 0.0), (1.0, 1.0), (0.0, 1.0)]
    ex = spark.createDataFrame(rows, "x double, label double")
    clf = model.fit_classifier(ex, ("x",))
    assert clf.fill == {"x": 0.5}
    got = model.score(clf, spark.createDataFrame([(1, None), (2, 0.5)], "k int, x double"), keep=("k",)).collect()
    assert got[0]["prediction"] == got[1]["prediction"]
