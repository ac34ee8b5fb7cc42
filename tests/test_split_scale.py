"""Splits over sampled ranges stay exact when the sampler sees almost nothing.

The inputs are the events of sf0.1, shuffled over many partitions, with a
range sampler of one row per partition: bounds differ whenever a plan runs,
as they do at scale.
"""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quizlog.operators import augment, metrics, profile, rank, windows
from quizlog.sources.fixture import interactions

SF1 = "/root/testdata/sf0.1"


@pytest.fixture
def blind_sampler(spark):
    key = "spark.sql.execution.rangeExchange.sampleSizePerPartition"
    old = spark.conf.get(key)
    spark.conf.set(key, "1")
    yield
    spark.conf.set(key, old)


@pytest.fixture(scope="module")
def skewed(spark):
    """One learner with a third of the log, 40 others, and rows without one."""
    log = interactions(spark, SF1).where("event_id % 2 = 0")
    user = F.when(F.col("event_id") % 6 == 0, 1).when(F.col("event_id") % 50 == 4, None).otherwise(F.col("userID") % 40 + 2)
    return log.withColumn("userID", user.cast("long")).repartition(23, F.xxhash64("event_id"))


def same(a, b):
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_split_scan_equals_plain_scan(spark, skewed, blind_sampler):
    plain = windows.ordered_scan(skewed, recent_k=9)
    assert plain.count() == skewed.count()
    split = windows.ordered_scan(skewed, recent_k=9, hot_rows=900, bucket_rows=300)
    same(plain, split.select(plain.columns))
    top = split.where("userID = 1").agg(F.max("_rn"), F.countDistinct("_rn"), F.count("*")).first()
    assert top[0] == top[1] == top[2] > 10_000


def test_rows_without_a_learner_have_no_history(skewed):
    null = windows.ordered_scan(skewed, recent_k=3, user_aggs={"n": ([], "count", "answerCode")}).where("userID is null")
    assert null.count() > 300
    assert null.where("coalesce(_len, _rn, _cs, _cc, _prev_val, _rk_sum, n) is not null or _next_ts is not null").count() == 0
    assert windows.add_interaction_token(skewed).where("userID is null and interaction is not null").count() == 0
    assert augment.sliding_windows(skewed, n=20, stride=20).where("userID is null").count() == 0


def test_prefix_sums_and_rank_full_width(skewed, blind_sampler):
    """All columns are kept, so no exchange can be shared by accident."""
    for _ in range(2):
        got = rank.global_rank(skewed, ["Timestamp", "event_id"], "r", n_buckets=37)
        want = skewed.withColumn("r", F.row_number().over(Window.orderBy("Timestamp", "event_id")).cast("long"))
        same(got.select(want.columns), want)


@pytest.mark.parametrize("scan_kw", [{}, {"hot_rows": 900, "bucket_rows": 300}])
def test_original_order_full_width(skewed, blind_sampler, scan_kw):
    has = skewed.where("userID is not null")
    want = has.withColumn("original_order", (F.row_number().over(Window.orderBy("userID", "Timestamp", "event_id")) - 1).cast("long"))
    got = rank.original_order(skewed, scan_kw=scan_kw)
    same(got.where("userID is not null").select(want.columns), want.withColumn("original_order", F.col("original_order")))
    assert got.where("userID is null and original_order is not null").count() == 0


def test_auroc_repeats_and_is_exact(spark, skewed, blind_sampler):
    df = skewed.select(
        (F.pmod(F.xxhash64("event_id"), F.lit(20_011)) / 20_011.0).alias("prediction"), F.col("answerCode").alias("target"),
        F.when(F.col("event_id") % 4 > 0, F.col("event_id") % 4).alias("g"))
    a = [metrics.auroc(df).first()["auc"] for _ in range(2)]
    pdf = df.toPandas()

    def exact(p):
        r = p.prediction.rank()
        pos, neg = (p.target == 1).sum(), (p.target == 0).sum()
        return (r[p.target == 1].sum() - pos * (pos + 1) / 2) / (pos * neg)

    assert a[0] == a[1] and abs(a[0] - exact(pdf)) < 1e-12
    by = {r["g"]: r["auc"] for r in metrics.auroc(df, by=["g"]).collect()}
    assert len(by) == pdf.g.nunique(dropna=False)  # a null group is a group
    for g, p in pdf.groupby("g", dropna=False):
        assert abs(by[None if g != g else g] - exact(p)) < 1e-12


def test_quantiles_and_splits(spark, skewed, blind_sampler):
    got = profile.describe(skewed, "event_id").first()
    want = skewed.agg(*[F.percentile("event_id", F.lit(q)).alias(n) for q, n in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))]).first()
    assert [got[n] for n in ("p25", "p50", "p75")] == list(want)
    folds = [rank.kfold(skewed, "event_id", k=7) for _ in range(2)]
    same(*folds)
    sizes = [r["count"] for r in folds[0].groupBy("fold").count().collect()]
    assert len(sizes) == 7 and max(sizes) - min(sizes) <= 1 and sum(sizes) == skewed.count()


def test_augmentation_on_the_split_path(skewed, blind_sampler):
    """Positions need no value, so event ids near the top of a long are fine."""
    df = skewed.withColumn("event_id", F.col("event_id") + 9_000_000_000_000_000_000).where("userID = 1")
    kw = {"hot_rows": 900, "bucket_rows": 300}
    same(augment.sliding_windows(df, n=20, stride=7), augment.sliding_windows(df, n=20, stride=7, scan_kw=kw))
    for kind in ("tiled", "random", "overhang"):
        same(augment.crop_windows(df, n=20, crop_type=kind), augment.crop_windows(df, n=20, crop_type=kind, scan_kw=kw))


def test_million_row_learner_at_default_limits(spark):
    """A learner above the default limit: 2.6 million rows made from the events."""
    base = interactions(spark, SF1).select("Timestamp", "answerCode", "event_id")
    big = base.crossJoin(F.broadcast(spark.range(26))).select(
        F.lit(5).cast("long").alias("userID"), "Timestamp", "answerCode", (F.col("event_id") * 26 + F.col("id")).alias("event_id"))
    r = windows.add_prior_stats(big).agg(
        F.max("user_total_answer").alias("m"), F.countDistinct("user_total_answer").alias("d"), F.count("*").alias("n"),
        F.max("user_correct_answer").alias("c"), F.sum("answerCode").alias("s")).first()
    assert (r["m"], r["d"], r["n"]) == (2_599_999, 2_600_000, 2_600_000)
    assert r["s"] - 1 <= r["c"] <= r["s"]


def test_cluster_without_a_shared_folder_is_refused():
    from quizlog.session import ensure_checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
