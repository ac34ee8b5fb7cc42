"""The train / score flow end to end.

read -> grade split (P5) / target-grade rows (J3) -> target encoding fitted
on the training log (A15) -> vocabulary fitted on the training log and
applied (E1, E2) -> optional window augmentation (G7) -> last-N sequences and
model input (Y1-Y8) -> last-position features (O2) -> Spark ML classifier
(M2) -> scores (M3) -> prediction ids (M10).

``train`` takes a training log and leaves everything scoring needs in a
folder; ``infer`` takes a test log and that folder.
"""

from __future__ import annotations

import json
from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import grade_split_id
from ..operators import augment, keyed, metrics, model, rank, sequences, vocab
from ..sources.fixture import logs

MAX_SEQ_LEN = 20
# Feature versions: 0 plain sequences per learner, 1 split by grade, 2 with
# target-encoded means beside the codes.
VERSION = 2
ARRAY_FEATURES = ("test_mean", "assessment_mean", "tag_mean", "user_acc", "user_total_answer", "interaction")


def features_of(version: int) -> tuple[str, ...]:
    """The last-position features that a feature version has."""
    return ARRAY_FEATURES if version >= 2 else tuple(f for f in ARRAY_FEATURES if f not in sequences.CONT_COLS)


def _sequence_id(version: int):
    return grade_split_id() if version >= 1 else F.col("userID").cast("string")


def model_input_table(
    rows: DataFrame, encoder, vocabulary: DataFrame, seq: str, n: int, version: int = VERSION
) -> DataFrame:
    """Rows -> one model-input row per sequence: cut to the last ``n`` rows
    first, so only those are encoded and coded."""
    t = sequences.keep_last(rows, n, seq)
    if version >= 2:
        t = keyed.apply_target_encoder(t, encoder)
    t = vocab.apply_vocabulary(t, vocabulary)
    conts = sequences.CONT_COLS if version >= 2 else None
    seqs = sequences.collect_sequences(t, seq=seq, max_len=n, conts=conts, is_cut=True)
    return sequences.model_input(seqs, n)


def augmented_input(
    rows: DataFrame, encoder, vocabulary: DataFrame, seq: str, n: int, kind: str, version: int = VERSION, **kw
) -> DataFrame:
    """Like ``model_input_table``, but one model-input row per window or crop
    of a sequence (G7; ``kind`` and ``kw`` as in ``augment.augment``), keyed
    by ``seq`` and the window's number or start.  For training only."""
    if version < 2:
        w = augment.augment(vocab.apply_vocabulary(rows, vocabulary), kind, n=n, seq=seq, fields=sequences.SEQ_FIELDS, **kw)
        return sequences.model_input(w.drop("event_ids"), n)
    t = vocab.apply_vocabulary(keyed.apply_target_encoder(rows, encoder), vocabulary)
    conts = {f"_c{i}": c for i, c in enumerate(sequences.CONT_COLS)}
    w = augment.augment(t, kind, n=n, seq=seq, fields={**sequences.SEQ_FIELDS, **conts}, **kw)
    # one vector per position from the aligned arrays
    vectors = F.transform(F.arrays_zip(*conts), lambda z: F.array(*[z[c].cast("float") for c in conts]))
    seqs = w.withColumn("conts", vectors).drop("event_ids", *conts)
    return sequences.model_input(seqs, n)


def fit_encoders(train: DataFrame):
    """Target encoder and vocabulary fitted on the training log with one
    scan: the encoder's per-key tables already hold every distinct test, tag
    and item, which are the vocabulary's labels.  Both are materialised once
    and shared by the train and test sides."""
    enc = keyed.fit_target_encoder(train)
    tables, _ = enc
    labels = None
    for key, t in zip(keyed.TARGET_KEYS.values(), tables):
        part = t.select(F.lit(key).alias("column"), F.col(key).cast("string").alias("label"))
        labels = part if labels is None else labels.unionByName(part)
    return enc, vocab.vocabulary_from_labels(labels, list(keyed.TARGET_KEYS.values()))


def last_position_features(mi: DataFrame, n: int) -> DataFrame:
    """Features of the last valid position of each model-input row (O2):
    its three target-encoded means (where the input has them), the interaction token, whether the answer
    before was right, the number of earlier kept positions and their accuracy.
    ``label`` is the last answer (null for a hidden target)."""
    valid = F.col("gather_index") + 1
    earlier = F.slice("correct", F.lit(n) - valid + 1, valid - 1)
    earlier_sum = F.aggregate(earlier, F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    means = {}
    if "conts" in mi.columns:
        last = sequences.last_position("conts")
        means = {c: last[i].cast("double") for i, c in enumerate(("test_mean", "assessment_mean", "tag_mean"))}
    last_answer = sequences.last_position("correct")
    return mi.select(
        *[c for c in mi.columns if c not in ("test", "question", "tag", "correct", "mask", "interaction", "conts")],
        *[v.alias(c) for c, v in means.items()],
        F.when(valid > 1, earlier_sum / (valid - 1)).alias("user_acc"),
        (valid - 1).cast("double").alias("user_total_answer"),
        sequences.last_position("interaction").cast("double").alias("interaction"),
        (sequences.last_position("interaction") == 2).cast("double").alias("prev_right"),
        F.when(last_answer >= 0, last_answer.cast("double")).alias("label"),
    )


def train_examples(
    train: DataFrame, encoders, n: int = MAX_SEQ_LEN, augmentation: str | None = None, version: int = VERSION, **augment_kw
) -> DataFrame:
    """One example per training sequence (Q7 train mode: per learner and
    grade; version 0 per learner), or with ``augmentation`` (slide or crop)
    one per window of it."""
    enc, voc = encoders
    t = train.withColumn("seq_id", _sequence_id(version))
    if augmentation:
        return last_position_features(augmented_input(t, enc, voc, "seq_id", n, augmentation, version, **augment_kw), n)
    return last_position_features(model_input_table(t, enc, voc, "seq_id", n, version), n)


def test_examples(test: DataFrame, encoders, n: int = MAX_SEQ_LEN, version: int = VERSION) -> DataFrame:
    """One example per test learner: only rows of the target's grade (J3; in
    version 0 all rows of a learner with a target), statistics from the
    training log (Q7 test mode, Q8, Q9)."""
    enc, voc = encoders
    t = test.withColumn("seq_id", _sequence_id(version))
    t = keyed.keep_target_groups(t, ["seq_id"]).drop("seq_id")
    return last_position_features(model_input_table(t, enc, voc, "userID", n, version), n)


def save_encoders(encoders, path: str) -> None:
    (tables, _), voc = encoders
    for key, t in zip(keyed.TARGET_KEYS.values(), tables):
        t.write.mode("overwrite").parquet(f"{path}/encoder/{key}")
    vocab.save_vocabulary(voc, f"{path}/vocabulary")


def load_encoders(spark: SparkSession, path: str):
    tables = [spark.read.parquet(f"{path}/encoder/{key}") for key in keyed.TARGET_KEYS.values()]
    small = sum(map(keyed.table_bytes, tables)) <= keyed.BROADCAST_MAX_BYTES
    return (tables, small), vocab.load_vocabulary(spark, f"{path}/vocabulary")


def train(
    train_log: DataFrame,
    path: str,
    features: tuple[str, ...] | None = None,
    n: int = MAX_SEQ_LEN,
    k: int | None = None,
    seed: int = 42,
    augmentation: dict | None = None,
    candidates: dict[str, dict] | None = None,
    version: int = VERSION,
    **fit_kw,
) -> DataFrame:
    """Fit on all training sequences and save encoders, vocabulary and model
    under ``path``.

    ``k`` fits k fold models instead of one and returns their out-of-fold
    predictions ``(fold, seq_id, prediction, label)``; otherwise the training
    examples are returned.  ``augmentation`` (``{"kind": "slide", ...}``) adds
    windows of the training sequences.  ``candidates`` maps a name to
    ``fit_classifier`` arguments: all are fitted on a ratio split, and the one
    with the best validation AUROC (M9) is fitted on everything and saved; every
    candidate's AUROC, accuracy and log-loss are kept under ``path`` too
    (``candidate_scores``).  ``version`` is the feature version."""
    spark = train_log.sparkSession
    encoders = fit_encoders(train_log)
    save_encoders(encoders, path)
    features = features_of(version) if features is None else features
    kw = dict(augmentation or {})
    ex = keyed.materialize(train_examples(train_log, encoders, n, kw.pop("kind", None), version, **kw))
    out = ex
    if candidates:
        split = ex.where("seq_id IS NOT NULL").withColumn("is_train", rank.ratio_flag(ex, "seq_id", 0.7, seed))
        scores = None
        for name, args in sorted(candidates.items()):
            clf = model.fit_classifier(split.where("is_train"), **{"features": features, **fit_kw, **args})
            valid = model.score(clf, split.where(~F.col("is_train")), keep=("label",)).withColumn("candidate", F.lit(name))
            scores = valid if scores is None else scores.unionByName(valid)
        # one table of all candidates' scores: each metric is one job for all
        scores = keyed.materialize(scores)
        scores = metrics.auroc(scores, target="label", by=["candidate"]).join(
            metrics.accuracy(scores, target="label", by=["candidate"]), "candidate").join(
            metrics.log_loss(scores, target="label", by=["candidate"]), "candidate")
        scores.coalesce(1).write.mode("overwrite").parquet(f"{path}/candidates")  # one row a candidate
        scores = candidate_scores(spark, path)
        best = metrics.best_candidate(scores).first()["candidate"]
        fit_kw = {**fit_kw, **candidates[best if best is not None else sorted(candidates)[0]]}
        features = fit_kw.pop("features", features)
    if k:
        out, models = model.cross_validate(ex, k=k, seed=seed, key="seq_id", features=features, **fit_kw)
    else:
        models = [model.fit_classifier(ex, features, **fit_kw)]
    for i, m in enumerate(models):
        m.save(f"{path}/models/{i}")
    meta = json.dumps({"n": n, "models": len(models), "version": version})
    spark.createDataFrame([(meta,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/flow")
    return out


def candidate_scores(spark: SparkSession, path: str) -> DataFrame:
    """``candidate, auc, acc, log_loss`` on the validation part, one row per
    candidate that ``train`` compared."""
    return spark.read.parquet(f"{path}/candidates")


def _votes(test_log: DataFrame, path: str) -> DataFrame:
    """``userID, prediction`` of every model of a folder."""
    spark = test_log.sparkSession
    meta = json.loads(spark.read.text(f"{path}/flow").first()[0])
    # One row per test learner: written once, read by the scorers.
    tex = keyed.materialize(test_examples(test_log, load_encoders(spark, path), meta["n"], meta.get("version", VERSION)))
    out = None
    for i in range(meta["models"]):
        part = model.score(model.Classifier.load(spark, f"{path}/models/{i}"), tex, keep=("userID",))
        out = part if out is None else out.unionByName(part)
    return out


def infer(test_log: DataFrame, path: str | Sequence[str]) -> DataFrame:
    """Submission rows ``id, userID, prediction`` for the hidden answers of
    ``test_log`` from what ``train`` saved: one model's score, or the soft vote
    of all models of all folders (M5).  Folders may hold models of other
    features, versions, encoders and sequence lengths."""
    paths = [path] if isinstance(path, str) else list(path)
    votes = reduce(DataFrame.unionByName, [_votes(test_log, p) for p in paths])
    out = keyed.materialize(metrics.soft_vote(votes, "userID"))  # one row per test learner
    ids = rank.prediction_ids(out.select("userID"), "userID")
    return ids.join(out, "userID").select("id", "userID", "prediction")


def flow_folder(spark: SparkSession) -> str:
    """A fresh folder for ``train`` inside the shared checkpoint folder."""
    import uuid

    from ..session import ensure_checkpoint_dir

    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/flow-{uuid.uuid4().hex}"


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train on the fixture's training log, save, reload, score its test log."""
    train_log, test_log = logs(spark, sf_dir)
    path = flow_folder(spark)
    train(train_log, path)
    return infer(test_log, path)


def validation_report(
    train_log: DataFrame, ratio: float = 0.7, seed: int = 0, features: tuple[str, ...] = ARRAY_FEATURES, **fit_kw
) -> DataFrame:
    """Ratio split of training sequences (D1), fit on one part, AUROC,
    accuracy and log-loss on the other (M6-M8).  One row."""
    ex = keyed.materialize(train_examples(train_log, fit_encoders(train_log)))
    ex = ex.where("seq_id IS NOT NULL").withColumn("is_train", rank.ratio_flag(ex, "seq_id", ratio, seed))
    clf = model.fit_classifier(ex.where("is_train"), features, **fit_kw)
    valid = model.score(clf, ex.where(~F.col("is_train")), keep=("label",))
    # Scored once, read by the four metrics.
    valid = keyed.materialize(valid.withColumnRenamed("label", "target"))
    return (
        metrics.auroc(valid)
        .crossJoin(metrics.accuracy(valid))
        .crossJoin(metrics.log_loss(valid))
        .crossJoin(valid.agg(F.count(F.lit(1)).alias("n_valid")))
    )
