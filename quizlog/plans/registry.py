"""Registered queries: one Spark callable and, where SQL can express it, one

Every query reads the driver's ``events`` table through the fixture view, so
its work grows with the table.  Doubles are rounded to 9 places on both sides
so that summation order cannot flip a hash.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import keyed, windows
from ..sources.fixture import duck_with, interactions, logs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

R = 9  # decimal places compared for doubles


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = duck_with(sql)
        return fn

    return deco


def rnd(c, places: int = R):
    return F.round(F.col(c) if isinstance(c, str) else c, places)


def _log(spark, sf_dir):
    return interactions(spark, sf_dir)


def _train_test(spark, sf_dir):
    return logs(spark, sf_dir)


# ---------------------------------------------------------------- S / P

@register(
    "s1_interactions",
    "SELECT event_id, userID, \"Timestamp\", assessmentItemID, testId, KnowledgeTag, answerCode FROM interactions",
)
def q_s1(spark, sf_dir):
    return _log(spark, sf_dir)


@register(
    "s3_test_log",
    "SELECT event_id, userID, \"Timestamp\", assessmentItemID, testId, KnowledgeTag, answerCode FROM test_log",
)
def q_s3(spark, sf_dir):
    return _train_test(spark, sf_dir)[1]


@register(
    "p02_p05_id_fields",
    """SELECT event_id,
       cast(substring(testId, 3, 1) AS int) AS grade,
       CASE WHEN floor(cast(substring(testId, 3, 1) AS int) / 7) = 0 THEN 'elementary_school'
            ELSE 'middle_school' END AS school,
       substring(assessmentItemID, 1, 3) AS grade_prefix,
       concat(substring(assessmentItemID, 1, 3), cast(userID AS varchar)) AS seq_id
FROM interactions""",
)
def q_p02_p05(spark, sf_dir):
    return _log(spark, sf_dir).select(
        "event_id",
        S.grade().alias("grade"),
        S.school().alias("school"),
        S.grade_prefix().alias("grade_prefix"),
        S.grade_split_id().alias("seq_id"),
    )


@register(
    "f1_f5_time_encodings",
    """SELECT event_id,
       epoch_us("Timestamp") // 1000000 AS epoch_seconds,
       round(sin(2 * pi() * hour("Timestamp") / 24), 9) + 0.0 AS hour_sin,
       round(cos(2 * pi() * hour("Timestamp") / 24), 9) + 0.0 AS hour_cos,
       round(sin(2 * pi() * (isodow("Timestamp") - 1) / 7), 9) + 0.0 AS dow_sin,
       round(cos(2 * pi() * (isodow("Timestamp") - 1) / 7), 9) + 0.0 AS dow_cos,
       round(sin(2 * pi() * day("Timestamp") / 31), 9) + 0.0 AS dom_sin,
       round(cos(2 * pi() * day("Timestamp") / 31), 9) + 0.0 AS dom_cos,
       round(sin(2 * pi() * month("Timestamp") / 12), 9) + 0.0 AS month_sin,
       round(cos(2 * pi() * month("Timestamp") / 12), 9) + 0.0 AS month_cos
FROM interactions""",
)
def q_f1_f5(spark, sf_dir):
    df = _log(spark, sf_dir).select(
        "event_id",
        S.epoch_seconds().alias("epoch_seconds"),
        S.encoded_hour().alias("h"),
        S.encoded_dayoftheweek().alias("dw"),
        S.encoded_dayofthemonth().alias("dm"),
        S.encoded_month().alias("m"),
    )
    out = [F.col("event_id"), F.col("epoch_seconds")]
    for src, dst in (("h", "hour"), ("dw", "dow"), ("dm", "dom"), ("m", "month")):
        out += [rnd(F.col(src).sin).alias(f"{dst}_sin"), rnd(F.col(src).cos).alias(f"{dst}_cos")]
    return df.select(*out)


# ---------------------------------------------------------------- A1-A14

_A_IDS = {
    "KnowledgeTag_count": "a01",
    "KnowledgeTag_acc_mean": "a02",
    "KnowledgeTag_countU": "a03",
    "KnowledgeTag_acc_meanU": "a04",
    "assessmentItemID_count": "a05",
    "assessmentItemID_acc_mean": "a06",
    "assessmentItemID_countU": "a07",
    "assessmentItemID_acc_meanU": "a08",
    "userID_count": "a09",
    "user_acc_mean": "a10",
    "userID_acc_meanT": "a11",
    "userID_countT": "a12",
    "testId_count": "a13",
    "testId_acc_mean": "a14",
}


def _a_sql(name: str) -> str:
    keys, agg = keyed.FEATURE_STATS[name]
    fn = "count(answerCode)" if agg == "count" else "avg(answerCode)"
    val = f"s.{name}" if agg == "count" else f"round(s.{name}, {R})"
    keycols = ", ".join(keys)
    notnull = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    on = " AND ".join(f"i.{k} = s.{k}" for k in keys)
    extra = ", ".join(f"i.{k}" for k in keys if k != "userID")
    return (
        f"SELECT i.event_id, i.userID, {extra}, {val} AS {name}\n"
        f"FROM interactions i LEFT JOIN (SELECT {keycols}, {fn} AS {name} FROM interactions "
        f"WHERE {notnull} GROUP BY {keycols}) s ON {on}"
    ).replace("i.userID, , ", "i.userID, ")


def _a_query(name: str):
    keys, agg = keyed.FEATURE_STATS[name]

    def q(spark, sf_dir):
        df = keyed.add_feature_stats(_log(spark, sf_dir), [name])
        val = F.col(name) if agg == "count" else rnd(name).alias(name)
        return df.select("event_id", "userID", *[k for k in keys if k != "userID"], val)

    return q


for _name, _id in _A_IDS.items():
    register(f"{_id}_{_name}", _a_sql(_name))(_a_query(_name))


# ---------------------------------------------------------------- A15 / J2 / J3

_TE_SQL = """
SELECT t.event_id, t.userID, t.testId, t.KnowledgeTag, t.assessmentItemID,
       round(a.test_mean, 9) AS test_mean, a.test_sum,
       round(b.tag_mean, 9) AS tag_mean, b.tag_sum,
       round(c.assessment_mean, 9) AS assessment_mean, c.assessment_sum
FROM {target} t
LEFT JOIN (SELECT testId, avg(answerCode) AS test_mean, cast(sum(answerCode) AS bigint) AS test_sum
           FROM {fit} WHERE testId IS NOT NULL GROUP BY testId) a ON t.testId = a.testId
LEFT JOIN (SELECT KnowledgeTag, avg(answerCode) AS tag_mean, cast(sum(answerCode) AS bigint) AS tag_sum
           FROM {fit} WHERE KnowledgeTag IS NOT NULL GROUP BY KnowledgeTag) b ON t.KnowledgeTag = b.KnowledgeTag
LEFT JOIN (SELECT assessmentItemID, avg(answerCode) AS assessment_mean,
                  cast(sum(answerCode) AS bigint) AS assessment_sum
           FROM {fit} WHERE assessmentItemID IS NOT NULL GROUP BY assessmentItemID) c
       ON t.assessmentItemID = c.assessmentItemID
"""


def _te_select(df):
    return df.select(
        "event_id",
        "userID",
        "testId",
        "KnowledgeTag",
        "assessmentItemID",
        rnd("test_mean").alias("test_mean"),
        "test_sum",
        rnd("tag_mean").alias("tag_mean"),
        "tag_sum",
        rnd("assessment_mean").alias("assessment_mean"),
        "assessment_sum",
    )


@register("a15_target_encoding_fit_train_apply_test", _TE_SQL.format(target="test_log", fit="train_log"))
def q_a15_test(spark, sf_dir):
    train, test = _train_test(spark, sf_dir)
    return _te_select(keyed.target_encode(test, fit_on=train))


@register("a15_target_encoding_train", _TE_SQL.format(target="train_log", fit="train_log"))
def q_a15_train(spark, sf_dir):
    train, _ = _train_test(spark, sf_dir)
    return _te_select(keyed.target_encode(train))


@register(
    "j3_target_grade_rows",
    """WITH t AS (SELECT *, concat(substring(assessmentItemID, 1, 3), cast(userID AS varchar)) AS seq_id
              FROM test_log)
SELECT event_id, userID, seq_id, answerCode FROM t
WHERE seq_id IN (SELECT seq_id FROM t WHERE answerCode = -1)""",
)
def q_j3(spark, sf_dir):
    _, test = _train_test(spark, sf_dir)
    t = test.withColumn("seq_id", S.grade_split_id())
    return keyed.keep_target_groups(t, ["seq_id"]).select("event_id", "userID", "seq_id", "answerCode")


# ---------------------------------------------------------------- A16-A18

@register(
    "a16_first_timestamps",
    """SELECT userID, min("Timestamp") AS Timestamp_start,
       (SELECT min("Timestamp") FROM interactions) AS Timestamp_first
FROM interactions GROUP BY userID""",
)
def q_a16(spark, sf_dir):
    return keyed.first_timestamps(_log(spark, sf_dir))


@register(
    "a17_user_enter_day",
    """WITH s AS (SELECT userID, min("Timestamp") AS st FROM interactions GROUP BY userID),
g AS (SELECT min("Timestamp") AS gt FROM interactions)
SELECT i.event_id, i.userID,
       cast(floor((epoch_us(s.st) - epoch_us(g.gt)) / 86400000000.0) AS int) AS user_enterDay
FROM interactions i JOIN s ON i.userID = s.userID CROSS JOIN g""",
)
def q_a17(spark, sf_dir):
    return keyed.add_user_enter_day(_log(spark, sf_dir)).select("event_id", "userID", "user_enterDay")


@register(
    "a18_user_day_progress",
    """WITH s AS (SELECT userID, min("Timestamp") AS st FROM interactions GROUP BY userID)
SELECT i.event_id, i.userID,
       cast(floor((epoch_us(i."Timestamp") - epoch_us(s.st)) / 86400000000.0) AS int) AS user_day_progress
FROM interactions i JOIN s ON i.userID = s.userID""",
)
def q_a18(spark, sf_dir):
    return keyed.add_user_day_progress(_log(spark, sf_dir)).select("event_id", "userID", "user_day_progress")


# ---------------------------------------------------------------- W1-W7

_W = 'OVER (PARTITION BY userID ORDER BY "Timestamp", event_id'


@register(
    "w1_time_diff",
    f"""WITH g AS (SELECT event_id, userID,
       (epoch_us(lead("Timestamp") {_W})) - epoch_us("Timestamp")) // 1000000 % 86400 AS secs
FROM interactions)
SELECT event_id, userID, cast(CASE WHEN secs < 80 THEN secs END AS bigint) AS time_diff FROM g""",
)
def q_w1(spark, sf_dir):
    return windows.add_time_diff(_log(spark, sf_dir), outlier_thres=80).select("event_id", "userID", "time_diff")


@register(
    "w2_cummean",
    f"""SELECT event_id, userID,
       round(avg(answerCode) {_W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 9) AS userID_acc_cummean
FROM interactions""",
)
def q_w2(spark, sf_dir):
    df = windows.add_cummean(_log(spark, sf_dir))
    return df.select("event_id", "userID", rnd("userID_acc_cummean").alias("userID_acc_cummean"))


def _w3(k):
    sql = f"""SELECT event_id, userID,
       round(avg(answerCode) {_W} ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW), 9) AS userID_acc_mean_recentK
FROM interactions"""

    def q(spark, sf_dir):
        df = windows.add_recent_mean(_log(spark, sf_dir), k=k)
        return df.select("event_id", "userID", rnd("userID_acc_mean_recentK").alias("userID_acc_mean_recentK"))

    return sql, q


for _k in (50, 5):
    _sql, _q = _w3(_k)
    register(f"w3_recent_mean_k{_k}", _sql)(_q)


@register(
    "w4_w6_prior_stats",
    f"""SELECT event_id, userID,
       cast(sum(answerCode) {_W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS bigint) AS user_correct_answer,
       cast(row_number() {_W}) - 1 AS int) AS user_total_answer,
       round(sum(answerCode) {_W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
             / nullif(row_number() {_W}) - 1, 0), 9) AS user_acc
FROM interactions""",
)
def q_w4_w6(spark, sf_dir):
    df = windows.add_prior_stats(_log(spark, sf_dir))
    return df.select(
        "event_id", "userID", "user_correct_answer", "user_total_answer", rnd("user_acc").alias("user_acc")
    )


@register(
    "w7_family_ids",
    """WITH t AS (SELECT *, cast(substring(testId, 3, 1) AS int) AS grade,
       CASE WHEN floor(cast(substring(testId, 3, 1) AS int) / 7) = 0 THEN 'elementary_school'
            ELSE 'middle_school' END AS school FROM interactions),
f AS (SELECT userID, school, grade, "Timestamp", event_id FROM
        (SELECT *, row_number() OVER (PARTITION BY userID, school, grade ORDER BY "Timestamp", event_id) AS r FROM t)
      WHERE r = 1),
k AS (SELECT userID, school, grade,
             concat(cast(userID AS varchar), '-',
                    cast(row_number() OVER (PARTITION BY userID ORDER BY "Timestamp", event_id) AS varchar))
             AS familyUserID FROM f)
SELECT t.event_id, t.userID AS familyID, t.school, t.grade, k.familyUserID
FROM t JOIN k ON t.userID = k.userID AND t.school = k.school AND t.grade = k.grade""",
)
def q_w7(spark, sf_dir):
    return windows.family_ids(_log(spark, sf_dir)).select("event_id", "familyID", "school", "grade", "familyUserID")


@register(
    "y5_interaction_token_rows",
    f"""SELECT event_id, userID, cast(coalesce(lag(answerCode) {_W}) + 1, 0) AS int) AS interaction
FROM interactions""",
)
def q_y5_rows(spark, sf_dir):
    return windows.add_interaction_token(_log(spark, sf_dir)).select("event_id", "userID", "interaction")


# ---------------------------------------------------------------- E1, E2, A24

from ..operators import augment, sequences, vocab  # noqa: E402

_VOCAB_SQL = """v AS (SELECT col AS "column", label,
             cast(row_number() OVER (PARTITION BY col ORDER BY label) - 1 AS int) AS code
      FROM (SELECT DISTINCT col, label FROM (
              SELECT 'assessmentItemID' AS col, assessmentItemID AS label FROM {src}
              UNION ALL SELECT 'testId', testId FROM {src}
              UNION ALL SELECT 'KnowledgeTag', cast(KnowledgeTag AS varchar) FROM {src}
              UNION ALL SELECT c, 'unknown' FROM (VALUES ('assessmentItemID'), ('testId'), ('KnowledgeTag')) u(c))
            WHERE label IS NOT NULL))"""


@register("e1_vocabulary_fit", "WITH " + _VOCAB_SQL.format(src="train_log") + "\nSELECT * FROM v")
def q_e1(spark, sf_dir):
    train, _ = _train_test(spark, sf_dir)
    return vocab.fit_vocabulary(train)


_APPLY_SQL = """
SELECT t.event_id, t.userID,
       coalesce(vi.code, ui.code) AS assessmentItemID,
       coalesce(vt.code, ut.code) AS testId,
       coalesce(vg.code, ug.code) AS KnowledgeTag
FROM {target} t
LEFT JOIN v vi ON vi."column" = 'assessmentItemID' AND vi.label = t.assessmentItemID
LEFT JOIN v vt ON vt."column" = 'testId' AND vt.label = t.testId
LEFT JOIN v vg ON vg."column" = 'KnowledgeTag' AND vg.label = cast(t.KnowledgeTag AS varchar)
CROSS JOIN (SELECT code FROM v WHERE "column" = 'assessmentItemID' AND label = 'unknown') ui
CROSS JOIN (SELECT code FROM v WHERE "column" = 'testId' AND label = 'unknown') ut
CROSS JOIN (SELECT code FROM v WHERE "column" = 'KnowledgeTag' AND label = 'unknown') ug"""


@register("e2_vocabulary_apply_test", "WITH " + _VOCAB_SQL.format(src="train_log") + _APPLY_SQL.format(target="test_log"))
def q_e2(spark, sf_dir):
    train, test = _train_test(spark, sf_dir)
    v = vocab.fit_vocabulary(train)
    return vocab.apply_vocabulary(test, v).select("event_id", "userID", *vocab.CATEGORICAL)


@register(
    "a24_vocabulary_sizes",
    "WITH " + _VOCAB_SQL.format(src="train_log") + '\nSELECT "column", count(*) AS n_codes FROM v GROUP BY "column"',
)
def q_a24(spark, sf_dir):
    train, _ = _train_test(spark, sf_dir)
    return vocab.vocabulary_sizes(vocab.fit_vocabulary(train))


# ---------------------------------------------------------------- Y1-Y8

N_SEQ = 20


def prepared_train(spark, sf_dir, conts=False):
    """Training flow up to coded rows: grade-split ids (P5), the last N_SEQ
    rows of each sequence, target encoding fitted on the whole log where
    asked for (A15), vocabulary fitted and applied (E1, E2)."""
    train, _ = _train_test(spark, sf_dir)
    t = train.withColumn("seq_id", S.grade_split_id())
    enc, v = flow.fit_encoders(t)
    t = sequences.keep_last(t, N_SEQ, "seq_id")
    if conts:
        t = keyed.apply_target_encoder(t, enc)
    return vocab.apply_vocabulary(t, v)


def _ints(c):
    return F.array_join(F.transform(c, lambda x: x.cast("int").cast("string")), ",")


_SEQ_SQL = (
    "WITH t AS (SELECT *, concat(substring(assessmentItemID, 1, 3), cast(userID AS varchar)) AS seq_id "
    "FROM train_log),\n"
    + _VOCAB_SQL.format(src="t")
    + """,
c AS (SELECT t.*, vi.code AS q, vt.code AS te, vg.code AS tg FROM t
      JOIN v vi ON vi."column" = 'assessmentItemID' AND vi.label = t.assessmentItemID
      JOIN v vt ON vt."column" = 'testId' AND vt.label = t.testId
      JOIN v vg ON vg."column" = 'KnowledgeTag' AND vg.label = cast(t.KnowledgeTag AS varchar)),
k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY seq_id ORDER BY "Timestamp" DESC, event_id DESC) AS r
                     FROM c) WHERE r <= 20),
s AS (SELECT seq_id, count(*) AS n,
             list(te + 1 ORDER BY "Timestamp", event_id) AS test,
             list(q + 1 ORDER BY "Timestamp", event_id) AS question,
             list(tg + 1 ORDER BY "Timestamp", event_id) AS tag,
             list(answerCode ORDER BY "Timestamp", event_id) AS correct
      FROM k GROUP BY seq_id),
z AS (SELECT *, list_transform(range(20 - n), lambda x: 0) AS pad FROM s)
"""
)


@register(
    "y1_y7_model_input_train",
    _SEQ_SQL
    + """SELECT seq_id,
  array_to_string(list_concat(pad, test), ',') AS test,
  array_to_string(list_concat(pad, question), ',') AS question,
  array_to_string(list_concat(pad, tag), ',') AS tag,
  array_to_string(list_concat(pad, correct), ',') AS correct,
  array_to_string(list_concat(pad, list_transform(range(n), lambda x: 1)), ',') AS mask,
  array_to_string(list_concat(pad, list_concat([0], list_transform(correct[1:n - 1], lambda x: x + 1))), ',')
    AS interaction,
  cast(n - 1 AS int) AS gather_index
FROM z""",
)
def q_y1_y7(spark, sf_dir):
    t = prepared_train(spark, sf_dir)
    seqs = sequences.collect_sequences(t, seq="seq_id", max_len=N_SEQ, is_cut=True)
    mi = sequences.model_input(seqs, N_SEQ)
    return mi.select(
        "seq_id",
        *[_ints(c).alias(c) for c in ("test", "question", "tag", "correct", "mask", "interaction")],
        "gather_index",
    )


@register(
    "y8_conts_matrix_train",
    """WITH te AS (SELECT testId, avg(answerCode) AS test_mean FROM train_log GROUP BY testId),
ta AS (SELECT KnowledgeTag, avg(answerCode) AS tag_mean FROM train_log GROUP BY KnowledgeTag),
ai AS (SELECT assessmentItemID, avg(answerCode) AS assessment_mean FROM train_log GROUP BY assessmentItemID),
t AS (SELECT l.*, concat(substring(l.assessmentItemID, 1, 3), cast(l.userID AS varchar)) AS seq_id,
             te.test_mean, ta.tag_mean, ai.assessment_mean
      FROM train_log l JOIN te USING (testId) JOIN ta USING (KnowledgeTag) JOIN ai USING (assessmentItemID)),
k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY seq_id ORDER BY "Timestamp" DESC, event_id DESC) AS r,
                            count(*) OVER (PARTITION BY seq_id) AS cnt FROM t) WHERE r <= 20),
real AS (SELECT seq_id, cast(20 - r AS int) AS pos,
                round(cast(cast(test_mean AS float) AS double), 6) AS c0,
                round(cast(cast(assessment_mean AS float) AS double), 6) AS c1,
                round(cast(cast(tag_mean AS float) AS double), 6) AS c2 FROM k),
pads AS (SELECT seq_id, cast(unnest(range(20 - least(cnt, 20))) AS int) AS pos FROM k WHERE r = 1)
SELECT * FROM real UNION ALL SELECT seq_id, pos, 0.0, 0.0, 0.0 FROM pads""",
)
def q_y8(spark, sf_dir):
    t = prepared_train(spark, sf_dir, conts=True)
    seqs = sequences.collect_sequences(t, seq="seq_id", max_len=N_SEQ, conts=sequences.CONT_COLS, is_cut=True)
    mi = sequences.model_input(seqs, N_SEQ)
    e = mi.select("seq_id", F.posexplode("conts").alias("pos", "v"))
    return e.select(
        "seq_id",
        F.col("pos").cast("int").alias("pos"),
        *[F.round(F.col("v")[i].cast("double"), 6).alias(f"c{i}") for i in range(3)],
    )


# ---------------------------------------------------------------- G1-G6

_ROWS_SQL = """r AS (SELECT userID, event_id,
             row_number() OVER (PARTITION BY userID ORDER BY "Timestamp", event_id) - 1 AS p,
             count(*) OVER (PARTITION BY userID) AS L FROM interactions)"""


def _g_slide_sql(n, stride, shuffle_n=0):
    copies = (
        f"CASE WHEN L > {n} AND kind = 'full' AND \"window\" < T - 1 THEN range({shuffle_n}) ELSE [-1] END"
        if shuffle_n
        else "[-1]"
    )
    return f"""WITH {_ROWS_SQL},
u AS (SELECT DISTINCT userID, L, CASE WHEN L > {n} THEN (L - {n}) // {stride} + 1 ELSE 1 END AS T FROM r),
wins AS (SELECT userID, L, T, "window", 'full' AS kind,
                CASE WHEN L > {n} THEN "window" * {stride} ELSE 0 END AS start
         FROM (SELECT *, unnest(range(T)) AS "window" FROM u)
         UNION ALL
         SELECT userID, L, T, T, 'tail', L - {n} FROM u WHERE L > {n} AND L <> {n} + {stride} * (T - 1)),
wc AS (SELECT *, unnest({copies}) AS copy FROM wins),
j AS (SELECT wc.userID, wc."window", wc.copy, r.event_id, r.p - wc.start AS pos, r.p
      FROM wc JOIN r ON r.userID = wc.userID AND r.p >= wc.start AND r.p < wc.start + {n})
SELECT userID, cast("window" AS bigint) AS "window", cast(copy AS int) AS copy,
       string_agg(cast(event_id AS varchar), ',' ORDER BY
         CASE WHEN copy >= 0 THEN md5(concat_ws('|', userID, "window", copy, pos, '0'))
              ELSE lpad(cast(pos AS varchar), 12, '0') END) AS event_ids
FROM j GROUP BY userID, "window", copy"""


def _g_out(df, key="window"):
    cols = ["userID", F.col(key).cast("bigint").alias(key)]
    if "copy" in df.columns:
        cols.append(F.col("copy").cast("int").alias("copy"))
    return df.select(*cols, _ints("event_ids").alias("event_ids"))


@register("g1_g2_sliding_windows_n20_s7", _g_slide_sql(20, 7))
def q_g1(spark, sf_dir):
    return _g_out(augment.sliding_windows(_log(spark, sf_dir), n=20, stride=7))


@register("g3_sliding_shuffled_n20_s7", _g_slide_sql(20, 7, shuffle_n=2))
def q_g3(spark, sf_dir):
    return _g_out(augment.sliding_windows(_log(spark, sf_dir), n=20, stride=7, shuffle=True, shuffle_n=2, seed=0))


@register(
    "g4_crop_tiled_n20",
    f"""WITH {_ROWS_SQL}
SELECT userID, cast(CASE WHEN L > 20 THEN p // 20 * 20 ELSE 0 END AS bigint) AS start,
       string_agg(cast(event_id AS varchar), ',' ORDER BY p) AS event_ids
FROM r GROUP BY 1, 2""",
)
def q_g4(spark, sf_dir):
    return _g_out(augment.crop_windows(_log(spark, sf_dir), n=20, crop_type="tiled"), key="start")


def _g_rand_sql(n, start_expr):
    return f"""WITH {_ROWS_SQL},
u AS (SELECT DISTINCT userID, L FROM r WHERE L > {n}),
d AS (SELECT userID, L, unnest(range(L // {n} + 1)) AS j FROM u),
h AS (SELECT userID, L, ('0x' || substr(md5(concat_ws('|', userID, j, '0')), 1, 8))::BIGINT AS hv FROM d),
s AS (SELECT DISTINCT userID, {start_expr} AS start FROM h),
rows AS (SELECT s.userID, s.start, r.event_id, r.p FROM s JOIN r ON r.userID = s.userID
         AND r.p >= s.start AND r.p < s.start + {n}
         UNION ALL SELECT userID, 0, event_id, p FROM r WHERE L <= {n})
SELECT userID, cast(start AS bigint) AS start, string_agg(cast(event_id AS varchar), ',' ORDER BY p) AS event_ids
FROM rows GROUP BY 1, 2"""


@register("g5_crop_random_n20", _g_rand_sql(20, "hv % (L - 20 + 1)"))
def q_g5(spark, sf_dir):
    return _g_out(augment.crop_windows(_log(spark, sf_dir), n=20, crop_type="random", seed=0), key="start")


@register("g6_crop_overhang_n20", _g_rand_sql(20, "(1 - 20) + hv % (L + 20 - 2)"))
def q_g6(spark, sf_dir):
    return _g_out(augment.crop_windows(_log(spark, sf_dir), n=20, crop_type="overhang", seed=0), key="start")


# ---------------------------------------------------------------- P10, D1, D2, M10

from ..operators import metrics, rank  # noqa: E402


@register(
    "p10_original_order",
    'SELECT event_id, row_number() OVER (ORDER BY userID, "Timestamp", event_id) - 1 AS original_order '
    "FROM interactions",
)
def q_p10(spark, sf_dir):
    return rank.original_order(_log(spark, sf_dir)).select("event_id", "original_order")


@register(
    "d1_ratio_split_users",
    """WITH u AS (SELECT DISTINCT userID FROM interactions),
r AS (SELECT userID, row_number() OVER (ORDER BY md5(concat(cast(userID AS varchar), '|', '0')), userID) AS rk,
             count(*) OVER () AS n FROM u)
SELECT userID, rk <= floor(n * 0.7) AS is_train FROM r""",
)
def q_d1(spark, sf_dir):
    return rank.ratio_split(_log(spark, sf_dir), "userID", ratio=0.7, seed=0)


@register(
    "d2_kfold_users",
    """WITH u AS (SELECT DISTINCT userID FROM interactions)
SELECT userID, cast(ntile(5) OVER (ORDER BY md5(concat(cast(userID AS varchar), '|', '42')), userID) - 1 AS int)
       AS fold FROM u""",
)
def q_d2(spark, sf_dir):
    return rank.kfold(_log(spark, sf_dir), "userID", k=5, seed=42)


@register(
    "m10_prediction_ids",
    "SELECT userID, row_number() OVER (ORDER BY userID) - 1 AS id FROM test_log WHERE answerCode = -1",
)
def q_m10(spark, sf_dir):
    _, test = _train_test(spark, sf_dir)
    return rank.prediction_ids(test.where("answerCode = -1").select("userID"))


# ---------------------------------------------------------------- M6-M9, P11

# Predictions for metric checks (FIXTURES.md §3): score = accuracy of the
# row's tag over the whole log, target = answerCode.
_PRED_SQL = """p AS (SELECT i.event_id, cast(substring(i.testId, 3, 1) AS int) AS grade, s.m AS prediction,
             i.answerCode AS target
      FROM interactions i JOIN (SELECT KnowledgeTag, avg(answerCode) AS m FROM interactions
                                GROUP BY KnowledgeTag) s ON i.KnowledgeTag = s.KnowledgeTag)"""


def tag_score_predictions(spark, sf_dir):
    log = _log(spark, sf_dir)
    scored = keyed.add_feature_stats(log, ["KnowledgeTag_acc_mean"])
    return scored.select(
        "event_id",
        S.grade().alias("grade"),
        F.col("KnowledgeTag_acc_mean").alias("prediction"),
        F.col("answerCode").alias("target"),
    )


def _auc_sql(by: str = "") -> str:
    g = f"{by}, " if by else ""
    part = f"PARTITION BY {by} " if by else ""
    grp = f"GROUP BY {by}" if by else ""
    return f"""WITH {_PRED_SQL},
d AS (SELECT {g}prediction, cast(sum(target) AS double) AS pos, cast(sum(1 - target) AS double) AS neg
      FROM p GROUP BY {g}prediction),
c AS (SELECT *, coalesce(sum(neg) OVER ({part}ORDER BY prediction ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                         0) AS cum FROM d)
SELECT {g}round(CASE WHEN sum(pos) > 0 AND sum(neg) > 0
                     THEN sum(pos * (cum + 0.5 * neg)) / (sum(pos) * sum(neg)) END, 9) AS auc
FROM c {grp}"""


@register("m6_auroc_tag_score", _auc_sql())
def q_m6(spark, sf_dir):
    return metrics.auroc(tag_score_predictions(spark, sf_dir)).select(rnd("auc").alias("auc"))


@register("m6_auroc_tag_score_by_grade", _auc_sql("grade"))
def q_m6g(spark, sf_dir):
    a = metrics.auroc(tag_score_predictions(spark, sf_dir), by=["grade"])
    return a.select("grade", rnd("auc").alias("auc"))


@register(
    "m7_accuracy_tag_score",
    f"""WITH {_PRED_SQL}
SELECT round(avg(CASE WHEN CASE WHEN prediction >= 0.5 THEN 1 ELSE 0 END = target THEN 1.0 ELSE 0.0 END), 9) AS acc
FROM p""",
)
def q_m7(spark, sf_dir):
    return metrics.accuracy(tag_score_predictions(spark, sf_dir)).select(rnd("acc").alias("acc"))


@register(
    "m8_log_loss_tag_score",
    f"""WITH {_PRED_SQL}
SELECT round(avg(-(target * CASE WHEN prediction > 0 THEN greatest(ln(prediction), -100) ELSE -100 END
                 + (1 - target) * CASE WHEN 1 - prediction > 0 THEN greatest(ln(1 - prediction), -100)
                                  ELSE -100 END)), 9) AS log_loss
FROM p""",
)
def q_m8(spark, sf_dir):
    return metrics.log_loss(tag_score_predictions(spark, sf_dir)).select(rnd("log_loss").alias("log_loss"))


@register(
    "p11_binarize_tag_score",
    f"""WITH {_PRED_SQL}
SELECT event_id, round(prediction, 9) AS prediction, CASE WHEN prediction >= 0.5 THEN 1 ELSE 0 END AS label FROM p""",
)
def q_p11(spark, sf_dir):
    p = tag_score_predictions(spark, sf_dir)
    return p.select("event_id", rnd("prediction").alias("prediction"), S.binarize("prediction").alias("label"))


_CANDIDATES = {
    "item_acc": "assessmentItemID_acc_mean",
    "tag_acc": "KnowledgeTag_acc_mean",
    "test_acc": "testId_acc_mean",
    "user_acc": "user_acc_mean",
}


@register(
    "m9_best_scorer",
    """WITH s AS (SELECT i.answerCode AS target, c.candidate,
         CASE c.candidate WHEN 'item_acc' THEN a.m WHEN 'tag_acc' THEN b.m
                          WHEN 'test_acc' THEN t.m ELSE u.m END AS prediction
  FROM interactions i
  JOIN (SELECT assessmentItemID, avg(answerCode) AS m FROM interactions GROUP BY 1) a USING (assessmentItemID)
  JOIN (SELECT KnowledgeTag, avg(answerCode) AS m FROM interactions GROUP BY 1) b USING (KnowledgeTag)
  JOIN (SELECT testId, avg(answerCode) AS m FROM interactions GROUP BY 1) t USING (testId)
  JOIN (SELECT userID, avg(answerCode) AS m FROM interactions GROUP BY 1) u USING (userID)
  CROSS JOIN (VALUES ('item_acc'), ('tag_acc'), ('test_acc'), ('user_acc')) c(candidate)),
d AS (SELECT candidate, prediction, cast(sum(target) AS double) AS pos, cast(sum(1 - target) AS double) AS neg
      FROM s GROUP BY 1, 2),
c AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY candidate ORDER BY prediction
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cum FROM d),
m AS (SELECT candidate, sum(pos * (cum + 0.5 * neg)) / (sum(pos) * sum(neg)) AS auc FROM c GROUP BY 1)
SELECT candidate, round(auc, 9) AS auc FROM m ORDER BY auc DESC, candidate LIMIT 1""",
)
def q_m9(spark, sf_dir):
    log = keyed.add_feature_stats(_log(spark, sf_dir), list(_CANDIDATES.values()))
    # One pass over the scored log: each row yields one row per candidate.
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("candidate"), F.col(col).alias("prediction")) for c, col in _CANDIDATES.items()]))
    preds = log.select(pairs.alias("p"), F.col("answerCode").alias("target")).select("p.*", "target")
    m = metrics.auroc(preds, by=["candidate"])
    return metrics.best_candidate(m).select("candidate", rnd("auc").alias("auc"))


# ---------------------------------------------------------------- M4 / M5

K_FOLDS = 5


def fold_tag_models(train: DataFrame, folds: DataFrame, k: int = K_FOLDS) -> DataFrame:
    """Per fold f, the tag-accuracy model fitted on the other folds' rows:
    ``(fold, KnowledgeTag, prediction)``.  Out-of-fold means come from per
    (fold, tag) sums subtracted from per-tag totals, so the log is never
    copied k times."""
    t = train.join(folds, "userID")
    per = t.groupBy("fold", "KnowledgeTag").agg(
        F.sum("answerCode").alias("_fold_sum"), F.count("answerCode").alias("_fold_cnt")
    )
    tot = per.groupBy("KnowledgeTag").agg(F.sum("_fold_sum").alias("_all_sum"), F.sum("_fold_cnt").alias("_all_cnt"))
    fold_ids = train.sparkSession.range(k).select(F.col("id").cast("int").alias("fold"))
    grid = tot.crossJoin(F.broadcast(fold_ids)).join(per, ["fold", "KnowledgeTag"], "left")
    s = F.col("_all_sum") - F.coalesce(F.col("_fold_sum"), F.lit(0))
    c = F.col("_all_cnt") - F.coalesce(F.col("_fold_cnt"), F.lit(0))
    return grid.select("fold", "KnowledgeTag", F.when(c > 0, s / c).alias("prediction"))


@register(
    "m4_m5_kfold_soft_vote",
    """WITH u AS (SELECT DISTINCT userID FROM train_log),
f AS (SELECT userID, ntile(5) OVER (ORDER BY md5(concat(cast(userID AS varchar), '|', '42')), userID) - 1 AS fold
      FROM u),
tf AS (SELECT t.*, f.fold FROM train_log t JOIN f USING (userID)),
mdl AS (SELECT k.fold, tf.KnowledgeTag, avg(tf.answerCode) AS m
        FROM tf CROSS JOIN (SELECT unnest(range(5)) AS fold) k WHERE tf.fold <> k.fold GROUP BY 1, 2),
tg AS (SELECT userID, KnowledgeTag, row_number() OVER (ORDER BY userID) - 1 AS id FROM test_log WHERE answerCode = -1)
SELECT tg.id, tg.userID, round(avg(mdl.m), 9) AS prediction
FROM tg JOIN mdl ON tg.KnowledgeTag = mdl.KnowledgeTag GROUP BY tg.id, tg.userID""",
)
def q_m4_m5(spark, sf_dir):
    train, test = _train_test(spark, sf_dir)
    folds = rank.kfold(train, "userID", k=K_FOLDS, seed=42)
    models = keyed.checked_broadcast(fold_tag_models(train, folds))
    targets = rank.prediction_ids(test.where("answerCode = -1").select("userID", "KnowledgeTag"))
    fold_preds = targets.join(models, "KnowledgeTag").select("id", "userID", "fold", "prediction")
    voted = metrics.soft_vote(fold_preds.select("id", "prediction"))
    return voted.join(targets.select("id", "userID"), "id").select("id", "userID", rnd("prediction").alias("prediction"))


# ---------------------------------------------------------------- A19-A23, P8

from ..operators import profile  # noqa: E402

# The reference profiles the per-row test accuracy.
_TESTACC_SQL = """y AS (SELECT i.event_id, t.m AS x FROM interactions i
      JOIN (SELECT testId, avg(answerCode) AS m FROM interactions GROUP BY testId) t ON i.testId = t.testId)"""
_USERCNT_SQL = """y AS (SELECT i.event_id, cast(u.c AS double) AS x FROM interactions i
      JOIN (SELECT userID, count(answerCode) AS c FROM interactions GROUP BY userID) u ON i.userID = u.userID)"""


def _test_acc_rows(spark, sf_dir):
    return keyed.add_feature_stats(_log(spark, sf_dir), ["testId_acc_mean"]).select(
        "event_id", F.col("testId_acc_mean").alias("x")
    )


def _user_count_rows(spark, sf_dir):
    return keyed.add_feature_stats(_log(spark, sf_dir), ["userID_count"]).select(
        "event_id", F.col("userID_count").cast("double").alias("x")
    )


@register(
    "a19_describe_test_acc",
    f"""WITH {_TESTACC_SQL}
SELECT count(x) AS count, round(avg(x), 9) AS mean, round(stddev_samp(x), 9) AS std, round(min(x), 9) AS min,
       round(quantile_cont(x, 0.25), 9) AS p25, round(quantile_cont(x, 0.5), 9) AS p50,
       round(quantile_cont(x, 0.75), 9) AS p75, round(max(x), 9) AS max FROM y""",
)
def q_a19(spark, sf_dir):
    d = profile.describe(_test_acc_rows(spark, sf_dir), "x")
    return d.select("count", *[rnd(c).alias(c) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")])


@register(
    "a19_describe_user_count",
    f"""WITH {_USERCNT_SQL}
SELECT count(x) AS count, round(avg(x), 9) AS mean, round(stddev_samp(x), 9) AS std, round(min(x), 9) AS min,
       round(quantile_cont(x, 0.25), 9) AS p25, round(quantile_cont(x, 0.5), 9) AS p50,
       round(quantile_cont(x, 0.75), 9) AS p75, round(max(x), 9) AS max FROM y""",
)
def q_a19u(spark, sf_dir):
    d = profile.describe(_user_count_rows(spark, sf_dir), "x")
    return d.select("count", *[rnd(c).alias(c) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")])


@register(
    "a20_mode_median_share",
    f"""WITH {_TESTACC_SQL},
m AS (SELECT x AS mode FROM y GROUP BY x ORDER BY count(*) DESC, x LIMIT 1)
SELECT round(m.mode, 9) AS mode, round(quantile_cont(y.x, 0.5), 9) AS median,
       round(avg(CASE WHEN y.x = m.mode THEN 1.0 ELSE 0.0 END), 9) AS mode_share
FROM y CROSS JOIN m GROUP BY m.mode""",
)
def q_a20(spark, sf_dir):
    d = profile.mode_median_share(_test_acc_rows(spark, sf_dir), "x")
    return d.select(*[rnd(c).alias(c) for c in ("mode", "median", "mode_share")])


_BAND_SQL = f"""WITH {_USERCNT_SQL},
s AS (SELECT stddev_samp(x) AS sd, avg(x) AS mean, quantile_cont(x, 0.5) AS median FROM y),
md AS (SELECT x AS mode FROM y GROUP BY x ORDER BY count(*) DESC, x LIMIT 1),
c AS (SELECT 'mean' AS method, mean AS c, sd FROM s
      UNION ALL SELECT 'median', median, sd FROM s
      UNION ALL SELECT 'mode', md.mode, s.sd FROM s CROSS JOIN md),
b AS (SELECT method, greatest(0, cast(trunc(c - 1.96 * sd) AS bigint)) AS lower,
             cast(trunc(c + 1.96 * sd) AS bigint) AS upper FROM c)
"""


@register(
    "a21_band_coverage_user_count",
    _BAND_SQL
    + """SELECT b.method, b.lower, b.upper,
       round(avg(CASE WHEN y.x = floor(y.x) AND y.x >= b.lower AND y.x < b.upper THEN 1.0 ELSE 0.0 END), 9) AS coverage
FROM b CROSS JOIN y GROUP BY b.method, b.lower, b.upper""",
)
def q_a21(spark, sf_dir):
    c = profile.band_coverage(_user_count_rows(spark, sf_dir), "x", ["mean", "median", "mode"])
    return c.select("method", "lower", "upper", rnd("coverage").alias("coverage"))


@register(
    "a21_band_filter_rows_median",
    _BAND_SQL
    + """SELECT y.event_id, y.x FROM y CROSS JOIN (SELECT * FROM b WHERE method = 'median') b
WHERE y.x = floor(y.x) AND y.x >= b.lower AND y.x < b.upper""",
)
def q_a21f(spark, sf_dir):
    return profile.band_filter(_user_count_rows(spark, sf_dir), "x", "median").select("event_id", "x")


@register(
    "a22_histogram_test_acc",
    f"""WITH {_TESTACC_SQL},
r AS (SELECT CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS lo,
             CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS hi FROM y),
cnt AS (SELECT cast(least(floor((x - lo) * (10.0 / (hi - lo))), 9) AS int) AS bin, count(*) AS count
        FROM y CROSS JOIN r GROUP BY 1),
bins AS (SELECT cast(unnest(range(10)) AS int) AS bin)
SELECT bins.bin, round(lo + bins.bin * ((hi - lo) / 10), 9) AS lower_edge,
       round(lo + (bins.bin + 1) * ((hi - lo) / 10), 9) AS upper_edge, coalesce(cnt.count, 0) AS count
FROM bins CROSS JOIN r LEFT JOIN cnt ON bins.bin = cnt.bin""",
)
def q_a22(spark, sf_dir):
    h = profile.histogram(_test_acc_rows(spark, sf_dir), "x", 10)
    return h.select("bin", rnd("lower_edge").alias("lower_edge"), rnd("upper_edge").alias("upper_edge"), "count")


_USERS_SQL = """u AS (SELECT userID, avg(answerCode) AS user_acc, cast(count(answerCode) AS double) AS n_answers,
             cast(count(DISTINCT cast("Timestamp" AS date)) AS double) AS n_days FROM interactions GROUP BY userID)"""


@register(
    "a23_ols_one_predictor",
    f"""WITH {_USERS_SQL}
SELECT round(regr_intercept(user_acc, n_answers), 9) AS intercept,
       round(regr_slope(user_acc, n_answers), 9) AS coef_n_answers FROM u""",
)
def q_a23(spark, sf_dir):
    o = profile.ols(profile.user_table(_log(spark, sf_dir)), "user_acc", ["n_answers"])
    return o.select(rnd("intercept").alias("intercept"), rnd("coef_n_answers").alias("coef_n_answers"))


@register(
    "a23_ols_two_predictors",
    f"""WITH {_USERS_SQL},
m AS (SELECT var_pop(n_answers) AS s11, var_pop(n_days) AS s22, covar_pop(n_answers, n_days) AS s12,
             covar_pop(n_answers, user_acc) AS s1y, covar_pop(n_days, user_acc) AS s2y,
             avg(n_answers) AS m1, avg(n_days) AS m2, avg(user_acc) AS my FROM u),
b AS (SELECT (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1,
             (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2, m1, m2, my FROM m)
SELECT round(my - b1 * m1 - b2 * m2, 6) AS intercept, round(b1, 6) AS coef_n_answers, round(b2, 6) AS coef_n_days
FROM b""",
)
def q_a23b(spark, sf_dir):
    o = profile.ols(profile.user_table(_log(spark, sf_dir)), "user_acc", ["n_answers", "n_days"])
    return o.select(*[F.round(c, 6).alias(c) for c in ("intercept", "coef_n_answers", "coef_n_days")])


# ---------------------------------------------------------------- M1-M5, X1, flows

import numpy as np  # noqa: E402

from ..operators import model  # noqa: E402
from . import features as feature_plan  # noqa: E402
from . import flagship as flow  # noqa: E402


@register(
    "m1_standardize_conts",
    """WITH te AS (SELECT testId, avg(answerCode) AS test_mean FROM train_log GROUP BY testId),
ta AS (SELECT KnowledgeTag, avg(answerCode) AS tag_mean FROM train_log GROUP BY KnowledgeTag),
ai AS (SELECT assessmentItemID, avg(answerCode) AS assessment_mean FROM train_log GROUP BY assessmentItemID),
t AS (SELECT l.event_id, te.test_mean, ai.assessment_mean, ta.tag_mean
      FROM train_log l JOIN te USING (testId) JOIN ta USING (KnowledgeTag) JOIN ai USING (assessmentItemID))
SELECT event_id,
       round((test_mean - avg(test_mean) OVER ()) / stddev_pop(test_mean) OVER (), 6) AS test_mean_z,
       round((assessment_mean - avg(assessment_mean) OVER ()) / stddev_pop(assessment_mean) OVER (), 6)
         AS assessment_mean_z,
       round((tag_mean - avg(tag_mean) OVER ()) / stddev_pop(tag_mean) OVER (), 6) AS tag_mean_z
FROM t""",
)
def q_m1(spark, sf_dir):
    train, _ = _train_test(spark, sf_dir)
    z = model.standardize(keyed.target_encode(train), sequences.CONT_COLS)
    return z.select("event_id", *[F.round(f"{c}_z", 6).alias(f"{c}_z") for c in sequences.CONT_COLS])


def _x1_fn(pdf):
    # A user-supplied scorer: fixed-weight logistic of two encodings.
    return 1.0 / (1.0 + np.exp(-4.0 * (pdf["test_mean"] + pdf["tag_mean"] - 1.0)))


@register(
    "x1_map_in_pandas_scorer",
    """WITH te AS (SELECT testId, avg(answerCode) AS test_mean FROM train_log GROUP BY testId),
ta AS (SELECT KnowledgeTag, avg(answerCode) AS tag_mean FROM train_log GROUP BY KnowledgeTag)
SELECT l.event_id, round(1.0 / (1.0 + exp(-4.0 * (te.test_mean + ta.tag_mean - 1.0))), 9) AS prediction
FROM train_log l JOIN te USING (testId) JOIN ta USING (KnowledgeTag)""",
)
def q_x1(spark, sf_dir):
    train, _ = _train_test(spark, sf_dir)
    rows = keyed.target_encode(train)
    s = model.map_score(rows, _x1_fn, keep=["event_id"], inputs=["test_mean", "tag_mean"])
    return s.select("event_id", rnd("prediction").alias("prediction"))


@register("m2_m3_flagship_submission")
def q_m2_m3(spark, sf_dir):
    return flow.flagship(spark, sf_dir)


@register("m4_cross_validated_auroc")
def q_m4(spark, sf_dir):
    train, _ = _train_test(spark, sf_dir)
    oof = flow.train(train, flow.flow_folder(spark), k=K_FOLDS)
    return metrics.auroc(oof.withColumnRenamed("label", "target"), by=["fold"])


@register("m5_soft_vote_submission")
def q_m5(spark, sf_dir):
    train, test = _train_test(spark, sf_dir)
    path = flow.flow_folder(spark)
    flow.train(train, path, k=K_FOLDS)
    return flow.infer(test, path).select("id", "prediction")


@register("m6_m8_validation_report")
def q_report(spark, sf_dir):
    return flow.validation_report(_train_test(spark, sf_dir)[0])


# The same flow on one binary feature, where the fitted probability has a
# closed form: the label's mean among examples with the same feature value.
BINARY = ("prev_right",)
EXACT = {"features": BINARY, "tol": 1e-12, "max_iter": 200}

_BINARY_SQL = """s AS (SELECT *, concat(substring(assessmentItemID, 1, 3), cast(userID AS varchar)) AS seq_id FROM train_log),
o AS (SELECT seq_id, answerCode AS label,
             CASE WHEN lag(answerCode) OVER (PARTITION BY seq_id ORDER BY "Timestamp", event_id) = 1 THEN 1 ELSE 0 END AS x,
             row_number() OVER (PARTITION BY seq_id ORDER BY "Timestamp" DESC, event_id DESC) AS r FROM s),
ex AS (SELECT seq_id, label, x FROM o WHERE r = 1),
st AS (SELECT *, concat(substring(assessmentItemID, 1, 3), cast(userID AS varchar)) AS seq_id FROM test_log),
kt AS (SELECT * FROM st WHERE seq_id IN (SELECT seq_id FROM st WHERE answerCode = -1)),
ot AS (SELECT userID, CASE WHEN lag(answerCode) OVER (PARTITION BY userID ORDER BY "Timestamp", event_id) = 1 THEN 1 ELSE 0 END AS x,
              row_number() OVER (PARTITION BY userID ORDER BY "Timestamp" DESC, event_id DESC) AS r FROM kt),
tex AS (SELECT row_number() OVER (ORDER BY userID) - 1 AS id, userID, x FROM ot WHERE r = 1)"""
_BINARY_FOLDS_SQL = _BINARY_SQL + """,
f AS (SELECT seq_id, ntile(5) OVER (ORDER BY md5(concat(seq_id, '|', '42')), seq_id) - 1 AS fold FROM ex),
exf AS (SELECT * FROM ex JOIN f USING (seq_id)),
mdl AS (SELECT k.fold, exf.x, avg(exf.label) AS m
        FROM exf CROSS JOIN (SELECT unnest(range(5)) AS fold) k WHERE exf.fold <> k.fold GROUP BY 1, 2)"""


@register(
    "m2_m3_closed_form_submission",
    f"""WITH {_BINARY_SQL},
m AS (SELECT x, avg(label) AS m FROM ex GROUP BY x)
SELECT id, userID, round(m.m, 5) AS prediction FROM tex JOIN m USING (x)""",
)
def q_m2_m3_exact(spark, sf_dir):
    train, test = _train_test(spark, sf_dir)
    path = flow.flow_folder(spark)
    flow.train(train, path, **EXACT)
    return flow.infer(test, path).select("id", "userID", rnd("prediction", 5).alias("prediction"))


@register(
    "m4_closed_form_out_of_fold",
    f"""WITH {_BINARY_FOLDS_SQL}
SELECT cast(exf.fold AS int) AS fold, seq_id, cast(label AS double) AS label, round(m, 5) AS prediction
FROM exf JOIN mdl ON mdl.fold = exf.fold AND mdl.x = exf.x""",
)
def q_m4_exact(spark, sf_dir):
    train, _ = _train_test(spark, sf_dir)
    oof = flow.train(train, flow.flow_folder(spark), k=K_FOLDS, **EXACT)
    return oof.select("fold", "seq_id", "label", rnd("prediction", 5).alias("prediction"))


@register(
    "m5_closed_form_soft_vote",
    f"""WITH {_BINARY_FOLDS_SQL}
SELECT id, userID, round(avg(m), 5) AS prediction FROM tex JOIN mdl USING (x) GROUP BY id, userID""",
)
def q_m5_exact(spark, sf_dir):
    train, test = _train_test(spark, sf_dir)
    path = flow.flow_folder(spark)
    flow.train(train, path, k=K_FOLDS, **EXACT)
    return flow.infer(test, path).select("id", "userID", rnd("prediction", 5).alias("prediction"))


@register(
    "m6_m8_closed_form_report",
    f"""WITH {_BINARY_SQL},
h AS (SELECT *, row_number() OVER (ORDER BY md5(concat(seq_id, '|', '0')), seq_id) AS r, count(*) OVER () AS n FROM ex),
tr AS (SELECT x, avg(label) AS p FROM h WHERE r <= floor(n * 0.7) GROUP BY x),
v AS (SELECT h.label AS y, tr.p FROM h JOIN tr USING (x) WHERE r > floor(n * 0.7)),
a AS (SELECT sum(CASE WHEN i.p > j.p THEN 1.0 WHEN i.p = j.p THEN 0.5 ELSE 0 END) / count(*) AS auc
      FROM v i JOIN v j ON i.y = 1 AND j.y = 0)
SELECT round(a.auc, 5) AS auc, round(avg(CASE WHEN (v.p >= 0.5) = (v.y = 1) THEN 1.0 ELSE 0.0 END), 5) AS acc,
       round(avg(-(v.y * ln(v.p) + (1 - v.y) * ln(1 - v.p))), 5) AS log_loss, count(*) AS n_valid
FROM v CROSS JOIN a GROUP BY a.auc""",
)
def q_report_exact(spark, sf_dir):
    r = flow.validation_report(_train_test(spark, sf_dir)[0], **EXACT)
    return r.select(*[rnd(c, 5).alias(c) for c in ("auc", "acc", "log_loss")], "n_valid")


@register(
    "m2_train_examples",
    _SEQ_SQL
    + """SELECT seq_id, cast(correct[n] AS double) AS label,
       round(CASE WHEN n > 1 THEN cast(list_sum(correct[1:n - 1]) AS double) / (n - 1) END, 9) AS user_acc,
       cast(n - 1 AS double) AS user_total_answer, cast(CASE WHEN n > 1 THEN correct[n - 1] + 1 ELSE 0 END AS double) AS interaction,
       cast(CASE WHEN n > 1 AND correct[n - 1] = 1 THEN 1 ELSE 0 END AS double) AS prev_right
FROM z""",
)
def q_train_examples(spark, sf_dir):
    train, _ = _train_test(spark, sf_dir)
    ex = flow.train_examples(train, flow.fit_encoders(train))
    return ex.select("seq_id", "label", rnd("user_acc").alias("user_acc"), "user_total_answer", "interaction", "prev_right")


@register(
    "m9_best_candidate_submission",
    f"""WITH {_BINARY_SQL},
m AS (SELECT avg(label) AS m FROM ex)
SELECT id, userID, round(m.m, 5) AS prediction FROM tex CROSS JOIN m""",
)
def q_m9_flow(spark, sf_dir):
    """Two candidates without signal tie at AUROC 0.5 or rank by name: one
    reads a constant, so its fitted probability is the label's mean."""
    train, test = _train_test(spark, sf_dir)
    path = flow.flow_folder(spark)
    flow.train(
        train.withColumn("KnowledgeTag", F.lit(1)), path,
        candidates={"a_constant": {"features": ("tag_mean",), "reg": 0.0}, "b_constant": {"features": ("tag_mean",), "reg": 1.0}},
        tol=1e-12, max_iter=200)
    return flow.infer(test.withColumn("KnowledgeTag", F.lit(1)), path).select("id", "userID", rnd("prediction", 5).alias("prediction"))


def _g7_sql(windows_sql: str, key: str) -> str:
    """Model-input rows of windows over the coded training sequences;
    ``windows_sql`` gives ``wins(seq_id, key, start, size)`` from ``u``."""
    return (
        _SEQ_SQL.split("k AS (SELECT * FROM")[0]
        + f"""r AS (SELECT seq_id, q, te, tg, answerCode AS y,
             row_number() OVER (PARTITION BY seq_id ORDER BY "Timestamp", event_id) - 1 AS p,
             count(*) OVER (PARTITION BY seq_id) AS L FROM c),
u AS (SELECT DISTINCT seq_id, L FROM r),
{windows_sql},
s AS (SELECT wins.seq_id, wins.{key}, count(*) AS n, list(te + 1 ORDER BY p) AS test, list(q + 1 ORDER BY p) AS question,
             list(tg + 1 ORDER BY p) AS tag, list(y ORDER BY p) AS correct
      FROM wins JOIN r ON r.seq_id = wins.seq_id AND r.p >= wins.start AND r.p < wins.start + 6 GROUP BY 1, 2),
z AS (SELECT *, list_transform(range(6 - n), lambda x: 0) AS pad FROM s)
SELECT seq_id, cast({key} AS bigint) AS {key},
  array_to_string(list_concat(pad, test), ',') AS test,
  array_to_string(list_concat(pad, question), ',') AS question,
  array_to_string(list_concat(pad, tag), ',') AS tag,
  array_to_string(list_concat(pad, correct), ',') AS correct,
  array_to_string(list_concat(pad, list_transform(range(n), lambda x: 1)), ',') AS mask,
  array_to_string(list_concat(pad, list_concat([0], list_transform(correct[1:n - 1], lambda x: x + 1))), ',') AS interaction,
  cast(n - 1 AS int) AS gather_index
FROM z"""
    )


def _g7_rows(spark, sf_dir, kind, key, **kw):
    train, _ = _train_test(spark, sf_dir)
    enc, voc = flow.fit_encoders(train)
    mi = flow.augmented_input(train.withColumn("seq_id", S.grade_split_id()), enc, voc, "seq_id", 6, kind, **kw)
    return mi.select(
        "seq_id", F.col(key).cast("bigint").alias(key),
        *[_ints(c).alias(c) for c in ("test", "question", "tag", "correct", "mask", "interaction")], "gather_index")


@register(
    "g7_slide_model_input",
    _g7_sql(
        """v6 AS (SELECT *, CASE WHEN L > 6 THEN (L - 6) // 4 + 1 ELSE 1 END AS T FROM u),
wins AS (SELECT seq_id, "window", CASE WHEN L > 6 THEN "window" * 4 ELSE 0 END AS start
         FROM (SELECT *, unnest(range(T)) AS "window" FROM v6)
         UNION ALL SELECT seq_id, T, L - 6 FROM v6 WHERE L > 6 AND L <> 6 + 4 * (T - 1))""",
        '"window"',
    ),
)
def q_g7_slide(spark, sf_dir):
    return _g7_rows(spark, sf_dir, "slide", "window", stride=4)


@register(
    "g7_crop_model_input",
    _g7_sql("wins AS (SELECT seq_id, unnest(range(0, L, 6)) AS start FROM u)", "start"),
)
def q_g7_crop(spark, sf_dir):
    return _g7_rows(spark, sf_dir, "crop", "start", crop_type="tiled")


# ---------------------------------------------------------------- S1, S2, S4-S6: through files

from ..sources import io as log_io  # noqa: E402


@register("s1_parquet_reader", "SELECT * FROM interactions")
def q_s1_reader(spark, sf_dir):
    """The log written as Parquet with doubles for answers, read typed."""
    path = flow.flow_folder(spark)
    _log(spark, sf_dir).withColumn("answerCode", F.col("answerCode").cast("double")).write.parquet(path)
    return log_io.read_interactions_parquet(spark, path)


@register(
    "s2_csv_reader",
    """SELECT event_id, userID, date_trunc('second', "Timestamp") AS "Timestamp", assessmentItemID, testId, KnowledgeTag, answerCode
FROM interactions""",
)
def q_s2_reader(spark, sf_dir):
    """The log written as CSV (whole seconds) with its tie-breaker, read back."""
    path = flow.flow_folder(spark)
    cols = [f.name for f in log_io.CSV_SCHEMA.fields]
    (
        _log(spark, sf_dir).select(*cols, "event_id").write.option("header", True)
        .option("timestampNTZFormat", log_io.TIMESTAMP_FORMAT).csv(path)
    )
    return log_io.read_interactions_csv(spark, path, tie="event_id")


@register("s4_s5_vocabulary_saved_and_loaded", "WITH " + _VOCAB_SQL.format(src="train_log") + "\nSELECT * FROM v")
def q_s4_s5(spark, sf_dir):
    train, _ = _train_test(spark, sf_dir)
    path = flow.flow_folder(spark)
    vocab.save_vocabulary(vocab.fit_vocabulary(train), path)
    return vocab.load_vocabulary(spark, path)


@register(
    "s6_predictions_file",
    f"""WITH {_BINARY_SQL},
m AS (SELECT x, avg(label) AS m FROM ex GROUP BY x)
SELECT id, round(m.m, 5) AS prediction FROM tex JOIN m USING (x)""",
)
def q_s6(spark, sf_dir):
    """The submission written as ``id,prediction`` and read back."""
    train, test = _train_test(spark, sf_dir)
    path = flow.flow_folder(spark)
    flow.train(train, path, **EXACT)
    log_io.write_predictions(flow.infer(test, path), f"{path}/submission")
    back = spark.read.schema("id bigint, prediction double").option("header", True).csv(f"{path}/submission")
    return back.select("id", rnd("prediction", 5).alias("prediction"))


def _features_sql() -> str:
    stat_cte, stat_join, stat_cols = [], [], []
    for i, (name, (keys, agg)) in enumerate(keyed.FEATURE_STATS.items()):
        fn = "count(answerCode)" if agg == "count" else "avg(answerCode)"
        kc = ", ".join(keys)
        stat_cte.append(f"s{i} AS (SELECT {kc}, {fn} AS v FROM fb GROUP BY {kc})")
        on = " AND ".join(f"b.{k} = s{i}.{k}" for k in keys)
        stat_join.append(f"LEFT JOIN s{i} ON {on}")
        stat_cols.append(f"s{i}.v AS {name}" if agg == "count" else f"round(s{i}.v, 9) AS {name}")
    enc = []
    for nm, expr, period in (
        ("hour", 'hour(b."Timestamp")', 24),
        ("dow", '(isodow(b."Timestamp") - 1)', 7),
        ("dom", 'day(b."Timestamp")', 31),
        ("month", 'month(b."Timestamp")', 12),
    ):
        enc.append(f"round(sin(2 * pi() * {expr} / {period}), 9) + 0.0 AS {nm}_sin")
        enc.append(f"round(cos(2 * pi() * {expr} / {period}), 9) + 0.0 AS {nm}_cos")
    return f"""WITH base AS (SELECT *, cast(substring(testId, 3, 1) AS int) AS grade,
       CASE WHEN floor(cast(substring(testId, 3, 1) AS int) / 7) = 0 THEN 'elementary_school'
            ELSE 'middle_school' END AS school FROM interactions),
f AS (SELECT userID, school, grade, "Timestamp", event_id FROM
        (SELECT *, row_number() OVER (PARTITION BY userID, school, grade ORDER BY "Timestamp", event_id) AS r FROM base)
      WHERE r = 1),
fk AS (SELECT userID, school, grade,
             concat(cast(userID AS varchar), '-',
                    cast(row_number() OVER (PARTITION BY userID ORDER BY "Timestamp", event_id) AS varchar))
             AS familyUserID FROM f),
fb AS (SELECT b.event_id, fk.familyUserID AS userID, b.userID AS familyID, b."Timestamp", b.assessmentItemID,
              b.testId, b.KnowledgeTag, b.answerCode, b.school, b.grade
       FROM base b JOIN fk ON b.userID = fk.userID AND b.school = fk.school AND b.grade = fk.grade),
w AS (SELECT event_id,
       (epoch_us(lead("Timestamp") OVER uw) - epoch_us("Timestamp")) // 1000000 % 86400 AS secs,
       avg(answerCode) OVER (uw ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cm,
       avg(answerCode) OVER (uw ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS rk
      FROM fb WINDOW uw AS (PARTITION BY userID ORDER BY "Timestamp", event_id)),
o AS (SELECT event_id, row_number() OVER (ORDER BY userID, "Timestamp", event_id) - 1 AS original_order
      FROM interactions),
st AS (SELECT userID, min("Timestamp") AS start FROM fb GROUP BY userID),
g AS (SELECT min("Timestamp") AS first FROM interactions),
{", ".join(stat_cte)}
SELECT b.event_id, b.userID, b.familyID, b.assessmentItemID, b.testId, b.KnowledgeTag, b.answerCode,
       cast(CASE WHEN w.secs < 80 THEN w.secs END AS bigint) AS time_diff,
       round(w.cm, 9) AS userID_acc_cummean, round(w.rk, 9) AS userID_acc_mean_recentK,
       {", ".join(enc)},
       b.school, b.grade,
       {", ".join(stat_cols)},
       cast(floor((epoch_us(st.start) - epoch_us(g.first)) / 86400000000.0) AS int) AS user_enterDay,
       cast(floor((epoch_us(b."Timestamp") - epoch_us(st.start)) / 86400000000.0) AS int) AS user_day_progress,
       o.original_order
FROM fb b JOIN w ON b.event_id = w.event_id JOIN o ON b.event_id = o.event_id
JOIN st ON b.userID = st.userID CROSS JOIN g
{" ".join(stat_join)}"""


# The reference's feature library runs in family mode: ``userID`` is the
# family id of W7 and every learner feature is per (learner, school, grade).
@register("features_all_columns", _features_sql())
def q_features(spark, sf_dir, scan_kw=None):
    ft = feature_plan.feature_table(_log(spark, sf_dir), scan_kw=scan_kw)
    enc = []
    for src, dst in (
        ("encoded_hour", "hour"),
        ("encoded_dayoftheweek", "dow"),
        ("encoded_dayofthemonth", "dom"),
        ("encoded_month", "month"),
    ):
        enc += [rnd(F.col(src).sin).alias(f"{dst}_sin"), rnd(F.col(src).cos).alias(f"{dst}_cos")]
    stats = [
        F.col(n) if agg == "count" else rnd(n).alias(n) for n, (_, agg) in keyed.FEATURE_STATS.items()
    ]
    return ft.select(
        "event_id", "userID", "familyID", "assessmentItemID", "testId", "KnowledgeTag", "answerCode", "time_diff",
        rnd("userID_acc_cummean").alias("userID_acc_cummean"),
        rnd("userID_acc_mean_recentK").alias("userID_acc_mean_recentK"),
        *enc, "school", "grade", *stats,
        "user_enterDay", "user_day_progress", "original_order",
    )


# ---------------------------------------------------------------- inference-side model input

_SEQ_TEST_SQL = (
    "WITH t AS (SELECT *, concat(substring(assessmentItemID, 1, 3), cast(userID AS varchar)) AS seq_id "
    "FROM test_log),\n"
    "kept AS (SELECT * FROM t WHERE seq_id IN (SELECT seq_id FROM t WHERE answerCode = -1)),\n"
    + _VOCAB_SQL.format(src="train_log")
    + """,
c AS (SELECT kept.*, coalesce(vi.code, ui.code) AS q, coalesce(vt.code, ut.code) AS te, coalesce(vg.code, ug.code) AS tg
      FROM kept
      LEFT JOIN v vi ON vi."column" = 'assessmentItemID' AND vi.label = kept.assessmentItemID
      LEFT JOIN v vt ON vt."column" = 'testId' AND vt.label = kept.testId
      LEFT JOIN v vg ON vg."column" = 'KnowledgeTag' AND vg.label = cast(kept.KnowledgeTag AS varchar)
      CROSS JOIN (SELECT code FROM v WHERE "column" = 'assessmentItemID' AND label = 'unknown') ui
      CROSS JOIN (SELECT code FROM v WHERE "column" = 'testId' AND label = 'unknown') ut
      CROSS JOIN (SELECT code FROM v WHERE "column" = 'KnowledgeTag' AND label = 'unknown') ug),
k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY userID ORDER BY "Timestamp" DESC, event_id DESC) AS r
                     FROM c) WHERE r <= 20),
s AS (SELECT userID, count(*) AS n,
             list(te + 1 ORDER BY "Timestamp", event_id) AS test,
             list(q + 1 ORDER BY "Timestamp", event_id) AS question,
             list(tg + 1 ORDER BY "Timestamp", event_id) AS tag,
             list(answerCode ORDER BY "Timestamp", event_id) AS correct
      FROM k GROUP BY userID),
z AS (SELECT *, list_transform(range(20 - n), lambda x: 0) AS pad FROM s)
SELECT userID,
  array_to_string(list_concat(pad, test), ',') AS test,
  array_to_string(list_concat(pad, question), ',') AS question,
  array_to_string(list_concat(pad, tag), ',') AS tag,
  array_to_string(list_concat(pad, correct), ',') AS correct,
  array_to_string(list_concat(pad, list_transform(range(n), lambda x: 1)), ',') AS mask,
  array_to_string(list_concat(pad, list_concat([0], list_transform(correct[1:n - 1], lambda x: x + 1))), ',')
    AS interaction,
  cast(n - 1 AS int) AS gather_index
FROM z"""
)


@register("y1_y7_model_input_test", _SEQ_TEST_SQL)
def q_y1_y7_test(spark, sf_dir):
    """Test mode (Q7): rows of the target's grade only (J3), vocabulary and
    encodings fitted on the training log, one sequence per learner; the -1
    target sits at the last position and never reaches ``interaction``."""
    train, test = _train_test(spark, sf_dir)
    enc, voc = flow.fit_encoders(train)
    t = test.withColumn("seq_id", S.grade_split_id())
    t = keyed.keep_target_groups(t, ["seq_id"]).drop("seq_id")
    mi = flow.model_input_table(t, enc, voc, "userID", N_SEQ)
    return mi.select(
        "userID",
        *[_ints(c).alias(c) for c in ("test", "question", "tag", "correct", "mask", "interaction")],
        "gather_index",
    )


@register(
    "w1_time_diff_total_seconds",
    f"""WITH g AS (SELECT event_id, userID,
       (epoch_us(lead("Timestamp") {_W})) - epoch_us("Timestamp")) // 1000000 AS secs
FROM interactions)
SELECT event_id, userID, cast(CASE WHEN secs < 3600 THEN secs END AS bigint) AS time_diff FROM g""",
)
def q_w1_total(spark, sf_dir):
    df = windows.add_time_diff(_log(spark, sf_dir), outlier_thres=3600, mode="total")
    return df.select("event_id", "userID", "time_diff")


@register(
    "o2_last_position_train",
    _SEQ_SQL
    + """SELECT seq_id, cast(question[n] AS int) AS last_question, cast(correct[n] AS int) AS last_correct,
       cast(CASE WHEN n > 1 THEN correct[n - 1] + 1 ELSE 0 END AS int) AS last_interaction
FROM z""",
)
def q_o2(spark, sf_dir):
    t = prepared_train(spark, sf_dir)
    mi = sequences.model_input(sequences.collect_sequences(t, seq="seq_id", max_len=N_SEQ, is_cut=True), N_SEQ)
    return mi.select(
        "seq_id",
        sequences.last_position("question").cast("int").alias("last_question"),
        sequences.last_position("correct").cast("int").alias("last_correct"),
        sequences.last_position("interaction").cast("int").alias("last_interaction"),
    )


# ---------------------------------------------------------------- hot-learner path under the oracle
# The same operators with the split threshold lowered so that every learner
# above 30 rows takes the bucketed path (range-partitioned buckets of about
# 11 rows); results must equal the plain path's oracle.

_SPLIT = {"hot_rows": 30, "bucket_rows": 11}


def answers(spark, sf_dir):
    """The log's columns that an ordered scan works on.  The split path writes
    whole rows, so columns that a query does not return are left out before."""
    return _log(spark, sf_dir).select("event_id", "userID", "Timestamp", "answerCode")


@register("w1_time_diff_split_learners")
def q_w1_split(spark, sf_dir):
    df = windows.add_time_diff(_log(spark, sf_dir), outlier_thres=80, **_SPLIT)
    return df.select("event_id", "userID", "time_diff")


@register("w3_recent_mean_k50_split_learners")
def q_w3_split(spark, sf_dir):
    df = windows.add_recent_mean(answers(spark, sf_dir), k=50, **_SPLIT)
    return df.select("event_id", "userID", rnd("userID_acc_mean_recentK").alias("userID_acc_mean_recentK"))


@register("w4_w6_prior_stats_split_learners")
def q_w4_split(spark, sf_dir):
    df = windows.add_prior_stats(answers(spark, sf_dir), **_SPLIT)
    return df.select(
        "event_id", "userID", "user_correct_answer", "user_total_answer", rnd("user_acc").alias("user_acc")
    )


@register("g1_g2_sliding_windows_split_learners")
def q_g1_split(spark, sf_dir):
    return _g_out(augment.sliding_windows(_log(spark, sf_dir), n=20, stride=7, scan_kw=_SPLIT))


for _split, _plain in (
    ("w1_time_diff_split_learners", "w1_time_diff"),
    ("w3_recent_mean_k50_split_learners", "w3_recent_mean_k50"),
    ("w4_w6_prior_stats_split_learners", "w4_w6_prior_stats"),
    ("g1_g2_sliding_windows_split_learners", "g1_g2_sliding_windows_n20_s7"),
):
    ORACLE[_split] = ORACLE[_plain]


@register(
    "y3_y4_padded_sequences_train",
    _SEQ_SQL
    + """SELECT seq_id,
  array_to_string(list_concat(pad, list_transform(test, lambda x: x - 1)), ',') AS test,
  array_to_string(list_concat(pad, list_transform(question, lambda x: x - 1)), ',') AS question,
  array_to_string(list_concat(pad, list_transform(tag, lambda x: x - 1)), ',') AS tag,
  array_to_string(list_concat(pad, correct), ',') AS correct,
  array_to_string(list_concat(pad, list_transform(range(n), lambda x: 1)), ',') AS mask
FROM z""",
)
def q_y3_y4(spark, sf_dir):
    """Padded sequence form (Y3, Y4): unshifted codes left-padded with 0 and
    a ``tinyint`` validity mask."""
    t = prepared_train(spark, sf_dir)
    p = sequences.pad_sequences(sequences.collect_sequences(t, seq="seq_id", max_len=N_SEQ, is_cut=True), N_SEQ)
    return p.select("seq_id", *[_ints(c).alias(c) for c in ("test", "question", "tag", "correct", "mask")])


@register("features_all_columns_split_learners")
def q_features_split(spark, sf_dir):
    return q_features(spark, sf_dir, scan_kw=_SPLIT)


ORACLE["features_all_columns_split_learners"] = ORACLE["features_all_columns"]


@register(
    "m2_last_position_examples_rows",
    """WITH t AS (SELECT *, concat(substring(assessmentItemID, 1, 3), cast(userID AS varchar)) AS seq_id
              FROM train_log),
te AS (SELECT testId, avg(answerCode) AS m FROM t GROUP BY testId),
ta AS (SELECT KnowledgeTag, avg(answerCode) AS m FROM t GROUP BY KnowledgeTag),
ai AS (SELECT assessmentItemID, avg(answerCode) AS m FROM t GROUP BY assessmentItemID),
h AS (SELECT t.*,
        row_number() OVER (PARTITION BY seq_id ORDER BY "Timestamp" DESC, event_id DESC) AS r_desc,
        sum(answerCode) OVER (PARTITION BY seq_id ORDER BY "Timestamp", event_id
                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior_sum,
        row_number() OVER (PARTITION BY seq_id ORDER BY "Timestamp", event_id) - 1 AS prior_cnt,
        lag(answerCode) OVER (PARTITION BY seq_id ORDER BY "Timestamp", event_id) AS prev
      FROM t)
SELECT h.seq_id, h.event_id, round(te.m, 9) AS test_mean, round(ai.m, 9) AS assessment_mean,
       round(ta.m, 9) AS tag_mean,
       round(CASE WHEN prior_cnt > 0 THEN coalesce(prior_sum, 0) / prior_cnt END, 9) AS user_acc,
       cast(prior_cnt AS double) AS user_total_answer, cast(coalesce(prev + 1, 0) AS double) AS interaction,
       cast(answerCode AS double) AS label
FROM h JOIN te USING (testId) JOIN ta USING (KnowledgeTag) JOIN ai USING (assessmentItemID)
WHERE r_desc = 1""",
)
def q_m2_rows(spark, sf_dir):
    """Row-form training examples (M2 input): the last row of each training
    sequence with its history features over the whole history."""
    train, _ = _train_test(spark, sf_dir)
    ex = model.last_position_rows(train.withColumn("seq_id", S.grade_split_id()), seq="seq_id")
    return ex.select(
        "seq_id", "event_id",
        *[rnd(c).alias(c) for c in ("test_mean", "assessment_mean", "tag_mean", "user_acc")],
        "user_total_answer", "interaction", "label",
    )
