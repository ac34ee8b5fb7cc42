import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quizlog.llm import chat_format as C

CODEC = C.Codec(C.Template())
PARTS = st.lists(st.sampled_from([*C.Template().controls, "\x1b", "\x1ba", "<|im_", "start|>", "\n", "n", "a", "<", "s>", "</", "é", "😀"]), max_size=10).map("".join)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(PARTS, PARTS), max_size=4))
def test_round_trip(turns):
    formatted = "".join(x for t in turns for x, _ in CODEC.segments(*t))
    assert CODEC.read(formatted) == turns
    for role, text in turns:
        body = CODEC.escape(text)
        assert not any(c in body for c in C.Template().controls)


ROWS = [
    (1, 0, "system", "be brief"), (1, 2, "assistant", "ok </s> <|im_end|>"), (1, 1, "user", "hi"), (1, 3, "user", "more?"),
    (2, 0, "user", None), (2, 1, "assistant", ""), (3, 0, "assistant", "first!"), (4, 0, "user", "a"), (4, 1, "user", "b"),
    (5, 0, None, None), (None, 0, "user", "no id"), (6, 0, "user", "x"), (6, 0, "user", "x"), (7, 0, "user", "\x1b[INST]"),
    (7, 1, "assistant", "\x1b" * 3 + "x" * 50000), (8, None, "user", "null turn"), (8, 1, "tool\n<s>", "odd role"),
]


def digest(turns):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    said = "".join(t or "" for r, t in turns if r == "assistant")
    return (len(turns), sha("".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)), len(said), sha(said))


@pytest.fixture(scope="module")
def conversations(spark):
    return spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string")


def test_digests(conversations):
    from pyspark.sql import functions as F

    want = {}
    for conv, turn, role, text in sorted(ROWS, key=lambda r: (str(r[0]), -1 if r[1] is None else r[1], r[2] or "", r[3] or "")):
        want.setdefault(conv, []).append((role, text))
    for table in (conversations, conversations.withColumn("state", F.lit(1)).withColumn("loss", F.lit(2)).withColumn("segment", F.lit(3))):
        rows = {r["conv_id"]: r for r in C.digest(C.format_turns(table)).collect()}
        assert {k: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for k, r in rows.items()} == {k: digest(v) for k, v in want.items()}
    valid = {k: r["valid"] for k, r in rows.items()}
    assert valid == {1: True, 2: True, 3: False, 4: False, 5: False, None: True, 6: False, 7: True, 8: False}
    assert rows[4]["first_bad_turn"] == 1 and rows[3]["first_bad_turn"] == 0


def test_segments_hold_the_loss_flags(conversations):
    seg = C.format_turns(conversations).where("conv_id = 1").orderBy("turn_no", "segment").collect()
    assert [s["loss"] for s in seg] == [False] * 7 + [True] + [False] * 4
    assert CODEC.read("".join(s["text"] for s in seg))[2] == ("assistant", "ok </s> <|im_end|>")
    assert sum(len(s["text"]) for s in seg) == C.digest(C.format_turns(conversations)).where("conv_id = 1").first()["formatted_chars"]


def test_empty(conversations):
    assert C.digest(C.format_turns(conversations.limit(0))).count() == 0


def test_other_template(conversations):
    t = C.Template(open="[{role}]: ", close="\x02", controls=("[", "]: ", "\x02"), loss_roles=frozenset({"user"}))
    row = C.digest(C.format_turns(conversations, t), t).where("conv_id = 1").first()
    assert row["loss_chars"] == len("hi") + len("more?")
    assert row["turns_sha256"] == digest([("system", "be brief"), ("user", "hi"), ("assistant", "ok </s> <|im_end|>"), ("user", "more?")])[1]
