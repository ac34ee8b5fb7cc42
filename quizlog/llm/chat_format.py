"""Chat formatting by a finite-state machine over roles (operator 5).

A template is data: the control strings, how a turn opens and closes, which
roles' text carries loss, and the transitions of the turn-order machine.
``format_turns`` emits text segments, three a turn (opening mark, text,
closing mark), each with its loss flag; a conversation is its segments one
after another.  Texts are escaped so that no control string of the template
can appear inside them, and ``read_turns`` recovers every turn from the
formatted text alone.

Escaping: ``ESCAPE`` itself and every control string inside a text become
``ESCAPE`` and one letter of the template's code table; letters start no
control string, so no new one can arise.

Turns are dealt by conversation, sorted inside the partition and streamed,
so a conversation of any length is never held in memory; the state kept is
the machine's and two running digests.

Defined results: null texts and roles count as empty; equal turn numbers are
ordered by role, then text, and both kept; a null conversation id is one
conversation of its own.  Conversations that break the turn order are
formatted all the same and marked ``valid`` false with the first bad turn's
number in ``first_bad_turn`` (from 0).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quizlog.llm.shared import batches, table

ESCAPE = "\x1b"


@dataclass(frozen=True)
class Template:
    """Declarative chat template.  ``open`` holds ``{role}`` once."""

    open: str = "<|im_start|>{role}\n"
    close: str = "<|im_end|>\n"
    controls: tuple[str, ...] = (
        "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
    )
    loss_roles: frozenset[str] = frozenset({"assistant"})
    start: str = "start"
    #: state -> {role: next state}
    order: dict[str, dict[str, str]] = field(default_factory=lambda: {
        "start": {"system": "primed", "user": "asked"},
        "primed": {"user": "asked"},
        "asked": {"assistant": "answered"},
        "answered": {"user": "asked", "tool": "asked"},
    })
    ends: frozenset[str] = frozenset({"answered", "asked"})

    def codes(self) -> dict[str, str]:
        """Escape letter of each control string, of ESCAPE, and of the line
        break that ends a role."""
        letters = "abcdefghijklmnopqrstuvwxyz"
        return {c: letters[i] for i, c in enumerate([ESCAPE, *self.controls])}


class Codec:
    def __init__(self, t: Template):
        self.t = t
        self.code = t.codes()
        self.back = {v: k for k, v in self.code.items()} | {"n": "\n"}
        if "n" in self.code.values():
            raise ValueError("a template may have twelve control strings at most")
        # the longest first, so "</s>" is not read as part of another
        alternatives = sorted(self.code, key=len, reverse=True)
        self.find = re.compile("|".join(map(re.escape, alternatives)))
        self.unfind = re.compile(re.escape(ESCAPE) + "(.)", re.S)
        head, tail = t.open.split("{role}")
        self.turn = re.compile(re.escape(head) + "(.*?)" + re.escape(tail) + "(.*?)" + re.escape(t.close), re.S)

    def escape(self, text: str) -> str:
        return self.find.sub(lambda m: ESCAPE + self.code[m.group(0)], text)

    def escape_role(self, role: str) -> str:
        return self.escape(role).replace("\n", ESCAPE + "n")

    def unescape(self, text: str) -> str:
        return self.unfind.sub(lambda m: self.back[m.group(1)], text)

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        """(text, loss) segments of one turn."""
        return [(self.t.open.replace("{role}", self.escape_role(role)), False),
                (self.escape(text), role in self.t.loss_roles), (self.t.close, False)]

    def read(self, formatted: str) -> list[tuple[str, str]]:
        """(role, text) of every turn in a formatted text."""
        out, at = [], 0
        while at < len(formatted):
            m = self.turn.match(formatted, at)
            if not m:
                raise ValueError(f"no turn at {at}")
            out.append((self.unescape(m.group(1)), self.unescape(m.group(2))))
            at = m.end()
        return out


SEGMENT = "conv_id long, turn_no long, segment int, text string, loss boolean, state string, valid boolean"


def format_turns(conversations: DataFrame, template: Template | None = None) -> DataFrame:
    """Segments in order inside each partition: columns of ``SEGMENT``.
    ``state`` is the machine's state after the turn ('broken' once a role
    was not allowed), ``valid`` whether all turns so far were."""
    t = template or Template()
    codec = Codec(t)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, n, seen = None, t.start, 0, False
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for c, role, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                role, text = role or "", text or ""
                if not seen or c != conv:
                    conv, state, n, seen = c, t.start, 0, True
                state = t.order.get(state, {}).get(role, "broken")
                for k, (piece, loss) in enumerate(codec.segments(role, text)):
                    for col, v in zip(out, (c, n, k, piece, loss, state, state != "broken")):
                        col.append(v)
                n += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(out, (pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.bool_(), pa.string(), pa.bool_()))],
                [c.split()[0] for c in SEGMENT.split(", ")])

    turns = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "role", "text", "turn")
    # rows of one conversation side by side and in order, streamed by the task
    dealt = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.select("conv_id", "role", "text").transform(batches, run, SEGMENT)


DIGEST = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
          "valid boolean, first_bad_turn long")


def digest(segments: DataFrame, template: Template | None = None) -> DataFrame:
    """One row per conversation, read back from the formatted segments (in
    the order ``format_turns`` gives them)."""
    t = template or Template()
    codec = Codec(t)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, seen, pending, loss_text = None, False, [], []
        state: dict = {}
        rows: list[tuple] = []

        def fresh() -> None:
            state.update(n=0, turns=hashlib.sha256(), loss=hashlib.sha256(), loss_chars=0, chars=0, bad=None, end=t.start)

        def close() -> None:
            ok = state["bad"] is None and state["end"] in t.ends
            rows.append((conv, state["n"], state["turns"].hexdigest(), state["loss_chars"], state["loss"].hexdigest(),
                         state["chars"], ok, state["bad"]))

        def emit() -> pa.RecordBatch:
            types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_(), pa.int64())
            cols = list(zip(*rows)) or [()] * len(types)
            got = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, types)], [c.split()[0] for c in DIGEST.split(", ")])
            rows.clear()
            return got

        for batch in batches:
            for c, no, k, text, loss, at, valid in zip(*(batch.column(i).to_pylist() for i in range(7))):
                if not seen or c != conv:
                    if seen:
                        close()
                    conv, seen = c, True
                    fresh()
                state["chars"] += len(text)
                if loss:
                    plain = codec.unescape(text)
                    state["loss"].update(plain.encode("utf-8", "surrogatepass"))
                    state["loss_chars"] += len(plain)
                # the formatted text is read turn by turn, as soon as a closing mark has come
                pending.append(text)
                if text == t.close:
                    for role, plain in codec.read("".join(pending)):
                        state["turns"].update(f"{role}\n{plain}\n".encode("utf-8", "surrogatepass"))
                        state["n"] += 1
                    pending.clear()
                state["end"] = at
                if not valid and state["bad"] is None:
                    state["bad"] = no
            if len(rows) > 10_000:
                yield emit()
        if seen:
            close()
        yield emit()

    return segments.transform(batches, run, DIGEST)


# Fixed rows of the contract: a conversation whose texts hold control strings.
PROBE = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame(PROBE, "conv_id long, turn long, role string, text string")
    return digest(format_turns(given.unionByName(probe)))
