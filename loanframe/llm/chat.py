"""Chat formatting (operator 12).

A :class:`Template` declares how a conversation is written: for each role the markers
around a turn, whether its text is learned from, and after which roles it may stand.
From it a finite-state machine follows (:meth:`Template.machine`) whose state is the role
of the last turn, or ``broken`` from the first turn that may not stand where it does.

:func:`format_turns` lets the machine's states emit, turn by turn, the text segments and
their loss flags; markers and text are segments of their own.  :func:`check_order` runs
the machine over every conversation.

Control strings, the template's markers without blanks, are made harmless inside texts
and reversibly so: wherever one begins, an escape character follows its first character,
and escape characters are doubled.  A template in which text and marker could together
form a control string is refused.  :func:`read_turns` reads a formatted conversation back.

What is shuffled: nothing for the segments (each turn is written where it is read; its
place is its key).  The order check shuffles (conversation, turn, role) into ranges, in
which a conversation of any length lies spread over tasks: each range gives the machine's
map from every state it may be entered in to the state it is left in, and the maps of a
conversation's few ranges are composed.

Defined cases: a null text is empty; turns go by ``turn``, null first, then role and
text as written.  Roles that the template does not name (null is the role ``''``) are written with
their name, escaped, between markers of their own, without loss, and break the order.
A conversation that breaks the order is formatted all the same and marked ``valid =
false``, with the place of its first wrong turn; one that ends with a turn that needs an
answer is valid and ``complete = false``.  A null conversation id is one conversation.
Repeated rows are turns each.  Columns named like the outputs are replaced.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, StringType, StructField, StructType

from .bpe import _in_pieces
from .common import column, partitions, ship_package, stored, with_fields

SEGMENTS = ArrayType(StructType([StructField("text", StringType()), StructField("loss", BooleanType())]))


@dataclass(frozen=True)
class Turn:
    """How a role's turns are written, and where they may stand."""

    role: str
    opening: str
    closing: str
    after: tuple[str, ...]  # roles; "" is the beginning
    loss: bool = False
    may_end: bool = True


@dataclass(frozen=True)
class Template:
    turns: tuple[Turn, ...]
    #: Markers around the role and after the text of a turn whose role is not named.
    other: tuple[str, str, str] = ("[TURN]", "[/TURN] ", "[END]")
    escape: str = "\\"

    def __post_init__(self):
        if len({t.role for t in self.turns}) < len(self.turns) or any(t.role == "" for t in self.turns):
            raise ValueError("every role needs one name of its own")
        openings = [t.opening for t in self.turns] + [self.other[0]]
        if any(a != b and a.startswith(b) for a in openings for b in openings) or len(set(openings)) < len(openings):
            raise ValueError("no opening may begin another one")
        for c in self.controls:
            if self.escape in c or len(c) < 2:
                raise ValueError(f"a control string cannot be escaped: {c!r}")
            for k in range(1, len(c)):
                before = [t.opening for t in self.turns] + list(self.other[:2])
                after = [t.closing for t in self.turns] + list(self.other[1:])
                if any(m.endswith(c[:k]) for m in before) or any(
                    m.startswith(c[k:]) or c[k:].startswith(m) for m in after
                ):
                    raise ValueError(f"text and marker may form {c!r}")

    @cached_property
    def controls(self) -> tuple[str, ...]:
        """What must not occur in a text."""
        markers = [m for t in self.turns for m in (t.opening, t.closing)] + list(self.other)
        return tuple(sorted({m.strip() for m in markers if m.strip()}))

    @cached_property
    def _begins(self) -> re.Pattern:
        return re.compile(f"{re.escape(self.escape)}|(?=(?:{'|'.join(map(re.escape, self.controls))}))(.)", re.S)

    @cached_property
    def _escaped(self) -> re.Pattern:
        return re.compile(re.escape(self.escape) + "(.)", re.S)

    @cached_property
    def by_role(self) -> dict[str, Turn]:
        return {t.role: t for t in self.turns}

    def escaped(self, text: str) -> str:
        return self._begins.sub(lambda m: (m.group(1) or self.escape) + self.escape, text)

    def unescaped(self, text: str) -> str:
        return self._escaped.sub(r"\1", text)

    def machine(self) -> tuple[list[str], dict[str, list[int]]]:
        """States, and for each role the state that follows each.  The first state is the
        beginning, the last one ``broken``."""
        states = [""] + [t.role for t in self.turns] + ["broken"]
        broken = len(states) - 1
        return states, {
            t.role: [i + 1 if s in t.after and j < broken else broken for j, s in enumerate(states)]
            for i, t in enumerate(self.turns)
        }

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        """What the state entered by ``role`` emits."""
        t = self.by_role.get(role)
        if t is None:
            begin, middle, end = self.other
            return [(begin + self.escaped(role) + middle, False), (self.escaped(text), False), (end, False)]
        return [(t.opening, False), (self.escaped(text), t.loss), (t.closing, False)]


#: The template of the registered query.
INSTRUCT = Template(
    (
        Turn("system", "<<SYS>>\n", "\n<</SYS>>\n\n", ("",), may_end=False),
        Turn("user", "[INST] ", " [/INST]", ("", "system", "assistant"), may_end=False),
        Turn("assistant", "<s> ", " </s>", ("user",), loss=True),
    )
)


def format_turns(
    conversations: DataFrame, template: Template = INSTRUCT, role: str = "role", text: str = "text"
) -> DataFrame:
    """``conversations`` with ``segments``: of each turn the texts in order, each with its
    loss flag.  All columns but ``text`` are kept; no shuffle."""
    ship_package(conversations.sparkSession)
    kept = with_fields(conversations, StructField("segments", SEGMENTS))
    schema = StructType([f for f in kept.fields if f.name != text])
    columns = [f.name for f in schema.fields[:-1]]
    rows = conversations.select(
        *[column(c) for c in columns], column(role).cast("string").alias("role "), column(text).cast("string").alias("text ")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("text", pa.string()), ("loss", pa.bool_())]))
        for batch in _in_pieces(batches, "text "):
            roles, texts = (batch.column(batch.num_columns - k).to_pylist() for k in (2, 1))
            found = [
                [{"text": t, "loss": loss} for t, loss in template.segments(r or "", x or "")]
                for r, x in zip(roles, texts)
            ]
            kept = [batch.column(i) for i in range(len(columns))]
            yield pa.RecordBatch.from_arrays(kept + [pa.array(found, kind)], schema.names)

    return rows.mapInArrow(run, schema)


def formatted(segments: str = "segments") -> Column:
    """The text of a turn's segments."""
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def read_turns(template: Template, text: str) -> Iterator[tuple[str, str]]:
    """The turns (role, text) of a formatted conversation, or of a part of it that begins
    and ends with a turn."""
    at = 0
    openings = [(t.opening, t) for t in template.turns] + [(template.other[0], None)]
    while at < len(text):
        for opening, turn in openings:
            if text.startswith(opening, at):
                break
        else:
            raise ValueError(f"no turn begins at {at}")
        at += len(opening)
        if turn is None:
            end = text.index(template.other[1], at)
            role, closing = template.unescaped(text[at:end]), template.other[2]
            at = end + len(template.other[1])
        else:
            role, closing = turn.role, turn.closing
        end = text.index(closing, at)
        yield role, template.unescaped(text[at:end])
        at = end + len(closing)


def check_order(
    conversations: DataFrame, template: Template = INSTRUCT,
    conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
) -> DataFrame:
    """``(conv_id, n_turns, valid, complete, first_wrong)`` of every conversation;
    ``first_wrong`` is the place, from 0, of the first turn that may not stand there."""
    ship_package(conversations.sparkSession)
    states, step = template.machine()
    broken = len(states) - 1
    ends = [s in template.by_role and template.by_role[s].may_end for s in states]
    slim = conversations.select(
        column(conv_id).alias("conv_id"), column(turn).alias("turn"), F.coalesce(column(role).cast("string"), F.lit("")).alias("role")
    )
    keys = ("conv_id", "turn", "role")
    slim = slim.repartitionByRange(partitions(slim.sparkSession), *keys).sortWithinPartitions(*keys)
    slim = slim.withColumn("at", F.monotonically_increasing_id())
    fields = "at bigint, n bigint, ends array<int>, wrong array<bigint>"
    conv_kind = slim.schema["conv_id"].dataType.simpleString()

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, first, n, now, wrong = None, None, 0, [], []

        def out(rows: list[tuple]) -> pa.RecordBatch:
            kinds = (conv_type, pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()))
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            return pa.RecordBatch.from_arrays(columns, ["conv_id", "at", "n", "ends", "wrong"])

        conv_type = pa.null()
        for batch in batches:
            conv_type, done = batch.schema.field(0).type, []
            ids, roles, places = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("conv_id", "role", "at"))
            for c, r, at in zip(ids, roles, places):
                if first is None or c != conv:
                    if first is not None:
                        done.append((conv, first, n, now, wrong))
                    conv, first, n = c, at, 0
                    now, wrong = list(range(len(states))), [None] * len(states)
                to = step.get(r)
                for i, s in enumerate(now):
                    now[i] = broken if to is None else to[s]
                    if now[i] == broken and s != broken:
                        wrong[i] = n
                n += 1
            if done:
                yield out(done)
        if first is not None:
            yield out([(conv, first, n, now, wrong)])

    maps = slim.mapInArrow(spans, f"conv_id {conv_kind}, {fields}")
    # As many maps a conversation as ranges hold a part of it.
    parts = F.array_sort(F.collect_list(F.struct("at", "n", "ends", "wrong")))
    start = F.struct(F.lit(0).alias("state"), F.lit(0).cast("bigint").alias("n"), F.lit(None).cast("bigint").alias("wrong"))
    run = F.aggregate(
        F.col("parts"),
        start,
        lambda s, p: F.struct(
            F.get(p["ends"], s["state"]).alias("state"),
            (s["n"] + p["n"]).alias("n"),
            F.coalesce(s["wrong"], s["n"] + F.get(p["wrong"], s["state"])).alias("wrong"),
        ),
    )
    done = maps.groupBy("conv_id").agg(parts.alias("parts")).select("conv_id", run.alias("run"))
    return done.select(
        "conv_id",
        F.col("run.n").alias("n_turns"),
        (F.col("run.state") != broken).alias("valid"),
        F.get(F.array(*[F.lit(e) for e in ends]), F.col("run.state")).alias("complete"),
        F.col("run.wrong").alias("first_wrong"),
    )


def conversation_digests(turns: DataFrame, template: Template = INSTRUCT, order: Sequence[str] = ("turn", "role")) -> DataFrame:
    """Digests of formatted conversations, read back from their segments: ``(conv_id,
    n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars)``.

    A digest is a chain over all text of a conversation, so its turns stream through one
    task in order; the task holds one turn at a time.
    """
    ship_package(turns.sparkSession)
    kind = turns.schema["conv_id"].dataType.simpleString()
    sorted_turns = (
        turns.select("conv_id", *order, "segments")
        .repartition(partitions(turns.sparkSession), "conv_id")
        .sortWithinPartitions("conv_id", *order, F.col("segments")[1]["text"])
        .select("conv_id", "segments")
    )
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv_type, now, conv = pa.null(), None, None

        def out(rows: list[tuple]) -> pa.RecordBatch:
            kinds = (conv_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names)

        def closed() -> tuple:
            n, turns, loss, loss_chars, chars = now
            return conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars

        for batch in _in_pieces(batches, "segments"):
            conv_type, done = batch.schema.field(0).type, []
            for c, segments in zip(*(batch.column(i).to_pylist() for i in range(2))):
                if now is None or c != conv:
                    if now is not None:
                        done.append(closed())
                    conv, now = c, [0, hashlib.sha256(), hashlib.sha256(), 0, 0]
                text = "".join(s["text"] for s in segments)
                for role, said in read_turns(template, text):
                    now[0] += 1
                    now[1].update(f"{role}\n{said}\n".encode())
                for s in segments:
                    if s["loss"]:
                        learned = template.unescaped(s["text"])
                        now[2].update(learned.encode())
                        now[3] += len(learned)
                now[4] += len(text)
            if done:
                yield out(done)
        if now is not None:
            yield out([closed()])

    schema = f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    return sorted_turns.mapInArrow(read, schema)


def _oracle() -> str:
    """The registered query in DuckDB SQL.  No two control strings begin at one place, and
    none overlaps itself, so each occurrence takes one escape."""
    t = INSTRUCT
    lower = " + ".join(
        [f"length(text) - length(replace(text, '{t.escape}', ''))"]
        + [f"(length(text) - length(replace(text, '{c}', ''))) // {len(c)}" for c in t.controls]
    )
    marks = " ".join(f"WHEN '{x.role}' THEN {len(x.opening) + len(x.closing)}" for x in t.turns)
    role_escapes = lower.replace("text", "role")
    allowed = ", ".join(f"('{a}', '{x.role}')" for x in t.turns for a in x.after)
    ends = ", ".join(f"'{x.role}'" for x in t.turns if x.may_end)
    loss = ", ".join(f"'{x.role}'" for x in t.turns if x.loss)
    named = ", ".join(f"'{x.role}'" for x in t.turns)
    return f"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
),
placed AS (
  SELECT *, row_number() OVER own - 1 AS i, lag(role, 1, '') OVER own AS before, lead(role) OVER own IS NULL AS last,
    length(text) + {lower} + CASE role {marks} ELSE {sum(map(len, t.other))} + length(role) + {role_escapes} END AS chars
  FROM said WINDOW own AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
),
judged AS (SELECT *, role NOT IN ({named}) OR (before, role) NOT IN ({allowed}) AS wrong FROM placed)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role IN ({loss})), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (WHERE role IN ({loss})), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars,
  NOT bool_or(wrong) AS valid,
  NOT bool_or(wrong) AND bool_or(last AND role IN ({ends})) AS complete,
  min(i) FILTER (WHERE wrong) AS first_wrong
FROM judged GROUP BY conv_id
"""


ORACLE = _oracle()
