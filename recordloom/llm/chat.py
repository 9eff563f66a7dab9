"""Chat formatting: a machine over roles checks the order of turns and emits text segments.

A ``Template`` is data: how each role's turn begins and ends, whether its text is learned, and the
moves of the machine, (state, role) to state.  A turn without a move breaks its conversation, which
stays broken; ``learn_broken`` says whether turns from there on are still learned.  Every turn becomes
three segments, marks - text - marks, each with its own loss flag; only text is ever under the mask.

Texts may hold the template's control strings.  ``escape`` doubles ``\\`` and puts one after the
first character of every control string, so that an escaped text holds none, and ``unescape`` takes
them out again.  The template refuses control strings for which that would not be reversible.

Turns are range-partitioned and sorted by (conversation, turn, role, text hash, text), so a conversation
may span tasks.  A task does not know in which state its first conversation arrives, so it
notes the state after each of that conversation's turns for every possible arrival.  The arrivals
follow from one row per partition.  No conversation is gathered.

Defined cases: null texts are empty; null roles are empty roles; a role that the template does not
list is written between marks of its own and has no moves; null turns come first; a null conversation
id is one conversation; repeated rows are turns of their own; further columns are not read; no
rows give no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import stage

MARK = "\\"
BROKEN = "broken"
_POSITION_BITS = 33  # monotonically_increasing_id keeps the partition above these


@dataclass(frozen=True)
class Role:
    """Marks around a turn and whether its text is learned."""

    open: str
    close: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """``controls`` are the strings that only marks may hold; each role's marks begin with one of its own."""

    roles: Mapping[str, Role]
    other: Role  # a role that is not listed: its name stands between ``open`` and ``named``
    named: str
    controls: tuple[str, ...]
    moves: Mapping[tuple[str, str], str]
    start: str = "start"
    final: frozenset[str] = frozenset()
    learn_broken: bool = True
    states: tuple[str, ...] = field(init=False)

    def __post_init__(self) -> None:
        for a in self.controls:
            if len(a) < 2 or MARK in a:
                raise ValueError(f"a control string needs two characters and no backslash: {a!r}")
            for b in self.controls:
                # A tail of a text and the head of a mark must not make a control string.
                if any(a.endswith(b[:n]) for n in range(1, len(b) + (a != b))):
                    raise ValueError(f"{a!r} ends as {b!r} begins")
        for role in (*self.roles.values(), self.other):
            for mark in (role.open, role.close):
                if sum(mark.count(c) for c in self.controls) != 1 or not mark.strip().startswith(self.controls):
                    raise ValueError(f"{mark!r} must hold one control string, first")
        opens = [r.open for r in (*self.roles.values(), self.other)]
        if any(a.startswith(b) for i, a in enumerate(opens) for j, b in enumerate(opens) if i != j):
            raise ValueError("one role's opening mark begins with another's")
        names = [self.start, *(s for s, _ in self.moves), *self.moves.values()]
        object.__setattr__(self, "states", (BROKEN, *sorted(set(names) - {BROKEN})))

    def step(self, state: int, role: str) -> int:
        return self.states.index(self.moves.get((self.states[state], role), BROKEN))

    def escape(self, text: str) -> str:
        return re.sub(_held(self.controls), r"\1\\", text.replace(MARK, MARK * 2), flags=re.S)

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"\\(\\?)", r"\1", text)

    def read(self, turn: str) -> tuple[str, str]:
        """Role and text of a formatted turn."""
        for name, role in self.roles.items():
            if turn.startswith(role.open) and turn.endswith(role.close):
                return name, self.unescape(turn[len(role.open) : len(turn) - len(role.close)])
        if not (turn.startswith(self.other.open) and turn.endswith(self.other.close)):
            raise ValueError(f"no role of the template begins {turn[:40]!r}")
        name, text = turn[len(self.other.open) : len(turn) - len(self.other.close)].split(self.named, 1)
        return self.unescape(name), self.unescape(text)


def _held(controls: tuple[str, ...]) -> str:
    """The first character of every control string, as a pattern of Java and Python."""
    return "(?=" + "|".join(re.escape(c) for c in controls) + ")(.)"


INSTRUCT = Template(
    roles={
        "system": Role("<<SYS>>\n", "\n<</SYS>>\n"),
        "user": Role("[INST] ", " [/INST]\n"),
        "assistant": Role("<s> ", " </s>\n", loss=True),
    },
    other=Role("<<ROLE>> ", "\n<</TURN>>\n"),
    named=" <</ROLE>>\n",
    controls=("<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "<s>", "</s>", "<<ROLE>>", "<</ROLE>>", "<</TURN>>"),
    moves={
        ("start", "system"): "told",
        ("start", "user"): "asked",
        ("told", "user"): "asked",
        ("asked", "assistant"): "answered",
        ("answered", "user"): "asked",
    },
    final=frozenset({"answered"}),
)


def _machine(template: Template):
    """Columns conv, role, text with the state after each turn, for every arrival in a first conversation."""
    states = range(len(template.states))
    begin = template.states.index(template.start)
    roles = {r for _, r in template.moves}
    step = {r: [template.step(s, r) for s in states] for r in roles}
    broken = [0] * len(states)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, now, nth, first = None, list(states), 0, True
        for batch in batches:
            after, places, leads = [], [], []
            for conv, role in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if last is None or last[0] != conv:
                    first = last is None
                    last, nth = (conv,), 0
                    now = list(states) if first else [begin]
                move = step.get(role, broken)
                now = [move[s] for s in now]
                after.append(now)
                places.append(nth)
                leads.append(first)
                nth += 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(after, pa.list_(pa.int32())), pa.array(places, pa.int64()), pa.array(leads, pa.bool_())],
                names=["conv", "role", "text", "after", "nth", "lead"],
            )

    return run


def _arrivals(begin: int):
    """From the last turn of every partition, in order, the state and place with which the next one begins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, turns, seen = None, begin, 0, False
        for batch in batches:
            out = []
            for part, head, tail, after, nth, lead in zip(*(c.to_pylist() for c in batch.columns)):
                if not seen or head != conv:
                    state, turns = begin, 0
                out.append((part, state, turns))
                turns, state = (turns + nth + 1, after[state]) if lead else (nth + 1, after[0])
                conv, seen = tail, True
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.int64()))],
                names=["of", "arrival", "turns"],
            ) if out else pa.RecordBatch.from_pydict(
                {"of": pa.array([], pa.int64()), "arrival": pa.array([], pa.int32()), "turns": pa.array([], pa.int64())}
            )

    return run


def _escaped(text: Column, template: Template) -> Column:
    doubled = F.replace(text, F.lit(MARK), F.lit(MARK * 2))
    return F.regexp_replace(doubled, F.lit("(?s)" + _held(template.controls)), F.lit("$1\\\\"))


def _segments(template: Template, valid: Column) -> Column:
    """Marks, text and marks of a turn; what the template says by role, as one expression."""
    role, text = F.col("role"), _escaped(F.col("text"), template)

    def turn(begin: Column, r: Role) -> Column:
        learned = (valid | F.lit(template.learn_broken)) if r.loss else F.lit(False)
        parts = ((begin, F.lit(False)), (text, learned), (F.lit(r.close), F.lit(False)))
        return F.array(*[F.struct(t.alias("text"), loss.alias("loss")) for t, loss in parts])

    named = F.concat(F.lit(template.other.open), _escaped(role, template), F.lit(template.named))
    chosen = F.when(F.lit(False), turn(named, template.other))
    for name, r in template.roles.items():
        chosen = chosen.when(role == name, turn(F.lit(r.open), r))
    return chosen.otherwise(turn(named, template.other))


def formatted(
    turns: DataFrame, template: Template = INSTRUCT, conv_col: str = "conv_id", turn_col: str = "turn",
    role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """(conv, place, state, segments) of every turn; ``place`` counts from 0, ``segments`` are (text, loss)."""
    order = ["conv", "turn", "role", "tie"]
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = turns.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"), text.alias("text"),
        F.xxhash64(text).alias("tie"),
    )
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order, "text").select("conv", "role", "text")
    fields = StructType([*rows.schema, *StructType.fromDDL("after array<int>, nth long, lead boolean")])
    run = rows.mapInArrow(_machine(template), fields).withColumn("at", F.monotonically_increasing_id())
    run = stage(run, "turns").withColumn("part", F.shiftright("at", _POSITION_BITS))
    last = F.max_by(F.struct("conv", "after", "nth", "lead"), "at")
    ends = run.groupBy("part").agg(F.min_by(F.struct("conv"), "at").alias("head"), last.alias("tail"))
    ends = ends.select("part", F.col("head.conv").alias("head"), F.col("tail.conv").alias("conv"), "tail.after", "tail.nth", "tail.lead")
    # One row per partition, so one task takes them in order and their broadcast is bounded.
    arrivals = ends.repartition(1).sortWithinPartitions("part").mapInArrow(
        _arrivals(template.states.index(template.start)), "of long, arrival int, turns long"
    )
    met = run.join(F.broadcast(arrivals), run["part"] == arrivals["of"])
    state = F.when(F.col("lead"), F.get("after", F.col("arrival"))).otherwise(F.get("after", F.lit(0)))
    names = F.array(*[F.lit(s) for s in template.states])
    return met.select(
        "conv",
        (F.col("nth") + F.when(F.col("lead"), F.col("turns")).otherwise(F.lit(0))).alias("place"),
        F.get(names, state).alias("state"),
        _segments(template, state != 0).alias("segments"),
    )


def write_chats(turns: DataFrame, path: str, template: Template = INSTRUCT, **columns: str) -> None:
    """The formatted turns as a Parquet table, in order of conversation and place."""
    formatted(turns, template, **columns).write.parquet(path)


def _read(template: Template):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roles, texts, learned, chars = [], [], [], []
            for segments in batch.column(3).to_pylist():
                whole = "".join(s["text"] for s in segments)
                role, text = template.read(whole)
                roles.append(role)
                texts.append(text)
                masked = [s["text"] for s in segments if s["loss"]]
                learned.append(template.unescape("".join(masked)) if masked else None)
                chars.append(len(whole))
            arrays = [pa.array(roles, pa.string()), pa.array(texts, pa.string()), pa.array(learned, pa.string()), pa.array(chars, pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], *arrays], names=["conv", "place", "state", "role", "text", "learned", "chars"]
            )

    return run


def read_chats(spark: SparkSession, path: str, template: Template = INSTRUCT) -> DataFrame:
    """(conv, place, state, role, text, learned, chars) of every turn, from the formatted text alone.

    ``learned`` is the text under the loss mask, null for none.
    """
    rows = spark.read.parquet(path)
    added = StructType.fromDDL("role string, text string, learned string, chars long")
    fields = StructType([*rows.select("conv", "place", "state").schema, *added])
    return rows.mapInArrow(_read(template), fields)


DIGESTS = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean"


def _digest(final: frozenset[str]):
    names = [f.split()[0] for f in DIGESTS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, found = None, None
        kind = pa.int64()

        def rows(done: list) -> pa.RecordBatch:
            types = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*done), types)], names=["conv", *names]
            )

        def closed() -> tuple:
            n, turns, n_loss, loss, chars, state = found
            return conv, n, turns.hexdigest(), n_loss, loss.hexdigest(), chars, state in final

        for batch in batches:
            kind = batch.column(0).type
            done = []
            for c, state, role, text, learned, chars in zip(*(c.to_pylist() for c in batch.columns)):
                if found is None or c != conv:
                    if found is not None:
                        done.append(closed())
                    conv, found = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, ""]
                found[0] += 1
                found[1].update(f"{role}\n{text}\n".encode())
                if learned is not None:
                    found[2] += len(learned)
                    found[3].update(learned.encode())
                found[4] += chars
                found[5] = state
            if done:
                yield rows(done)
        if found is not None:
            yield rows([closed()])

    return run


def digests(read: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """One row per conversation with digests of its turns and of the text under the mask.

    A digest is made of bytes in order, so a conversation streams through one task, which holds
    a batch of it and the state of two hashes.
    """
    rows = read.repartition("conv").sortWithinPartitions("conv", "place")
    rows = rows.select("conv", "state", "role", "text", "learned", "chars")
    fields = StructType([*rows.select("conv").schema, *StructType.fromDDL(DIGESTS)])
    return rows.mapInArrow(_digest(template.final), fields)


#: Digests by the definitions; lengths and moves are those of ``INSTRUCT``.
CHATS_SQL = r"""
    WITH turns AS (
        SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
        UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
    ),
    escaped AS (
        SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS before,
               lead(role) OVER (PARTITION BY conv_id ORDER BY turn) IS NULL AS ends,
               len(replace(text, '\', '\\')) + list_sum(list_transform(
                   ['<<SYS>>', '<</SYS>>', '[INST]', '[/INST]', '<s>', '</s>', '<<ROLE>>', '<</ROLE>>', '<</TURN>>'],
                   lambda c: (len(text) - len(replace(text, c, ''))) // len(c))) AS chars
        FROM turns
    )
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(concat(role, chr(10), text, chr(10)), '' ORDER BY turn)) AS turns_sha256,
           coalesce(sum(len(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
           sum(chars + CASE role WHEN 'system' THEN 18 WHEN 'user' THEN 16 WHEN 'assistant' THEN 10
                                 ELSE 31 + len(role) END)::BIGINT AS formatted_chars,
           bool_and(CASE role WHEN 'system' THEN before IS NULL
                              WHEN 'user' THEN before IS NULL OR before IN ('system', 'assistant')
                              WHEN 'assistant' THEN coalesce(before = 'user', false) ELSE false END)
               AND bool_or(ends AND role = 'assistant') AS valid
    FROM escaped GROUP BY conv_id
"""
