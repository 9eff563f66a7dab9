from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from recordloom.llm import chat
from recordloom.session import new_path

T = chat.INSTRUCT
SCHEMA = "conv_id long, turn long, role string, text string, state string, segments string, part long"


def rows_of(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 0) for r in rows], SCHEMA)


def walk(roles):
    """States and whether the conversation ends well, turn by turn."""
    state, states = T.start, []
    for role in roles:
        state = T.moves.get((state, role), chat.BROKEN)
        states.append(state)
    return states


def plain(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    want = {}
    for conv, its in turns.items():
        its.sort(key=lambda r: r[:3])
        whole = "".join(f"{role}\n{text}\n" for _, _, role, text in its)
        learned = "".join(text for _, _, role, text in its if role == "assistant")
        chars = 0
        for _, _, role, text in its:
            r = T.roles.get(role, T.other)
            chars += len(r.open) + len(T.escape(text)) + len(r.close)
            chars += 0 if role in T.roles else len(T.escape(role)) + len(T.named)
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (whole, learned)]
        want[conv] = (len(its), sha[0], len(learned), sha[1], chars, walk([r for _, _, r, _ in its])[-1] in T.final)
    return want


def check(spark, docs, rows):
    path = new_path(spark, "chats")
    chat.write_chats(docs, path)
    read = chat.read_chats(spark, path)
    got = {r.conv: tuple(r)[1:] for r in chat.digests(read).collect()}
    assert got == plain(rows)
    return path, read


@pytest.fixture(scope="module")
def chats():
    rng = random.Random(7)
    rows = []
    for conv in range(120):
        roles = [rng.choice(["user", "assistant", "system", "tool", "", "[INST]"]) for _ in range(rng.randint(1, 6))]
        if rng.random() < 0.6:
            roles = (["system"] if rng.random() < 0.4 else []) + ["user", "assistant"] * rng.randint(1, 4)
        for turn, role in enumerate(roles):
            text = "".join(rng.choice(["a", "é", "\n", " ", "\\", "\\\\", "<", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "s>", "\U0001f600", ""]) for _ in range(rng.randint(0, 12)))
            rows.append((conv if conv else None, turn if rng.random() < 0.97 or conv == 0 else None, role, text if rng.random() < 0.9 else None))
    # A third of all turns are of one conversation.
    rows += [(500, i, ["user", "assistant"][i % 2], f"turn {i} </s>") for i in range(300)]
    seen = set()
    return [r for r in rows if (r[0], r[1], r[2]) not in seen and not seen.add((r[0], r[1], r[2]))]


def test_chats_are_read_back_from_what_was_written(spark, chats):
    path, read = check(spark, rows_of(spark, chats).repartition(7), chats)
    assert {r.place for r in read.filter("conv = 500").collect()} == set(range(300))
    # Nothing but marks holds a control string.
    inner = spark.read.parquet(path).select(F.explode(F.transform("segments", lambda s: s["text"])).alias("t"), F.lit(0))
    for segments in spark.read.parquet(path).select("segments").limit(500).collect():
        text = segments.segments[1].text
        assert not any(c in text for c in T.controls)
    assert inner.count() == 3 * len(chats)


def test_a_conversation_may_span_tasks(spark, chats):
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = rows_of(spark, chats)
        out = chat.formatted(rows).withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    states = defaultdict(dict)
    for r in out:
        states[r.conv][r.place] = r.state
    roles = defaultdict(list)
    for conv, turn, role, text in sorted(chats, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "")):
        roles[conv].append(role)
    for conv, its in roles.items():
        assert [states[conv][i] for i in range(len(its))] == walk(its)
    assert len({r.task for r in out if r.conv == 500}) > 1


def test_turns_after_a_break_need_not_be_learned(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 2, "assistant", "b"), (1, 3, "user", "q"), (1, 4, "assistant", "c")]
    fields = {k: getattr(T, k) for k in ("roles", "other", "named", "controls", "moves", "start", "final")}
    strict = chat.Template(**fields, learn_broken=False)
    for template, learned in ((T, "abc"), (strict, "a")):
        out = chat.formatted(rows_of(spark, rows), template).orderBy("place").collect()
        assert [r.state for r in out] == ["asked", "answered", "broken", "broken", "broken"]
        assert "".join(s.text for r in out for s in r.segments if s.loss) == learned


@settings(deadline=None, max_examples=300)
@given(st.text(st.sampled_from("\\<>/s[]INSTSYS<</>> aé")), st.sampled_from(["user", "assistant", "system", "x", "a\\b", "<s>"]))
def test_escapes_are_reversible(text, role):
    escaped = T.escape(text)
    assert T.unescape(escaped) == text and not any(c in escaped for c in T.controls)
    r = T.roles.get(role)
    whole = r.open + escaped + r.close if r else T.other.open + T.escape(role) + T.named + escaped + T.other.close
    assert T.read(whole) == (role, text)


def test_templates_that_cannot_be_read_back_are_refused():
    fields = {k: getattr(T, k) for k in ("roles", "other", "named", "controls", "moves")}
    for change in (
        {"controls": (*T.controls, "x")}, {"controls": (*T.controls, "a\\b")}, {"controls": (*T.controls, "s><")},
        {"roles": {**T.roles, "user": chat.Role("Q: ", " [/INST]")}}, {"roles": {**T.roles, "user": chat.Role("[INST] <s>", " [/INST]")}},
        {"roles": {**T.roles, "tool": chat.Role("<s> tool ", " </s>\n")}},
    ):
        with pytest.raises(ValueError):
            chat.Template(**{**fields, **change})


def test_ties_repeats_and_empty_tables(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "b"), (1, None, "system", None), (None, 0, None, "x"), (2, 0, "assistant", "y" * 70_000)]
    check(spark, rows_of(spark, rows), rows)
    none = rows_of(spark, rows).limit(0)
    path = new_path(spark, "chats")
    chat.write_chats(none, path)
    assert chat.digests(chat.read_chats(spark, path)).count() == 0
    tied = [(3, 0, "user", t) for t in "dacb"]
    first = chat.formatted(rows_of(spark, tied)).orderBy("place").collect()
    again = chat.formatted(rows_of(spark, tied[::-1])).orderBy("place").collect()
    assert first == again and sorted(r.segments[1].text for r in first) == list("abcd")
