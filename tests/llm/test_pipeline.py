from __future__ import annotations

import re
from pathlib import Path

import pytest

import corpus_pipeline
from recordloom.llm import mixing
from recordloom.llm.queries import ORACLES, QUERIES

from recordloom.llm.decontaminate import tokens

from .test_decontaminate import plain as plain_overlap
from .test_line_rules import plain as plain_rules
from .test_simhash import plain_groups, plain_print

SF = "/root/testdata/sf0.001"


def near(text, item):
    """Whether so many tokens of the item stand in the text at all that a run of it could."""
    x, y = set(tokens(text)), tokens(item)
    run = min(13, len(y))
    held = [w in x for w in y]
    return any(sum(held[i : i + run]) >= 0.8 * run for i in range(len(y) - run + 1))


def test_stages_follow_one_another(spark, sample):
    """Every stage against brute force over what the stage before it kept."""
    docs, steps = sample, dict(corpus_pipeline.STAGES)
    assert list(steps) == ["quality rules", "near duplicates", "decontamination", "mixing", "token ids"]
    ruled = steps["quality rules"](spark, docs, SF)
    verdicts = plain_rules([(r.doc_id, r.text, r.source) for r in docs.collect()], 10, 0.2, 0.3)
    assert {r.doc_id for r in ruled.collect()} == {v[0] for v in verdicts if v[7]}
    assert ruled.columns == docs.columns
    single = steps["near duplicates"](spark, ruled, SF)
    prints = [(r.doc_id, plain_print(r.text)) for r in ruled.collect()]
    assert {r.doc_id for r in single.collect()} == set(plain_groups(prints, 4))
    clean = steps["decontamination"](spark, single, SF)
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    items = [r.text for r in benchmark.collect()]
    held = {r.doc_id for r in single.collect() if any(plain_overlap(r.text, x) for x in items if near(r.text, x))}
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in single.collect()} - held
    mixed = steps["mixing"](spark, clean, SF)
    copies = {r.doc_id: r.copies for r in mixing.mix(clean).collect()}
    assert mixed.count() == sum(copies.values()) and mixed.columns == docs.columns
    tokens = steps["token ids"](spark, mixed, SF).collect()
    assert len(tokens) == mixed.count()
    assert sorted(r.doc_id for r in tokens) == sorted(i for i, n in copies.items() for _ in range(n))
    rerun = corpus_pipeline.run(spark, SF).collect()
    assert sorted(rerun) == sorted(tokens)


@pytest.mark.parametrize("frame", ["messy", "nothing"])
def test_messy_and_empty_tables(frame, spark, request):
    docs = request.getfixturevalue(frame)
    for _, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, SF)
        docs.collect()


def test_queries_are_registered_and_the_pipeline_alone():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


def test_nothing_else_imports_the_package():
    root = Path(__file__).resolve().parents[2]
    for path in [*root.glob("recordloom/**/*.py"), *root.glob("workload/**/*.py"), *root.glob("tests/*.py"), root / "bench.py"]:
        if "llm" not in path.relative_to(root).parts:
            assert not re.search(r"\bllm\b", path.read_text()), path
