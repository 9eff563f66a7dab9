"""Statistics that add and subtract against those of all rows."""

from __future__ import annotations

import random

from recordloom.operators import gold as G
from recordloom.operators.merge import Sources
from recordloom.session import new_path

SOURCES = Sources("a", "b")
SCHEMA = (
    "gold_id string, source_system string, category string, country string, is_active boolean, latitude double, longitude double, "
    "phone string, website_url string, phone_source string, website_source string"
)


def entity(rng, i):
    phone, web = rng.choice([None, "1"]), rng.choice([None, "w"])
    return (
        f"e{i}", rng.choice(["a", "b", "both", None]), rng.choice(["micro", "large", None]), rng.choice(["US", "DE", "FR", "NL", None]),
        rng.choice([True, False, None]), rng.choice([None, 1.0]), 2.0, phone, web, phone and rng.choice("ab"), web and rng.choice("ab"),
    )


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_loads_add_up_to_a_recomputation(spark):
    rng = random.Random(4)
    log = G.StatisticsLog(spark, new_path(spark, "statistics"), SOURCES)
    now = {i: entity(rng, i) for i in range(60)}
    log.load(spark.createDataFrame(list(now.values()), SCHEMA))
    for turn in range(2):
        changed, ended = rng.sample(sorted(now), 15), []
        gone = [now[i] for i in changed]
        ended = changed[:5]
        now = {i: e for i, e in now.items() if i not in ended} | {i: entity(rng, i) for i in changed[5:]}
        new = {100 * (turn + 1) + i: entity(rng, i) for i in range(7)}
        now |= new
        came = [now[i] for i in changed[5:]] + list(new.values())
        log.load(spark.createDataFrame(came, SCHEMA), spark.createDataFrame(gone, SCHEMA))
        want = rows(G.statistics(spark.createDataFrame(list(now.values()), SCHEMA), SOURCES, top_countries=2))
        assert rows(log.statistics(top_countries=2)) == want
        log.compact()
        assert rows(log.statistics(top_countries=2)) == want and len(log.runs.numbers()) == 1
    # What is read: a row per source, category and country at most.
    assert log.runs.read("summaries", log.schema).count() <= 4 * 3 * 5
    everything = spark.createDataFrame(list(now.values()), SCHEMA)
    log.load(everything.limit(0), everything)
    assert log.summary().count() == 0
