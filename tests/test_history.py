import datetime as dt
import random

from recordloom.operators import gold as G
from recordloom.operators import history as H
from recordloom.operators import quality as Q

SNAPSHOT = "gold_id string, address_id int, source_system string, match_confidence double"
D = dt.date


def snapshot(spark, places):
    return spark.createDataFrame([(k, a, "x", 1.0) for k, a in places], SNAPSHOT)


def rows(df):
    return sorted((r.gold_id, r.address_id, r.valid_from, r.valid_to, r.is_current) for r in df.collect())


def test_update_cases(spark):
    first = H.scd2_initial(snapshot(spark, [("stay", 1), ("move", 1), ("gone", 2), ("back", 3)]), D(2024, 1, 1))
    second = H.scd2_apply(
        first, snapshot(spark, [("stay", 1), ("move", 2), ("move", 5), ("new", 4)]), D(2024, 1, 10)
    )
    third = H.scd2_apply(
        second, snapshot(spark, [("stay", 1), ("move", 2), ("new", 4), ("back", 3)]), D(2024, 1, 20)
    )
    assert rows(third) == [
        ("back", 3, D(2024, 1, 1), D(2024, 1, 9), False),
        ("back", 3, D(2024, 1, 20), None, True),
        ("gone", 2, D(2024, 1, 1), D(2024, 1, 9), False),
        ("move", 1, D(2024, 1, 1), D(2024, 1, 9), False),
        ("move", 2, D(2024, 1, 10), None, True),
        ("new", 4, D(2024, 1, 10), None, True),
        ("stay", 1, D(2024, 1, 1), None, True),
    ]
    ids = [r.location_id for r in third.collect()]
    assert sorted(ids) == list(range(1, 8))


def test_same_day_move_replaces_the_row(spark):
    day = D(2024, 1, 1)
    first = H.scd2_initial(snapshot(spark, [("a", 1)]), day)
    assert rows(H.scd2_apply(first, snapshot(spark, [("a", 2)]), day)) == [("a", 2, day, None, True)]


def test_random_updates_keep_the_invariants_and_agree_with_backfill(spark):
    rng = random.Random(9)
    days = [D(2024, 1, 1) + dt.timedelta(days=3 * i) for i in range(4)]
    seen = [[(f"e{i}", rng.randrange(3)) for i in range(12) if rng.random() < 0.75] for _ in days]
    history = H.scd2_initial(snapshot(spark, seen[0]), days[0])
    for day, places in zip(days[1:], seen[1:]):
        history = H.scd2_apply(history, snapshot(spark, places), day)
    assert Q.ordered_dates(history).count() == 0
    assert Q.single_current(history).count() == 0
    assert Q.unique_combination(history, ["gold_id", "valid_from"]).count() == 0
    flat = spark.createDataFrame(
        [(k, a, d) for d, places in zip(days, seen) for k, a in places],
        "gold_id string, address_id int, seen_on date",
    )
    assert rows(H.intervals(flat, "gold_id", "address_id", "seen_on")) == rows(history)


def test_intervals_take_one_row_per_day_and_close_before_gaps(spark):
    flat = spark.createDataFrame(
        [("a", 1, D(2024, 1, 1)), ("a", 1, D(2024, 1, 1)), ("a", 1, D(2024, 1, 5)), ("b", 2, D(2024, 1, 9)),
         ("a", 1, D(2024, 1, 12))],
        "gold_id string, address_id int, seen_on date",
    )
    assert rows(H.intervals(flat, "gold_id", "address_id", "seen_on")) == [
        ("a", 1, D(2024, 1, 1), D(2024, 1, 8), False),
        ("a", 1, D(2024, 1, 12), None, True),
        ("b", 2, D(2024, 1, 9), D(2024, 1, 11), False),
    ]


def test_documents_continue_in_parts(spark):
    history = spark.createDataFrame(
        [(7, f"e{i}", f"n{i}", D(2024, 1, i + 1), None, True, "1 Main", "Town", "S", "01234", "X", 1.5, 2.5) for i in range(8)],
        "address_id int, gold_id string, name string, valid_from date, valid_to date, is_current boolean, "
        "street_address string, city string, state_province string, postal_code string, country string, "
        "latitude double, longitude double",
    )
    ordered = G.succession(history)
    parts = sorted(G.succession_documents(ordered, 3).collect(), key=lambda r: r.part)
    assert [len(p.entities) for p in parts] == [3, 3, 2]
    assert [e.succession_order for p in parts for e in p.entities] == list(range(1, 9))
    assert {p.entity_count for p in parts} == {8} and parts[0].public_id == "addr_7"
    assert parts[1].address == ("1 Main", "Town", "S", "01234", "X") and parts[1].coordinates == (1.5, 2.5)
    joined = G.by_use(G.reuse(ordered, part_entries=3)).collect()
    assert [r.entity_succession for r in joined] == ["n0 → n1 → n2", "n3 → n4 → n5", "n6 → n7"]
    assert {(r.street_address, r.city, r.state_province) for r in joined} == {("1 Main", "Town", "S")}
    assert len(G.succession_documents(ordered).collect()) == 1
