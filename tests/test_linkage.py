import datetime as dt
import itertools

import duckdb
import pytest
from pyspark.sql import functions as F

from recordloom.operators import joins as J
from recordloom.operators import linkage as L
from recordloom.operators import merge as M
from recordloom.operators.joins import anti_not_in, spread_left_join

KEYS = "name string, city string, state_province string"


def frames(spark, left, right):
    return (
        spark.createDataFrame(left, f"l string, {KEYS}"),
        spark.createDataFrame(right, f"r string, {KEYS}"),
    )


def pairs(df):
    return sorted((r.l, r.r, r.match_strategy) for r in df.collect())


def test_rules_run_in_order(spark):
    left, right = frames(
        spark,
        [("1", "acme", "x", "or"), ("2", "north road ales", "x", "or"), ("3", None, "x", "or"),
         ("4", "acme", "x", "wa"), ("5", "north road ale", "y", "or")],
        [("a", "acme", "z", "or"), ("b", "north road ale", "x", "or"), ("c", None, "x", "or"),
         ("d", "acme", "q", "or"), ("e", "", "x", "or")],
    )
    assert pairs(L.link(left, right, "l", "r")) == [
        ("1", "a", "exact_name_state"), ("1", "d", "exact_name_state"),
        # "5" and "b" are equal by name and state, so "b" is gone when "2" comes up.
        ("5", "b", "exact_name_state"),
    ]


def test_fuzzy_sees_only_what_is_left(spark):
    left, right = frames(
        spark,
        [("1", "north road ales", "x", "or"), ("2", "north road ales", "y", "or")],
        [("a", "north road ale", "x", "or")],
    )
    assert pairs(L.link(left, right, "l", "r")) == [("1", "a", "fuzzy_name_city")]


def test_empty_sides(spark):
    left, right = frames(spark, [], [("a", "n", "x", "or")])
    links = L.link(left, right, "l", "r")
    assert links.count() == 0


def test_empty_names_match_exactly_but_never_fuzzily(spark):
    left, right = frames(spark, [("1", "", "x", "or"), ("2", "", "x", "wa")], [("a", "", "y", "or"), ("b", "", "x", "wa")])
    assert pairs(L.link(left, right, "l", "r")) == [
        ("1", "a", "exact_name_state"), ("2", "b", "exact_name_state"),
    ]


def test_score_at_the_threshold_does_not_link(spark):
    (a, b), score = ("abcdefghij", "abcdefghji"), None
    score = duckdb.sql(f"SELECT jaro_winkler_similarity('{a}', '{b}')").fetchall()[0][0]
    left, right = frames(spark, [("1", a, "x", "or")], [("a", b, "x", "or")])
    block = ["state_province", "city"]
    assert L.fuzzy_pairs(left, right, block, "name", score, "l", "r").count() == 0
    assert L.fuzzy_pairs(left, right, block, "name", score, "l", "r", inclusive=True).count() == 1


@pytest.mark.parametrize("chunk", [1, 3, 1000])
def test_hot_keys_split_without_changing_the_pairs(spark, chunk):
    names = [f"{a} {b} house" for a in ("red", "blue", "green", "old") for b in ("oak", "elm", "fir")]
    left, right = frames(
        spark,
        [(str(i), n, "x", "or") for i, n in enumerate(names * 2)],
        [(str(i), n + "s", "x", "or") for i, n in enumerate(names)],
    )
    found = L.fuzzy_pairs(
        left, right, ["state_province", "city"], "name", 0.9, "l", "r", text_rows=chunk, chunk_rows=chunk
    ).collect()
    got = {(r.l, r.r) for r in found}
    assert len(got) == len(found)
    want = {
        (str(i), str(j))
        for (i, a), (j, b) in itertools.product(enumerate(names * 2), enumerate(names))
        if duckdb.sql(f"SELECT jaro_winkler_similarity('{a}', '{b}s')").fetchall()[0][0] > 0.9
    }
    assert got == want and want


def test_copies_of_one_name_spread_over_tasks(spark):
    left, right = frames(
        spark,
        [(f"l{i}", "old oak house", "x", "or") for i in range(400)] + [("m", "blue", "x", "or")],
        [(f"r{i}", "old oak hause", "x", "or") for i in range(300)] + [("n", "blues", "x", "or")],
    )
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = L.fuzzy_pairs(left, right, ["state_province", "city"], "name", 0.9, "l", "r", chunk_rows=40)
        by_task = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for key, value in kept.items():
            spark.conf.set(key, value)
    assert sum(by_task) == 400 * 300 + 1
    assert max(by_task) < 0.25 * sum(by_task)


@pytest.mark.parametrize("threshold", [0.7, 0.85, 0.9, 0.97])
def test_length_bands_lose_no_pair(spark, threshold):
    names = ["a" * n + "b" * m for n in range(1, 14) for m in (0, 1, 3)]
    left, right = frames(
        spark, [(str(i), n, "x", "or") for i, n in enumerate(names)], [(str(i), n, "x", "or") for i, n in enumerate(names)]
    )
    got = {(int(r.l), int(r.r)) for r in L.fuzzy_pairs(left, right, ["state_province", "city"], "name", threshold, "l", "r").collect()}
    con = duckdb.connect()
    con.sql("CREATE TABLE n AS SELECT unnest(range(len($names))) AS i, unnest($names) AS name", params={"names": names})
    want = con.sql(
        "SELECT a.i, b.i FROM n a, n b WHERE jaro_winkler_similarity(a.name, b.name) > $t", params={"t": threshold}
    ).fetchall()
    assert got == set(want)


@pytest.mark.parametrize("chunk", [2, 8192])
def test_split_join_equals_plain_join(spark, chunk):
    left = spark.createDataFrame([("k", i) for i in range(9)] + [("m", 99)], "key string, a int")
    right = spark.createDataFrame([("k", i) for i in range(7)] + [("m", 98), ("n", 97)], "key string, b int")
    a, b, on = J.split_hot_keys(left, right, ["key"], left["a"], right["b"], chunk)
    got = sorted((r.a, r.b) for r in a.join(b, on).collect())
    assert got == sorted([(i, j) for i in range(9) for j in range(7)] + [(99, 98)])


@pytest.mark.parametrize("listed", [[], [1], [1, None], [None]])
@pytest.mark.parametrize("keys", [[1, 2, None], []])
def test_anti_join_follows_not_in(spark, listed, keys):
    left = spark.createDataFrame([(k,) for k in keys], "k int")
    right = spark.createDataFrame([(k,) for k in listed], "q int")
    left.createOrReplaceTempView("anti_left")
    right.createOrReplaceTempView("anti_right")
    want = spark.sql("SELECT k FROM anti_left WHERE k NOT IN (SELECT q FROM anti_right)").collect()
    got = anti_not_in(left, "k", right, "q").collect()
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_anti_join_does_not_broadcast_the_list(spark):
    left, right = spark.range(10).withColumnRenamed("id", "k"), spark.range(5).withColumnRenamed("id", "q")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = anti_not_in(left, "k", right, "q")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_spread_left_join_keeps_rows_without_key(spark):
    left = spark.createDataFrame([("a", 1), (None, 2), ("z", 3)], "k string, id int")
    right = spark.createDataFrame([("a", 10), (None, 20)], "q string, v int")
    got = sorted(((r.k, r.id, r.v) for r in spread_left_join(left, right, "k", "q", "id").collect()), key=lambda r: r[1])
    assert got == [("a", 1, 10), (None, 2, None), ("z", 3, None)]


def test_mapping_keeps_the_best_link_and_covers_both_sides(spark):
    left = spark.createDataFrame([("1",), ("2",)], "l string")
    right = spark.createDataFrame([("a",), ("b",), ("c",)], "r string")
    links = spark.createDataFrame(
        [("1", "b", "s", 0.95), ("1", "a", "s", 0.95), ("1", "c", "s", 0.92)],
        "l string, r string, match_strategy string, score double",
    )
    sources = M.Sources("x", "y")
    got = M.id_mapping(left, right, links, "l", "r", sources, dt.datetime(2024, 1, 1)).collect()
    assert sorted((r.gold_id, r.l, r.r) for r in got if r.l) == [("x_1", "1", "a"), ("x_2", "2", None)]
    assert sorted(r.gold_id for r in got if not r.l) == ["y_b", "y_c"]


def test_review_reasons(spark):
    tiered = spark.createDataFrame(
        [("1", "a", 0.95, False, True, False), ("2", "b", 0.8, False, False, True),
         ("3", "c", 1.0, True, False, False), ("3", "d", 1.0, True, False, False),
         ("4", "e", 1.0, True, False, False), ("5", "f", 0.851, False, False, True)],
        "l string, r string, score double, exact boolean, same_place boolean, same_address boolean",
    )
    kept = L.tier(tiered)
    tiers = {(r.l, r.r): r.confidence for r in kept.collect()}
    assert tiers[("1", "a")] == "medium" and tiers[("3", "c")] == "high"
    flags = {(r.l, r.r): r.match_reason for r in L.review_flags(kept, "l", "r").collect()}
    assert flags == {
        ("1", "a"): "borderline_name", ("2", "b"): "same_address_diff_name",
        ("3", "c"): "multiple_matches", ("3", "d"): "multiple_matches",
    }


def broadcasts(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("BroadcastHashJoin") + plan.count("BroadcastNestedLoopJoin")


def test_links_are_never_sent_to_every_task(spark, tmp_path):
    """Equal ids make a file of a few bytes, which says nothing of the rows in it."""
    spark.range(50_000).selectExpr("concat('left', id % 3) AS l", "concat('right', id % 3) AS r", "'m' AS match_strategy").write.parquet(str(tmp_path / "links"))
    links = spark.read.parquet(str(tmp_path / "links"))
    # The feeds are large enough not to be sent themselves.
    left = spark.range(600_000).selectExpr("concat('left', id) AS l", "repeat('n', 60) AS name")
    right = spark.range(600_000).selectExpr("concat('right', id) AS r", "repeat('n', 60) AS name")
    assert broadcasts(anti_not_in(left, "l", links, "l")) == 0
    assert broadcasts(J.through_bridge(left, links.select("l", "r"), right, "l", "r")) == 0
    assert anti_not_in(left, "l", links, "l").count() == 600_000 - 3


def test_a_long_pair_passes_the_bound(spark):
    """The product of two lengths passes 32 bits."""
    text = "north road ales " * 4_000
    left, right = frames(spark, [("1", text, "x", "or")], [("a", text + "!", "x", "or")])
    found = L.fuzzy_pairs(left, right, ["city"], "name", 0.9, "l", "r").collect()
    assert [(f.l, f.r) for f in found] == [("1", "a")]


def test_best_links_are_the_best_of_the_listed_links(spark):
    """Copies, repeated and null ids, null keys, equal scores, and ids that an earlier rule used."""
    names = ["north road ales", "north road ale", "north roads ale", "acme", "acme brewing", "", None]
    rows = [
        (None if i % 23 == 22 else str(i % 40), names[(i * 5) % 7], "xy"[i % 2], ["or", "wa", None][i % 3]) for i in range(90)
    ]
    for left_rows, right_rows in (
        ([r for r in rows if r[0]], [(r[0] and "r" + r[0], *r[1:]) for r in rows[::-1] if r[0]]),
        (rows, [("r", *r[1:]) for r in rows[:9]]),
        (rows[:30], [(r[0] and "r" + r[0], *r[1:]) for r in rows[20:]]),
        (rows[:9], []),
    ):
        left, right = frames(spark, left_rows, right_rows)
        listed = M.best_links(L.link(left, right, "l", "r"), "l", "r")
        best = L.best_links(left, right, "l", "r")
        assert best.columns == ["l", "r", "match_strategy", "score"]
        as_rows = lambda df: sorted(map(str, df.select("l", "r", "match_strategy", "score").collect()))
        assert as_rows(best) == as_rows(listed)


def test_best_links_list_no_pairs_of_copies(spark, monkeypatch):
    """2,000 copies on either side are four million links, of which none is written."""
    copies = lambda n, key: spark.range(n).selectExpr(f"concat('{key}', id) AS {key}", "'acme' AS name", "'x' AS city", "'or' AS state_province")
    written = []
    monkeypatch.setattr(L, "stage", lambda df, label="stage", stage=L.stage: written.append(stage(df, label)) or written[-1])
    best = L.best_links(copies(2_000, "l"), copies(2_000, "r"), "l", "r")
    assert best.select("r").distinct().collect()[0].r == "r0" and best.count() == 2_000
    assert max(df.count() for df in written) <= 2_000


def test_the_review_queue_is_numbered_without_its_names(spark, monkeypatch):
    """Rows of one id that come twice are two rows of the queue; ids with two partners are flagged."""
    ids = "string, name string, street_address string, address_hash string, latitude double, longitude double"
    left = spark.createDataFrame([("1", "a", "s", "h", 1.0, 1.0), ("1", "b", "s", "h", 1.0, 1.0), ("2", "c", None, "k", 2.0, 1.0)], f"l {ids}")
    right = spark.createDataFrame([("x", "a", "t", "h", 1.0, 1.0), ("y", "d", "t", "k", 2.0, 1.0)], f"r {ids}")
    pairs = [("1", "x", 1.0, True), ("2", "x", 1.0, True), ("2", "y", 0.9, False)]
    tiered = spark.createDataFrame([(*p, not p[3], False) for p in pairs], "l string, r string, score double, exact boolean, same_place boolean, same_address boolean")
    numbered = []
    monkeypatch.setattr(L, "number_rows", lambda df, *rest, number=L.number_rows: numbered.append(df.columns) or number(df, *rest))
    queue = L.review_queue(L.review_flags(tiered, "l", "r"), left, right, "l", "r", dt.datetime(2024, 1, 1))
    rows = sorted(queue.collect(), key=lambda r: r.review_id)
    assert [r.review_id for r in rows] == [1, 2, 3, 4] and queue.columns[:4] == ["review_id", "l", "r", "left_name"]
    assert sorted((r.l, r.r, r.left_name, r.right_name, r.match_reason) for r in rows) == [
        ("1", "x", "a", "a", "multiple_matches"), ("1", "x", "b", "a", "multiple_matches"),
        ("2", "x", "c", "a", "multiple_matches"), ("2", "y", "c", "d", "borderline_name"),
    ]
    assert [r.address_similarity > 0 for r in rows] == [False, False, True, False]
    assert numbered == [["r", "l", "score", "match_reason", "_left_row", "_right_row"]]


@pytest.mark.parametrize("chunk", [1, 2, 1000])
def test_exact_pairs_keep_repeated_and_null_ids(spark, chunk):
    """Rows of one id are rows of their own; a null id is an id, a null key is none."""
    names = ["acme", "blue", None, "acme", "", "oak"]
    rows = [(None if i % 4 == 3 else str(i % 5), names[i % 6], "x", ["or", "wa", None][i % 7 % 3]) for i in range(40)]
    left, right = frames(spark, rows, rows[::-3] + rows[:4])
    want = sorted(
        (str(a[0]), str(b[0]))
        for a, b in itertools.product(rows, rows[::-3] + rows[:4])
        if None not in (a[1], a[3]) and (a[1], a[3]) == (b[1], b[3])
    )
    found = L.exact_pairs(left, right, ["name", "state_province"], "l", "r", chunk)
    assert found.columns == ["l", "r"] and want
    assert sorted((str(r.l), str(r.r)) for r in found.collect()) == want


@pytest.mark.parametrize("ids", ["concat('{0}', id)", "'{0}'", "CAST(NULL AS STRING)"])
def test_exact_pairs_of_one_name_spread_over_tasks(spark, ids):
    """Its rows are small and its pairs many: they must not meet in one task, whatever their ids."""
    rows = lambda n, side: spark.range(n).selectExpr(f"{ids.format(side)} AS {side}", "'old oak house' AS name", "'or' AS state_province")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = L.exact_pairs(rows(3_000, "l"), rows(2_000, "r"), ["name", "state_province"], "l", "r")
        by_task = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(by_task) == 3_000 * 2_000
    assert max(by_task) < 0.5 * sum(by_task)
