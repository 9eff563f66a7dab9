import pytest
from pyspark.sql import functions as F

from recordloom.operators.numbering import best_per, number_rows, page, page_after, rank_within


def test_numbers_equal_a_global_order(spark):
    df = spark.range(5000).select(((F.col("id") * 7919) % 5000).alias("k"))
    got = {r.k: r.n for r in number_rows(df, ["k"], "n").collect()}
    assert got == {k: k + 1 for k in range(5000)}


def test_numbers_of_nothing(spark):
    assert number_rows(spark.range(0), ["id"], "n").count() == 0


def test_rank_spans_a_hot_group(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") < 2700, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 5)).alias("k"),
        "id",
    )
    rows = rank_within(df, ["k"], ["id"], "place").collect()
    for key in {r.k for r in rows}:
        ordered = sorted((r.id, r.place) for r in rows if r.k == key)
        assert [p for _, p in ordered] == list(range(1, len(ordered) + 1))


def test_best_per(spark):
    df = spark.createDataFrame([("a", 1.0, "y"), ("a", 2.0, "z"), ("a", 2.0, "x"), ("b", 0.5, "q")], "k string, s double, v string")
    got = {(r.k, r.s, r.v) for r in best_per(df, ["k"], [-F.col("s"), "v"]).collect()}
    assert got == {("a", 2.0, "x"), ("b", 0.5, "q")}


@pytest.mark.parametrize("number, expected", [(1, [0, 1, 2]), (4, [9]), (5, []), (4000, [])])
def test_pages(spark, number, expected):
    got = page(spark.range(10), "id", number, 3)
    assert [r.id for r in got.rows.collect()] == expected
    assert tuple(got.totals.first()) == (number, 3, 10, 4)


def test_pages_carry_whole_rows_and_number_keys_only(spark):
    df = spark.range(100).select((99 - F.col("id")).alias("k"), F.lit("wide").alias("v"))
    assert [tuple(r) for r in page(df, "k", 3, 7).rows.collect()] == [(k, "wide") for k in range(14, 21)]


def plain_ranks(rows):
    """row_number per (k, j) by o, with nulls first."""
    order = lambda v: tuple((x is not None, x if x is not None else 0) for x in v)
    ranks, seen = [], {}
    for k, j, o in sorted(rows, key=order):
        seen[k, j] = seen.get((k, j), 0) + 1
        ranks.append((k, j, o, seen[k, j]))
    return ranks


def test_ranks_within_groups_of_every_size(spark):
    import random

    rng = random.Random(9)
    groups = [(1, None), (1, 2), (None, None), (None, 3), (4, 4), (5, 1)]
    rows = [(*rng.choice(groups), n) for n in range(600)] + [(7, 7, 1000 + n) for n in range(1500)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k int, j int, o int").repartition(5)
    for batch in ("3", "10000"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            ranked = rank_within(df, ["k", "j"], ["o"], "rank")
            got = [tuple(r) for r in ranked.select("k", "j", "o", "rank").collect()]
            parts = ranked.filter("k = 7").groupBy(F.spark_partition_id()).count().collect()
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        assert ranked.columns == ["k", "j", "o", "rank"]
        assert sorted(map(str, got)) == sorted(map(str, plain_ranks(rows)))
        assert len(parts) >= 2 and max(r["count"] for r in parts) < 1200  # the hot group stays spread


@pytest.mark.parametrize("bad", [0, 101, -1])
def test_page_size_limits(spark, bad):
    with pytest.raises(ValueError, match="between 1 and 100"):
        page(spark.range(1), "id", 1, bad)


def test_keyset_paging_visits_every_row_once(spark):
    df, seen, cursor = spark.range(10), [], None
    while rows := page_after(df, "id", cursor, 4).collect():
        seen += [r.id for r in rows]
        cursor = seen[-1]
    assert seen == list(range(10))
