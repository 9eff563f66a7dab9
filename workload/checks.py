"""Null rates, profiles and data tests over orders and line items with holes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from recordloom.operators import quality as Q
from recordloom.session import stage

from .frames import table
from .registry import query

# Orders with missing keys, a repeated id and odd statuses.
ORDERS = {
    "order_id": "CASE WHEN o_custkey = 11 THEN 11 ELSE o_orderkey END",
    "custkey": "nullif(o_custkey, 7)",
    "status": "nullif(o_orderstatus, 'P')",
    "priority": "o_orderpriority",
    "price": "CASE WHEN o_totalprice > 400000 THEN CAST('NaN' AS DOUBLE) ELSE o_totalprice END",
    "nothing": "CAST(NULL AS STRING)",
}
ORDERS_SQL = (
    "holes AS (SELECT " + ", ".join(f"{e} AS {n}" for n, e in ORDERS.items()) + " FROM orders)"
)
COLUMNS = list(ORDERS)


def holes(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.selectExpr(*[f"{e} AS {n}" for n, e in ORDERS.items()])


def _known(column: str) -> str:
    if column == "price":
        return "count(*) FILTER (price IS NOT NULL AND NOT isnan(price))"
    return f"count({column})"


def per_column(select: str) -> str:
    rows = "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, count(*) - {_known(c)} AS nulls, count(*) AS total FROM holes"
        for c in COLUMNS
    )
    return f"WITH {ORDERS_SQL}, counted AS ({rows})\n{select}"


@query(per_column("SELECT column_name, nulls, total FROM counted"))
def null_counts(spark, sf_dir):
    return Q.null_counts(holes(spark, sf_dir), [*COLUMNS, "absent"])


@query(per_column("SELECT column_name, round_even(nulls / total, 4) AS null_pct FROM counted"))
def null_rates(spark, sf_dir):
    return Q.null_rates(holes(spark, sf_dir), COLUMNS)


@query(
    per_column(
        """SELECT column_name, total - nulls AS non_null, total,
       CASE column_name WHEN 'price' THEN 'double' WHEN 'order_id' THEN 'bigint'
            WHEN 'custkey' THEN 'bigint' ELSE 'string' END AS data_type FROM counted"""
    )
)
def profile(spark, sf_dir):
    return Q.profile(holes(spark, sf_dir))


@query(f"WITH {ORDERS_SQL} SELECT order_id, priority FROM holes WHERE status IS NULL")
def not_null_failures(spark, sf_dir):
    return Q.not_null(holes(spark, sf_dir), "status").select("order_id", "priority")


@query(
    f"""WITH {ORDERS_SQL} SELECT order_id AS value, count(*) AS n FROM holes
WHERE order_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1"""
)
def unique_failures(spark, sf_dir):
    return Q.unique(holes(spark, sf_dir), "order_id")


@query(
    f"""WITH {ORDERS_SQL} SELECT priority AS value, count(*) AS n FROM holes
WHERE priority NOT IN ('1-URGENT', '2-HIGH') GROUP BY 1"""
)
def accepted_values_failures(spark, sf_dir):
    return Q.accepted_values(holes(spark, sf_dir), "priority", ["1-URGENT", "2-HIGH"])


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')"""
)
def relationships_failures(spark, sf_dir):
    parents = table(spark, sf_dir, "orders").filter("o_orderstatus <> 'P'")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return Q.relationships(lines, "l_orderkey", parents, "o_orderkey")


@query(
    f"""WITH {ORDERS_SQL} SELECT order_id, custkey FROM holes
WHERE NOT (custkey <= 500 OR status = 'F')"""
)
def expression_failures(spark, sf_dir):
    rows = Q.expression_is_true(holes(spark, sf_dir), "custkey <= 500 OR status = 'F'")
    return rows.select("order_id", "custkey")


@query(
    """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1"""
)
def combination_failures(spark, sf_dir):
    return Q.unique_combination(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    """SELECT max(ts) AS newest,
       CASE WHEN max(ts) < TIMESTAMP '2024-02-01 12:00:00' - INTERVAL 3 DAY THEN 'error'
            WHEN max(ts) < TIMESTAMP '2024-02-01 12:00:00' - INTERVAL 2 DAY THEN 'warn' ELSE 'pass' END AS status
FROM events"""
)
def freshness(spark, sf_dir):
    return Q.freshness(table(spark, sf_dir, "events"), "ts", dt.datetime(2024, 2, 1, 12))


@query(
    f"""
WITH {ORDERS_SQL}, failures AS (
  SELECT 'custkey_not_null' AS test, count(*) FILTER (custkey IS NULL) AS failures FROM holes
  UNION ALL SELECT 'priority_accepted', count(*) FILTER (priority NOT IN ('1-URGENT', '2-HIGH')) FROM holes
  UNION ALL SELECT 'price_positive', count(*) FILTER (NOT (price > 0)) FROM holes
  UNION ALL SELECT 'order_id_unique', count(*) FROM (
    SELECT order_id FROM holes WHERE order_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1)
  UNION ALL SELECT 'has_customer', count(*) FROM holes
    WHERE custkey IS NOT NULL AND custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
  UNION ALL SELECT 'one_current', count(*) FROM (
    SELECT custkey FROM holes WHERE status = 'O' AND custkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1)
  UNION ALL SELECT 'dates_in_order', count(*) FROM (
    SELECT o_orderdate, l_shipdate FROM orders JOIN lineitem ON o_orderkey = l_orderkey
    WHERE NOT (CAST(o_orderdate AS DATE) <= CAST(l_shipdate AS DATE))))
SELECT test, failures, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM failures"""
)
def test_suite(spark, sf_dir):
    rows = holes(spark, sf_dir)
    customer = table(spark, sf_dir, "customer").filter("c_acctbal > 0")
    dated = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
        .select(
            F.to_date("o_orderdate").alias("valid_from"), F.to_date("l_shipdate").alias("valid_to")
        )
    )
    located = rows.select("custkey", (F.col("status") == "O").alias("is_current"))
    return Q.run_suite(
        [
            Q.TableRules(
                rows,
                [
                    Q.null_rule("custkey_not_null", "custkey"),
                    Q.values_rule("priority_accepted", "priority", ["1-URGENT", "2-HIGH"]),
                    Q.RowRule("price_positive", ~(F.col("price") > 0)),
                ],
            ),
            Q.DataTest("order_id_unique", Q.unique(rows, "order_id")),
            Q.DataTest("has_customer", Q.relationships(rows, "custkey", customer, "c_custkey")),
            Q.DataTest("one_current", Q.single_current(located, "custkey")),
            Q.DataTest("dates_in_order", Q.ordered_dates(dated)),
        ]
    )


@query(
    """SELECT 'l_partkey' AS id_column, CAST(l_partkey AS VARCHAR) AS id FROM lineitem
WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 10)
UNION ALL
SELECT 'l_suppkey', CAST(l_suppkey AS VARCHAR) FROM lineitem
WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)"""
)
def unknown_ids(spark, sf_dir):
    part = table(spark, sf_dir, "part").filter("p_size > 10")
    supplier = table(spark, sf_dir, "supplier").filter("s_acctbal > 0")
    return Q.review_ids_valid(
        table(spark, sf_dir, "lineitem"),
        {
            "l_partkey": part.withColumnRenamed("p_partkey", "l_partkey"),
            "l_suppkey": supplier.withColumnRenamed("s_suppkey", "l_suppkey"),
        },
    )


@query(
    """SELECT 'o_custkey' AS id_column, CAST(c_custkey AS VARCHAR) AS id FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)"""
)
def unmapped_ids(spark, sf_dir):
    mapping = table(spark, sf_dir, "orders").filter("o_totalprice > 300000")
    customer = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_custkey")
    return Q.mapping_complete({"o_custkey": customer}, mapping)


@query(
    """SELECT o_custkey, count(DISTINCT o_orderpriority) AS priorities FROM orders
GROUP BY 1 HAVING count(DISTINCT o_orderpriority) > 1"""
)
def more_than_one(spark, sf_dir):
    from recordloom.operators.gold import more_than_one as groups

    return groups(table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderpriority", "priorities")


@query(
    """
SELECT 'orders' AS feed, CASE WHEN count(*) = 0 THEN 'orders: no rows returned'
                              WHEN count(o_custkey) = 0 THEN 'orders: columns entirely null [''o_custkey'']' END AS problem FROM orders
UNION ALL
SELECT 'unpriced', CASE WHEN count(*) = 0 THEN 'unpriced: no rows returned' END FROM orders WHERE o_totalprice < 0
UNION ALL
SELECT 'unnamed', CASE WHEN count(*) = 0 THEN 'unnamed: no rows returned'
                       WHEN count(nullif(o_orderstatus, o_orderstatus)) = 0 THEN 'unnamed: columns entirely null [''status'']' END FROM orders
UNION ALL
SELECT 'short', 'short: missing required columns [''o_custkey'']'"""
)
def feed_checks(spark, sf_dir):
    """What the feed checks say of the orders, of none of them, of an empty column and of a lacking one."""
    orders = table(spark, sf_dir, "orders")
    feeds = {
        "orders": (orders, "o_custkey"),
        "unpriced": (orders.filter("o_totalprice < 0"), "o_custkey"),
        "unnamed": (orders.selectExpr("nullif(o_orderstatus, o_orderstatus) AS status"), "status"),
        "short": (orders.drop("o_custkey"), "o_custkey"),
    }
    rows = []
    for name, (df, column) in feeds.items():
        try:
            Q.FeedChecks(name, required=[column], some_known=[column]).run(df)
            rows.append((name, None))
        except Q.CheckError as problem:
            rows.append((name, str(problem)))
    return spark.createDataFrame(rows, "feed string, problem string")


@query("SELECT least(5, count(*)) AS shown, least(5, count(*)) AS known FROM lineitem")
def first_look(spark, sf_dir):
    """The first rows of a feed as they come; all of them are rows of it."""
    items = table(spark, sf_dir, "lineitem")
    _, shown = Q.look(items.select("l_orderkey", "l_linenumber"), 5)
    shown = stage(shown, "first-rows")
    known = shown.join(items, ["l_orderkey", "l_linenumber"], "left_semi")
    return shown.agg(F.count(F.lit(1)).alias("shown")).withColumn("known", known.agg(F.count(F.lit(1))).scalar())
