"""Column functions, filters, projections and unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordloom.functions import columns as C
from recordloom.functions.geo import haversine_m
from recordloom.functions.similarity import jaro_winkler
from recordloom.operators import shape as S
from recordloom.operators.numbering import newest, page, page_after, rank_within, top
from recordloom.operators.published import publish
from recordloom.operators.shape import stack
from recordloom.session import new_path
from recordloom.operators.numbering import number_rows as numbered

from .frames import LINES_SQL, lines, table
from .registry import query


@query(
    """
SELECT c_custkey,
       CASE WHEN c_acctbal / 20 >= -90 AND c_acctbal / 20 <= 90
            THEN CAST(c_acctbal / 20 AS DECIMAL(10,6)) END AS latitude,
       CASE WHEN c_acctbal / 10 >= -180 AND c_acctbal / 10 <= 180
            THEN CAST(c_acctbal / 10 AS DECIMAL(10,6)) END AS longitude
FROM customer"""
)
def bounded_coordinates(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        C.bounded_decimal(F.col("c_acctbal") / 20, -90, 90).alias("latitude"),
        C.bounded_decimal(F.col("c_acctbal") / 10, -180, 180).alias("longitude"),
    )


@query(
    """
SELECT p_partkey,
       CASE WHEN nullif(p_type, 'PROMO') IN ('SMALL', 'MEDIUM') THEN 'compact'
            WHEN nullif(p_type, 'PROMO') IN ('LARGE') THEN 'bulk'
            ELSE 'Unknown' END AS category, lower(p_type) AS lowered
FROM part"""
)
def taxonomy(spark, sf_dir):
    kinds = {"SMALL": "compact", "MEDIUM": "compact", "LARGE": "bulk"}
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        C.map_category(F.expr("nullif(p_type, 'PROMO')"), kinds).alias("category"),
        C.lower_text("p_type").alias("lowered"),
    )


@query(
    """
SELECT p_partkey,
       trim(concat_ws(' ', nullif(p_brand, 'Brand#2'), nullif(p_type, 'SMALL'),
                      CASE WHEN p_size % 5 = 0 THEN '' WHEN p_size % 5 = 1 THEN NULL ELSE p_name END)) AS line
FROM part"""
)
def address_line(spark, sf_dir):
    third = F.expr("CASE WHEN p_size % 5 = 0 THEN '' WHEN p_size % 5 = 1 THEN NULL ELSE p_name END")
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        C.join_parts(
            F.expr("nullif(p_brand, 'Brand#2')"), F.expr("nullif(p_type, 'SMALL')"), third
        ).alias("line"),
    )


@query(
    """
SELECT o_orderkey,
       CASE WHEN length(CAST((o_orderkey * 999983) AS VARCHAR)) = 10
            THEN '+1' || CAST((o_orderkey * 999983) AS VARCHAR) END AS phone
FROM orders"""
)
def phone_prefix(spark, sf_dir):
    number = (F.col("o_orderkey") * 999983).cast("string")
    return table(spark, sf_dir, "orders").select("o_orderkey", C.prefix_phone(number).alias("phone"))


@query(
    "WITH "
    + LINES_SQL
    + """
SELECT doc_id, line_no, lower(trim(chr(160) || line || chr(12288) || ' ')) AS match_key,
       trim(lang || ' ') = 'en' AS is_english
FROM lines"""
)
def match_keys(spark, sf_dir):
    padded = F.concat(F.lit(" "), "line", F.lit("　 "))
    return lines(spark, sf_dir).select(
        "doc_id",
        "line_no",
        C.match_key(padded).alias("match_key"),
        C.trimmed_equals(F.concat("lang", F.lit(" ")), "en").alias("is_english"),
    )


@query(
    """
SELECT c_custkey, n_name AS nation, c_mktsegment AS segment, lower(c_mktsegment) AS segment_key
FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE (CASE WHEN c_acctbal > 3000 THEN true WHEN c_acctbal > 0 THEN false END) IS TRUE
  AND nullif(c_mktsegment, 'BUILDING') NOT IN ('MACHINERY', 'Furniture')"""
)
def filters_struct(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    nested = (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            "c_custkey",
            F.expr("CASE WHEN c_acctbal > 3000 THEN true WHEN c_acctbal > 0 THEN false END").alias("flag"),
            F.struct(
                F.col("n_name").alias("nation"),
                F.expr("nullif(c_mktsegment, 'BUILDING')").alias("segment"),
            ).alias("place"),
        )
    )
    spec = S.FeedSpec(
        columns={
            "c_custkey": "c_custkey",
            "nation": "place.nation",
            "segment": "place.segment",
            "segment_key": "place.segment",
        },
        lowered=("segment_key",),
        true_flags=("flag",),
        excluded={"place.segment": ("MACHINERY", "Furniture")},
    )
    return S.standardize(nested, spec)


@query(
    """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' AND o_totalprice BETWEEN 100000 AND 200000"""
)
def optional_filters(spark, sf_dir):
    rows = S.filter_by(
        table(spark, sf_dir, "orders"),
        o_orderstatus="F",
        o_orderpriority="1-URGENT",
        o_custkey=None,
    )
    return rows.filter(C.in_band("o_totalprice", 100000, 200000)).select(
        "o_orderkey", "o_custkey", "o_totalprice"
    )


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_custkey = 42")
def lookup_by_id(spark, sf_dir):
    return S.lookup(table(spark, sf_dir, "customer"), "c_custkey", 42).select(
        "c_custkey", "c_name", "c_mktsegment"
    )


@query(
    "WITH "
    + LINES_SQL
    + """
SELECT doc_id, line_no FROM lines
WHERE contains(lower(line), lower('Nder')) OR contains(lower(source), lower('Nder'))"""
)
def text_search(spark, sf_dir):
    return S.text_search(lines(spark, sf_dir), "Nder", ["line", "source"]).select(
        "doc_id", "line_no"
    )


@query(
    """
SELECT c_custkey AS id, c_custkey AS also_id, c_name AS name, c_acctbal AS balance,
       CAST(NULL AS VARCHAR) AS partner_id, 'customer' AS status FROM customer
UNION ALL
SELECT s_suppkey, s_suppkey, s_name, s_acctbal, 'p', 'supplier' FROM supplier"""
)
def union_with_constants(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_custkey").alias("also_id"),
        F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"),
    )
    supplier = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"),
        F.col("s_suppkey").alias("also_id"),
        F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("balance"),
    )
    return S.stack(
        S.with_constants(customer, {"partner_id": (None, "string"), "status": ("customer", "string")}),
        S.with_constants(supplier, {"partner_id": ("p", "string"), "status": ("supplier", "string")}),
    )


@query(
    """
SELECT c_custkey, coalesce(nullif(c_mktsegment, 'BUILDING'), n_name) AS preferred,
       CASE WHEN nullif(c_mktsegment, 'BUILDING') IS NOT NULL THEN 'segment'
            WHEN n_name IS NOT NULL THEN 'nation' END AS preferred_source,
       c_mktsegment || ', ' || nullif(n_name, 'NATION_3') AS place,
       to_json({'k': c_custkey, 's': c_mktsegment}) AS as_json,
       round_even(c_acctbal / 7, 4) AS share
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey"""
)
def preferences(spark, sf_dir):
    segment = F.expr("nullif(c_mktsegment, 'BUILDING')")
    value, source = C.prefer_with_source({"segment": segment, "nation": "n_name"})
    return (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            "c_custkey",
            value.alias("preferred"),
            source.alias("preferred_source"),
            C.concat_strict(
                "c_mktsegment", F.lit(", "), F.expr("nullif(n_name, 'NATION_3')")
            ).alias("place"),
            C.as_json(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("s")).alias("as_json"),
            C.round_half_even(F.col("c_acctbal") / 7, 4).alias("share"),
        )
    )


@query(
    """
SELECT event_id, user_id, coalesce(CAST(CASE WHEN value > 20 THEN ts END AS DATE), DATE '9999-12-31') AS ends,
       CASE WHEN value > 10 AND value < 30 AND event_type <> 'view' THEN 'both'
            WHEN value > 10 THEN 'first' WHEN value < 30 AND event_type <> 'view' THEN 'second' END AS source_system,
       CASE WHEN value > 10 THEN 'first_' || user_id
            WHEN value < 30 AND event_type <> 'view' THEN 'second_' || event_id
            ELSE 'gen_' || md5(event_type || coalesce(nullif(props, '{"k": 1}'), '')) END AS gold_id
FROM events"""
)
def gold_ids(spark, sf_dir):
    left = F.expr("CASE WHEN value > 10 THEN user_id END")
    right = F.expr("CASE WHEN value < 30 AND event_type <> 'view' THEN event_id END")
    return table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        C.open_end(F.expr("CAST(CASE WHEN value > 20 THEN ts END AS DATE)")).alias("ends"),
        C.source_flag(left, right, "first", "second").alias("source_system"),
        C.gold_id(
            left,
            right,
            "event_type",
            F.nullif("props", F.lit('{"k": 1}')),
            left="first",
            right="second",
        ).alias("gold_id"),
    )


@query(
    """
SELECT p_partkey, round(jaro_winkler_similarity(p_name, lower(p_type)), 9) AS by_type,
       round(jaro_winkler_similarity(p_brand, nullif(p_type, 'SMALL')), 9) AS by_brand
FROM part"""
)
def jaro_winkler_scores(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.round(jaro_winkler("p_name", F.lower("p_type")), 9).alias("by_type"),
        F.round(jaro_winkler("p_brand", F.nullif("p_type", F.lit("SMALL"))), 9).alias("by_brand"),
    )


@query(
    """
SELECT c_custkey,
       round(2 * 6371008.8 * asin(sqrt(least(1.0,
         pow(sin(radians(c_nationkey * 7 - 80 - 45.5) / 2), 2)
         + cos(radians(45.5)) * cos(radians(c_nationkey * 7 - 80))
           * pow(sin(radians((c_custkey % 360) - 180 + 122.7) / 2), 2)))), 3) AS metres
FROM customer"""
)
def haversine_distance(spark, sf_dir):
    metres = haversine_m(
        F.lit(45.5), F.lit(-122.7), F.col("c_nationkey") * 7 - 80, F.col("c_custkey") % 360 - 180
    )
    return table(spark, sf_dir, "customer").select("c_custkey", F.round(metres, 3).alias("metres"))


@query(
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
                          l_shipdate, l_quantity, l_tax, l_discount) AS row_number
FROM lineitem"""
)
def row_numbering(spark, sf_dir):
    order = (
        "l_orderkey l_linenumber l_partkey l_suppkey l_extendedprice l_shipdate l_quantity "
        "l_tax l_discount"
    ).split()
    rows = numbered(table(spark, sf_dir, "lineitem").select(*order), order)
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "row_number")


@query(
    """
SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS place
FROM events"""
)
def rank_in_group(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    return rank_within(events, ["event_type"], ["ts", "event_id"], "place").select(
        "event_id", "event_type", "place"
    )


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 50 OFFSET 100")
def page_offset(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return page(orders, "o_orderkey", page=3).rows


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 100 OFFSET 10500")
def page_deep(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return page(orders, "o_orderkey", page=106, per_page=100).rows


@query(
    """
SELECT 3 AS page, 50 AS per_page, count(*) AS total, CAST(ceil(count(*) / 50.0) AS BIGINT) AS total_pages
FROM orders"""
)
def page_totals(spark, sf_dir):
    return page(table(spark, sf_dir, "orders"), "o_orderkey", page=3).totals


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey > 777 ORDER BY o_orderkey LIMIT 50")
def page_keyset(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return page_after(orders, "o_orderkey", 777, 50)


PUBLISHED_SQL = """
SELECT 'page' AS part, doc_id, n_chars, NULL::BIGINT AS total FROM (FROM documents ORDER BY doc_id LIMIT 40 OFFSET 120)
UNION ALL
SELECT 'after', doc_id, n_chars, NULL FROM (FROM documents WHERE doc_id > 77 ORDER BY doc_id LIMIT 130)
UNION ALL
SELECT 'totals', 4, 40, count(*) FROM documents
UNION ALL
SELECT 'search', doc_id, n_chars, NULL FROM documents
WHERE contains(lower(text), 'licen') OR contains(lower(source), 'licen')
UNION ALL
SELECT 'short', doc_id, n_chars, NULL FROM documents
WHERE contains(lower(text), 'th') OR contains(lower(source), 'th')"""


@query(PUBLISHED_SQL)
def published_pages_and_search(spark, sf_dir):
    """A page, the rows after a key, totals and two searches of one published table."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "text", "n_chars")
    published = publish(documents, "doc_id", new_path(spark, "published"), ["text", "source"])
    found = published.page(4, 40)
    parts = {
        "page": found.rows, "after": published.after(77, 130), "search": published.search("Licen"), "short": published.search("TH"),
    }
    rows = [
        df.select(F.lit(part).alias("part"), "doc_id", "n_chars", F.lit(None).cast("long").alias("total"))
        for part, df in parts.items()
    ]
    totals = found.totals.select(
        F.lit("totals").alias("part"), F.col("page").cast("long").alias("doc_id"), F.col("per_page").cast("long").alias("n_chars"), "total"
    )
    return stack(*rows, totals)


@query("SELECT event_id, ts FROM events ORDER BY ts DESC LIMIT 20")
def newest_rows(spark, sf_dir):
    return newest(table(spark, sf_dir, "events").select("event_id", "ts"), "ts", 20)


@query("SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 10")
def top_rows(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return top(customer, [F.desc("c_acctbal"), "c_custkey"], 10)
