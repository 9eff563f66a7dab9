"""Feeds written out and read back, loads with their log, exports.

Files go to a new folder under the session's checkpoint folder.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.operators import quality as Q
from recordloom.plans import models
from recordloom.plans import presets as P
from recordloom.plans.loads import LoadJob, run_load, run_loads, run_pipeline
from recordloom.session import checkpoint_root
from recordloom.sources import feeds as R
from recordloom.sources import tables as S

from .frames import SOURCES, raw_flat, raw_nested, table, with_feeds, with_links
from .linking import MERGED_SQL
from .registry import query

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


def fresh(spark, label: str) -> str:
    return f"{checkpoint_root(spark)}/{label}-{uuid.uuid4().hex}"


@query("SELECT doc_id, nullif(text, 'NA') AS text, lang, source, n_chars FROM documents")
def delimited_round_trip(spark, sf_dir):
    path = fresh(spark, "csv")
    documents = table(spark, sf_dir, "documents")
    documents.write.options(header=True, quote='"', escape='"').csv(path)
    return R.read_delimited(spark, path, DOCUMENTS)


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def delimited_files_of_two_headers(spark, sf_dir):
    """One folder, two orders of the same columns."""
    path = fresh(spark, "headers")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    options = {"header": True, "quote": '"', "escape": '"'}
    customers.filter("c_custkey % 2 = 0").write.options(**options).csv(f"{path}/even")
    odd = customers.filter("c_custkey % 2 = 1").select("c_acctbal", "c_custkey", "c_name")
    odd.write.options(**options).csv(f"{path}/odd")
    schema = T.StructType.fromDDL("c_custkey long, c_name string, c_acctbal double")
    return R.read_delimited(spark, [f"{path}/even", f"{path}/odd"], schema)


@query(
    """SELECT event_id, user_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events"""
)
def json_array_read(spark, sf_dir):
    """Indented arrays of records with a nested object, some thousand records in each and one in a file."""
    path = fresh(spark, "arrays")
    record = F.struct(
        "event_id", F.struct("user_id", "event_type").alias("who"), F.from_json("props", "k long").alias("props")
    )
    events = table(spark, sf_dir, "events")
    chunks = -(-events.count() // 1000)
    chunk = F.pmod(F.xxhash64("event_id"), F.lit(chunks)).alias("chunk")
    arrays = events.groupBy(chunk).agg(F.collect_list(record).alias("records"))
    arrays.select(F.to_json("records", {"pretty": "true"}).alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    schema = T.StructType.fromDDL(
        "event_id long, who struct<user_id: long, event_type: string>, props struct<k: long>"
    )
    back = R.read_json_records(spark, path, schema)
    return back.select("event_id", "who.user_id", "who.event_type", "props.k")


@query("SELECT kind, c_mktsegment, count(*) AS n FROM customer, (SELECT unnest(['inline', 'table', 'view']) AS kind) GROUP BY ALL")
def materialized_kinds(spark, sf_dir):
    """One model as a view, a table and inlined."""
    root = fresh(spark, "models")
    model = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    parts = [
        S.materialize(model, f"customers_{kind}", kind, root).select(F.lit(kind).alias("kind"), "c_mktsegment")
        for kind in ("inline", "table", "view")
    ]
    return reduce(DataFrame.unionByName, parts).groupBy("kind", "c_mktsegment").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT doc_id, text, lang, source, n_chars FROM documents")
def json_records_round_trip(spark, sf_dir):
    path = fresh(spark, "json")
    S.export_jsonl(table(spark, sf_dir, "documents"), path)
    return R.read_json_records(spark, path, DOCUMENTS, multiline=False)


@query(
    """SELECT o_orderkey AS order_key, o_custkey AS "who_customer", o_orderpriority AS "who_priority_name",
       o_totalprice AS price FROM orders"""
)
def export_flat(spark, sf_dir):
    path = fresh(spark, "flat")
    nested = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_key"),
        F.struct(
            F.col("o_custkey").alias("customer"),
            F.struct(F.col("o_orderpriority").alias("name")).alias("priority"),
        ).alias("who"),
        F.col("o_totalprice").alias("price"),
    )
    S.export_csv_flat(nested, path)
    schema = "order_key long, who_customer long, who_priority_name string, price double"
    return R.read_delimited(spark, path, T.StructType.fromDDL(schema), embedded_newlines=False)


@query(
    with_feeds(
        """SELECT Id, Name, BillingAddress.city AS city, BillingAddress.latitude AS latitude FROM raw_nested"""
    )
)
def landed_snapshot(spark, sf_dir):
    path = fresh(spark, "landed")

    def land():
        return R.read_or_land(spark, path, P.NESTED_SCHEMA, lambda: raw_nested(spark, sf_dir))

    land()
    return land().select("Id", "Name", "BillingAddress.city", "BillingAddress.latitude")


@query(
    """SELECT vec_id, label, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS place, unnest(embedding) AS value
FROM embeddings"""
)
def export_nested_table(spark, sf_dir):
    path = fresh(spark, "nested")
    S.export_parquet(table(spark, sf_dir, "embeddings"), path)
    back = S.publish_view(spark.read.parquet(path), "embeddings_export")
    return back.select("vec_id", "label", F.posexplode("embedding").alias("place", "value"))


def _jobs(sf_dir):
    return (
        LoadJob(
            "first_csv",
            "raw_flat",
            lambda spark: raw_flat(spark, sf_dir),
            Q.FeedChecks("first feed", P.FLAT_COLUMNS, P.COORDINATE_COLUMNS, P.COORDINATE_COLUMNS),
        ),
        LoadJob(
            "second_json", "raw_nested", lambda spark: raw_nested(spark, sf_dir), Q.FeedChecks("second feed")
        ),
    )


@query(
    with_feeds(
        """
SELECT 'first_csv' AS source, 'raw_flat' AS table_name, count(*) AS row_count, 'success' AS status,
       CAST(NULL AS VARCHAR) AS note, '{"row_count": ' || count(*) ||
       ', "null_pct_latitude": 0.0, "null_pct_longitude": 0.0}' AS metrics_json FROM raw_flat
UNION ALL
SELECT 'second_json', 'raw_nested', count(*), 'success', NULL, '{"row_count": ' || count(*) || '}' FROM raw_nested
UNION ALL
SELECT 'bad', 'raw_flat', 0, 'failed', 'bad feed: columns entirely null [''latitude'']', NULL"""
    )
)
def run_log(spark, sf_dir):
    root = fresh(spark, "tables")
    log = f"{root}/ingest_runs"
    run_loads(spark, _jobs(sf_dir), root, log)
    bad = LoadJob(
        "bad",
        "raw_flat",
        lambda s: raw_flat(s, sf_dir).withColumn("latitude", F.lit(None).cast("double")),
        Q.FeedChecks("bad feed", some_known=["latitude"]),
    )
    try:
        run_load(spark, bad, root, log)
    except Q.CheckError:
        pass
    return S.recent_runs(spark, log).select(
        "source", "table_name", "row_count", "status", "note", "metrics_json"
    )


def _tests(frames):
    staged, dim, partner = frames["raw_flat"], frames["standard_flat"], frames["standard_nested"]
    tests = [
        Q.TableRules(
            staged,
            [
                Q.null_rule(f"flat_{c}_not_null", c)
                for c in ("id", "name", "city", "state_province", "country")
            ],
        ),
        Q.DataTest("flat_id_unique", Q.unique(staged, "id")),
        Q.TableRules(
            frames["raw_nested"],
            [
                Q.null_rule("nested_Id_not_null", "Id"),
                Q.null_rule("nested_Name_not_null", "Name"),
                Q.null_rule("nested_city_not_null", "BillingAddress.city"),
                Q.null_rule("nested_state_not_null", "BillingAddress.state"),
                Q.null_rule("nested_country_not_null", "BillingAddress.country"),
            ],
        ),
        Q.DataTest("nested_Id_unique", Q.unique(frames["raw_nested"], "Id")),
        Q.TableRules(
            dim,
            [
                Q.null_rule("dim_id_not_null", P.LEFT_ID),
                Q.null_rule("dim_type_not_null", "brewery_type"),
                Q.values_rule("dim_type_accepted", "brewery_type", P.ACCEPTED_CATEGORIES),
                Q.null_rule("dim_country_not_null", "country"),
            ],
        ),
        Q.DataTest("dim_id_unique", Q.unique(dim, P.LEFT_ID)),
        Q.TableRules(
            partner,
            [
                Q.null_rule("partner_id_not_null", P.RIGHT_ID),
                Q.null_rule("partner_country_not_null", "country"),
            ],
        ),
        Q.DataTest("partner_id_unique", Q.unique(partner, P.RIGHT_ID)),
    ]
    return tests


MODELS = {
    "standard_flat": lambda f: models.standard_flat(f["raw_flat"]),
    "standard_nested": lambda f: models.standard_nested(f["raw_nested"]),
    "links": lambda f: models.linked(f["standard_flat"], f["standard_nested"]),
    "merged": lambda f: models.merged(
        f["standard_flat"], f["standard_nested"], f["links"], SOURCES
    ),
}


@query(
    with_links(
        "SELECT * FROM merged",
        MERGED_SQL,
    )
)
def whole_run(spark, sf_dir):
    """Loads, models as tables, tests; the published merge with every column."""
    root = fresh(spark, "run")
    frames, _ = run_pipeline(spark, _jobs(sf_dir), MODELS, _tests, root, f"{root}/ingest_runs")
    return frames["merged"]
