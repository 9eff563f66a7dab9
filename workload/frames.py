"""Input frames for the queries: the driver tables arranged as two entity feeds.

Each non-blank line of every document is one record.  Short source codes make the
flat feed, longer ones the nested feed; exact and near copies of lines across them
are what linking finds.  The expressions are shared by Spark and the oracle, since
they only prepare inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.plans import presets as P

from recordloom.operators.merge import Sources

SOURCES = Sources("first", "second")

FLAT = {
    "id": "concat(CAST(doc_id AS STRING), '-', CAST(line_no AS STRING))",
    "name": "line",
    "brewery_type": (
        "CASE line_no % 12 WHEN 0 THEN 'micro' WHEN 1 THEN 'nano' WHEN 2 THEN 'taproom' "
        "WHEN 3 THEN 'bar' WHEN 4 THEN 'beergarden' WHEN 5 THEN 'brewpub' "
        "WHEN 6 THEN 'regional' WHEN 7 THEN 'contract' WHEN 8 THEN 'large' "
        "WHEN 9 THEN 'Micro' WHEN 10 THEN 'planning' END"
    ),
    "address_1": "CASE WHEN line_no % 7 = 6 THEN NULL ELSE concat(CAST(doc_id % 97 AS STRING), ' Main Street') END",
    "address_2": "CASE WHEN line_no % 5 = 4 THEN concat('Suite ', CAST(line_no AS STRING)) END",
    "address_3": "CASE WHEN line_no % 11 = 10 THEN '' END",
    "city": "first_word",
    "state_province": "lang",
    "postal_code": "lpad(CAST(doc_id % 100000 AS STRING), 5, '0')",
    "country": "CASE WHEN lang = 'de' THEN 'Germany' ELSE ' United States ' END",
    "phone": (
        "CASE WHEN line_no % 3 = 0 THEN NULL WHEN line_no % 3 = 1 THEN "
        "lpad(CAST(doc_id AS STRING), 10, '5') ELSE '503-555-1234' END"
    ),
    "website_url": "CASE WHEN line_no % 2 = 0 THEN concat('https://', source, '.example/') END",
    "longitude": "CAST((doc_id * 53 + line_no) % 4000 AS DOUBLE) / 10 - 200",
    "latitude": "CAST((doc_id * 37 + line_no) % 2000 AS DOUBLE) / 10 - 100",
}

NESTED = {
    "Id": FLAT["id"],
    "Name": "line",
    "Brewery_Type__c": (
        "CASE line_no % 8 WHEN 0 THEN 'Micro' WHEN 1 THEN 'Brewpub' WHEN 2 THEN 'Taproom' "
        "WHEN 3 THEN 'Alt Prop' WHEN 4 THEN 'Location' WHEN 5 THEN 'Regional' "
        "WHEN 6 THEN 'location' ELSE CASE WHEN doc_id % 2 = 0 THEN 'Large' END END"
    ),
    "Phone": "CASE WHEN line_no % 4 <> 3 THEN lpad(CAST(doc_id AS STRING), 10, '7') END",
    "Website": "CASE WHEN line_no % 3 <> 2 THEN concat('https://', source, '.example/m') END",
    "Membership_Record_Status__c": "CASE WHEN doc_id % 5 = 4 THEN 'Lapsed' ELSE 'Active' END",
    "Is_Craft_Brewery__c": "CASE WHEN line_no % 10 = 9 THEN NULL ELSE line_no % 10 <> 8 END",
    "street": "concat(CAST(doc_id % 97 AS STRING), ' Main St')",
    "city": "first_word",
    "state": "lang",
    "postalCode": FLAT["postal_code"],
    "country": "CASE WHEN lang = 'de' THEN 'Germany' ELSE 'United States' END",
    "latitude": FLAT["latitude"],
    "longitude": FLAT["longitude"],
}
_ADDRESS = ("street", "city", "state", "postalCode", "country", "latitude", "longitude")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    return (
        documents.select("doc_id", "source", "lang", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
        .filter(F.trim("line") != "")
        .withColumn("line_no", F.col("line_no").cast("bigint"))
        .withColumn("first_word", F.substring_index(F.trim("line"), " ", 1))
    )


def raw_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = lines(spark, sf_dir).filter("length(source) <= 4")
    return feed.selectExpr(*[f"{e} AS {n}" for n, e in FLAT.items()])


def raw_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = lines(spark, sf_dir).filter("length(source) > 4")
    top = [f"{e} AS {n}" for n, e in NESTED.items() if n not in _ADDRESS]
    address = ", ".join(f"'{n}', {NESTED[n]}" for n in _ADDRESS)
    return feed.selectExpr(*top, f"named_struct({address}) AS BillingAddress")


# The same feeds for the oracle, as common table expressions.
LINES_SQL = """
lines AS (
  SELECT doc_id, source, lang, line_no, line, split_part(trim(line, ' '), ' ', 1) AS first_word
  FROM (
    SELECT doc_id, source, lang, unnest(string_split(text, chr(10))) AS line,
           generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no
    FROM documents)
  WHERE trim(line, ' ') <> '')"""

RAW_FLAT_SQL = (
    "raw_flat AS (SELECT "
    + ", ".join(f"{e} AS {n}" for n, e in FLAT.items())
    + " FROM lines WHERE length(source) <= 4)"
)
RAW_NESTED_SQL = (
    "raw_nested AS (SELECT "
    + ", ".join(f"{e} AS {n}" for n, e in NESTED.items() if n not in _ADDRESS)
    + ", {"
    + ", ".join(f"'{n}': {NESTED[n]}" for n in _ADDRESS)
    + "} AS BillingAddress FROM lines WHERE length(source) > 4)"
)

def _bounded(value: str, limit: int) -> str:
    """A coordinate as a decimal, NULL beyond its limit."""
    return f"CAST(if(abs({value}) <= {limit}, {value}, NULL) AS DECIMAL(10,6))"


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" for v in row) + ")" for row in rows)


# Standard feeds from tables of rules: categories by word, excluded types by name.
LEFT_SQL = f"""
category_words(word, category) AS (VALUES {_values(P.CATEGORIES.items())}),
lft AS (
  SELECT f.id AS brewery_id, f.name, ifnull(c.category, 'Unknown') AS brewery_type, a.street_address,
         f.city, f.state_province, f.postal_code, f.country,
         {_bounded("f.longitude", 180)} AS longitude, {_bounded("f.latitude", 90)} AS latitude,
         if(len(f.phone) = 10, concat('+1', f.phone), NULL) AS phone, f.website_url
  FROM raw_flat f
  LEFT JOIN category_words c ON c.word = f.brewery_type,
  LATERAL (SELECT trim(array_to_string(
    list_filter([f.address_1, f.address_2, f.address_3], lambda part: part IS NOT NULL), ' ')) AS street_address) a)"""
RIGHT_SQL = f"""
excluded(kind) AS (VALUES {_values((t,) for t in P.EXCLUDED_TYPES)}),
rgt AS (
  SELECT n.Id AS partner_brewery_id, n.Name AS name, lower(n.Brewery_Type__c) AS brewery_type,
         b.street AS street_address, b.city, b.state AS state_province, b.postalCode AS postal_code, b.country,
         n.Phone AS phone, n.Website AS website_url,
         {_bounded("b.latitude", 90)} AS latitude, {_bounded("b.longitude", 180)} AS longitude,
         n.Membership_Record_Status__c AS membership_status
  FROM raw_nested n, LATERAL (SELECT unnest(n.BillingAddress)) b
  WHERE n.Is_Craft_Brewery__c AND n.Brewery_Type__c IS NOT NULL
    AND NOT EXISTS (FROM excluded e WHERE e.kind = n.Brewery_Type__c))"""


def _keyed(name: str, source: str, id_column: str) -> str:
    keys = ", ".join(f"lower(trim({k})) AS {k}" for k in P.MATCH_KEYS)
    return f"{name} AS (SELECT {id_column}, {keys} FROM {source} WHERE trim(country) = '{P.COUNTRY}')"


KEYS_SQL = _keyed("lkey", "lft", P.LEFT_ID) + ",\n" + _keyed("rkey", "rgt", P.RIGHT_ID)
# Every pair that a rule proposes, numbered by rule; a later rule's pair stands only if no
# earlier rule used either id.  Ids are never NULL in these feeds, so NOT EXISTS says what
# NOT IN says.
LINKS_SQL = """
proposed AS (
  SELECT 1 AS rule, brewery_id, partner_brewery_id, 1.0::DOUBLE AS score
  FROM lkey JOIN rkey USING (state_province, name)
  UNION ALL
  SELECT 2, l.brewery_id, r.partner_brewery_id, likeness.score
  FROM lkey l JOIN rkey r USING (state_province, city),
       LATERAL (SELECT jaro_winkler_similarity(l.name, r.name) AS score) likeness
  WHERE likeness.score > 0.90),
links AS (
  SELECT brewery_id, partner_brewery_id, ['exact_name_state', 'fuzzy_name_city'][rule] AS match_strategy, score
  FROM proposed p
  WHERE NOT EXISTS (FROM proposed e WHERE e.rule < p.rule AND e.brewery_id = p.brewery_id)
    AND NOT EXISTS (FROM proposed e WHERE e.rule < p.rule AND e.partner_brewery_id = p.partner_brewery_id))"""


def with_feeds(body: str, *more: str) -> str:
    """A WITH clause holding both standard feeds and further expressions, then the body."""
    parts = (LINES_SQL, RAW_FLAT_SQL, RAW_NESTED_SQL, LEFT_SQL, RIGHT_SQL, *more)
    return "WITH " + ",\n".join(p.strip() for p in parts) + "\n" + body.strip()


def with_links(body: str, *more: str) -> str:
    return with_feeds(body, KEYS_SQL, LINKS_SQL, *more)
