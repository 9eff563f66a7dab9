"""Published datasets: current, history, succession, search, statistics, reports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..runs import RunFolder
from ..session import stage
from .joins import within_radius
from .merge import Sources
from .numbering import Page, page as one_page, rank_within, succession_order, top
from .shape import nest, stack, text_search

# Default of ``part_entries``, see ``_documents``.
PART_ENTRIES = 10_000


def current(identities: DataFrame, locations: DataFrame, addresses: DataFrame) -> DataFrame:
    """Flat snapshot: identity, its current location, that location's address."""
    place = addresses.select(
        "address_id",
        "street_address",
        "city",
        "state_province",
        "postal_code",
        "country",
        "latitude",
        "longitude",
        "coordinates_source",
    )
    now = locations.filter("is_current").select(
        "gold_id", "address_id", "source_system", "match_confidence"
    )
    return now.join(identities, "gold_id").join(place, "address_id")


def nested_current(
    flat: DataFrame, left_id: str, right_id: str, sources: Sources, category: str = "category"
) -> DataFrame:
    """The snapshot as documents with nested groups."""
    named = flat.withColumn("id", F.col("gold_id")).withColumn("category", F.col(category))
    return nest(
        named,
        {
            "identifiers": {f"{sources.left}_id": left_id, f"{sources.right}_id": right_id},
            "address": {
                "street": "street_address",
                "city": "city",
                "state": "state_province",
                "postal_code": "postal_code",
                "country": "country",
            },
            "contact": {
                "phone": "phone",
                "phone_source": "phone_source",
                "website": "website_url",
                "website_source": "website_source",
            },
            "location": {
                "latitude": "latitude",
                "longitude": "longitude",
                "coordinates_source": "coordinates_source",
            },
            "enrichment": {
                "membership_status": "membership_status",
                "match_confidence": "match_confidence",
                "source_system": "source_system",
                "enrichment_date": "enrichment_date",
            },
            "metadata": {
                "is_active": "is_active",
                "is_public": "is_public",
                "data_license": "data_license",
                "first_seen": "first_seen",
                "last_seen": "last_seen",
            },
        },
        keep=["id", "name", "category"],
    )


def location_history(locations: DataFrame, addresses: DataFrame, identities: DataFrame) -> DataFrame:
    """Every dated location with its address and the entity's name, one row each."""
    place = addresses.select(
        "address_id",
        "street_address",
        "city",
        "state_province",
        "postal_code",
        "country",
        "latitude",
        "longitude",
    )
    names = identities.select("gold_id", "name")
    return locations.join(place, "address_id").join(names, "gold_id")


def by_address_and_start(rows: DataFrame) -> DataFrame:
    """The location history in its published order."""
    return rows.orderBy("address_id", "valid_from", "gold_id")


def _address_block() -> Column:
    return F.struct(
        F.col("street_address").alias("street"),
        "city",
        F.col("state_province").alias("state"),
        "postal_code",
        "country",
    )


def _documents(
    ranked: DataFrame,
    keys: Sequence[str],
    rank: str,
    array: str,
    count: str,
    fields: dict[str, object],
    part_entries: int,
) -> DataFrame:
    """One row per key and ``part`` with the ranked entries as an array, and the key's total.

    The ranked rows are the published data; this is a nested view of them.  A part
    holds ranks ``part * part_entries + 1`` to ``(part + 1) * part_entries``, so that
    no row holds an unbounded group, and ``part`` always belongs to the key.
    """
    part = F.floor((F.col(rank) - 1) / part_entries)
    parts = ranked.groupBy(*keys, part.alias("part")).agg(
        C.ordered_structs([rank], fields).alias(array)
    )
    totals = ranked.groupBy(*keys).agg(F.count(F.lit(1)).alias(count))
    return parts.join(totals, list(keys))


def ranked_history(rows: DataFrame) -> DataFrame:
    """``location_history`` with ``location_order`` from 1 along each entity's time."""
    return rank_within(rows, ["gold_id"], ["valid_from", "address_id"], "location_order")


def history_documents(rows: DataFrame, part_entries: int = PART_ENTRIES) -> DataFrame:
    """(gold_id, name, part, locations, location_count) from ``location_history``."""
    named = rows.withColumn("name", F.coalesce("name", F.lit("")))
    fields = {
        "address": _address_block(),
        "location": F.struct("latitude", "longitude"),
        "valid_from": "valid_from",
        "valid_to": "valid_to",
        "is_current": "is_current",
        "source_system": "source_system",
    }
    return _documents(
        ranked_history(named), ["gold_id", "name"], "location_order", "locations", "location_count", fields, part_entries
    )


def succession(rows: DataFrame) -> DataFrame:
    """Entities per address in order of arrival, with ``succession_order`` from 1.

    The long form: one row per address and entity, with the address itself.
    """
    return succession_order(
        rows.select(
            "address_id",
            "gold_id",
            "name",
            "valid_from",
            "valid_to",
            "is_current",
            "street_address",
            "city",
            "state_province",
            "postal_code",
            "country",
            "latitude",
            "longitude",
        ),
        "address_id",
        "valid_from",
        "gold_id",
    )


def succession_documents(ordered: DataFrame, part_entries: int = PART_ENTRIES) -> DataFrame:
    """(address_id, address, part, entities, entity_count, public_id) from ``succession``."""
    fields = {
        "id": "gold_id",
        "name": "name",
        "valid_from": "valid_from",
        "valid_to": "valid_to",
        "is_current": "is_current",
        "succession_order": "succession_order",
    }
    documents = _documents(
        ordered, ["address_id"], "succession_order", "entities", "entity_count", fields, part_entries
    )
    first = ordered.filter("succession_order = 1").select(
        "address_id",
        _address_block().alias("address"),
        F.struct("latitude", "longitude").alias("coordinates"),
    )
    return documents.join(first, "address_id").withColumn(
        "public_id", F.concat(F.lit("addr_"), F.col("address_id"))
    )


def search(
    df: DataFrame,
    key: str,
    q: str | None = None,
    near: tuple[float, float] | None = None,
    miles: float = 10,
    page: int = 1,
    per_page: int = 50,
    columns: Sequence[str] = ("name", "city", "state_province"),
) -> Page:
    """Text and radius conditions, each if given, then one page by ``key``."""
    if q:
        df = text_search(df, q, columns)
    if near is not None:
        df = within_radius(df, near[0], near[1], miles)
    return one_page(df, key, page, per_page)


def more_than_one(
    df: DataFrame, keys: Sequence[str], distinct: str, name: str
) -> DataFrame:
    """Groups with more than one distinct value, and how many."""
    return df.groupBy(*keys).agg(F.countDistinct(distinct).alias(name)).filter(F.col(name) > 1)


def _joined_in_order(
    ranked: DataFrame, keys: Sequence[str], rank: str, value, name: str, sep: str, part_entries: int
) -> DataFrame:
    part = F.floor((F.col(rank) - 1) / part_entries)
    return ranked.groupBy(*keys, part.alias("part")).agg(
        C.ordered_concat(value, [rank], sep).alias(name)
    )


def relocations(rows: DataFrame, sep: str = " → ", part_entries: int = PART_ENTRIES) -> DataFrame:
    """Entities seen at several addresses, with their places in order of time."""
    keys = ["gold_id", "name"]
    moved = more_than_one(rows, keys, "address_id", "location_count")
    ranked = rank_within(
        rows.join(moved.select("gold_id"), "gold_id", "left_semi"),
        keys,
        ["valid_from", "address_id"],
        "_rank",
    )
    place = C.concat_strict("city", F.lit(", "), "state_province")
    return _joined_in_order(ranked, keys, "_rank", place, "location_history", sep, part_entries).join(
        moved, keys
    )


def reuse(ordered: DataFrame, sep: str = " → ", part_entries: int = PART_ENTRIES) -> DataFrame:
    """Addresses with several entities over time, with their place and the names in order."""
    several = more_than_one(ordered, ["address_id"], "gold_id", "entity_count")
    kept = ordered.join(several.select("address_id"), "address_id", "left_semi")
    place = ["street_address", "city", "state_province"]
    first = ordered.filter("succession_order = 1").select("address_id", *place)
    return (
        _joined_in_order(
            kept, ["address_id"], "succession_order", "name", "entity_succession", sep, part_entries
        )
        .join(several, "address_id")
        .join(first, "address_id")
        .select("address_id", *place, "part", "entity_succession", "entity_count")
    )


def by_use(reused: DataFrame) -> DataFrame:
    """``reuse`` in its published order: most entities first."""
    return reused.orderBy(F.desc("entity_count"), "address_id", "part")


def provenance(flat: DataFrame, source: str) -> DataFrame:
    """Per source flag: entities, fields that ``source`` supplied, and public rows."""
    return flat.groupBy("source_system").agg(
        F.count(F.lit(1)).alias("entity_count"),
        C.count_where(F.col("phone_source") == source).alias("phone_count"),
        C.count_where(F.col("website_source") == source).alias("website_count"),
        C.count_where(C.is_true("is_public")).alias("public_count"),
    )


def _measures(sources: Sources) -> dict:
    def supplied(column: str, label: str):
        return F.col(column) == label

    return {
        "entities": F.lit(True),
        "active": C.is_true("is_active"),
        "with_coordinates": C.present("latitude") & C.present("longitude"),
        "with_phone": C.present("phone"),
        "with_website": C.present("website_url"),
        "enriched": F.col("source_system") != sources.left,
        f"phone_from_{sources.left}": supplied("phone_source", sources.left),
        f"phone_from_{sources.right}": supplied("phone_source", sources.right),
        f"website_from_{sources.left}": supplied("website_source", sources.left),
        f"website_from_{sources.right}": supplied("website_source", sources.right),
    }


_SUMMARY_KEYS = ("source_system", "category", "country")


def statistics_summary(flat: DataFrame, sources: Sources, category: str = "category") -> DataFrame:
    """Counts per (source, category, country), which add and subtract: all that statistics need."""
    keys = ("source_system", F.col(category).alias("category"), F.col("country").alias("country"))
    return flat.groupBy(*keys).agg(*[C.count_where(m).alias(n) for n, m in _measures(sources).items()])


def added_summaries(summaries: DataFrame, sources: Sources) -> DataFrame:
    """One summary row per key; keys of which nothing is left go."""
    measures = list(_measures(sources))
    added = summaries.groupBy(*_SUMMARY_KEYS).agg(*[F.sum(n).alias(n) for n in measures])
    return added.filter(F.greatest(F.lit(0), *[F.abs(F.col(n)) for n in measures]) > 0)


class StatisticsLog:
    """Summaries in a folder of runs: each load adds what came and subtracts what went.

    Statistics after a load read these rows only, of which a load has one per key that it touched.
    """

    def __init__(self, spark: SparkSession, path: str, sources: Sources, category: str = "category"):
        self.runs, self.sources, self.category = RunFolder(spark, path), sources, category
        counts = ", ".join(f"{n} bigint" for n in _measures(sources))
        self.schema = f"source_system string, category string, country string, {counts}"

    def load(self, came: DataFrame, gone: DataFrame | None = None) -> None:
        """``came`` has new rows and changed ones as they are now, ``gone`` the rows that these replace or that ended."""
        change = statistics_summary(came, self.sources, self.category)
        if gone is not None:
            less = statistics_summary(gone, self.sources, self.category)
            change = stack(change, less.withColumns({n: -F.col(n) for n in _measures(self.sources)}))
        self.runs.write(self.runs.next_number(), {"summaries": added_summaries(change, self.sources)})

    def summary(self) -> DataFrame:
        return added_summaries(self.runs.read("summaries", self.schema), self.sources)

    def statistics(self, top_countries: int = 4) -> DataFrame:
        return statistics_of(self.summary(), self.sources, top_countries)

    def compact(self) -> None:
        self.runs.write(self.runs.next_number(), {"summaries": self.summary()}, base=True)


def statistics(
    flat: DataFrame, sources: Sources, category: str = "category", top_countries: int = 4
) -> DataFrame:
    """(section, key, n): totals, by source, by category, by country with the rest as Other."""
    return statistics_of(statistics_summary(flat, sources, category), sources, top_countries)


def statistics_of(summary: DataFrame, sources: Sources, top_countries: int = 4) -> DataFrame:
    """Statistics from summary rows, which are staged; every section sums those few rows."""
    measures = _measures(sources)
    base = stage(summary, "statistics")

    totals = base.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in measures])
    entries = ", ".join(f"'{n}', {n}" for n in measures)
    total_rows = totals.selectExpr(f"stack({len(measures)}, {entries}) AS (key, n)").select(
        F.lit("total").alias("section"), "key", "n"
    )

    def by(column: str, section: str) -> DataFrame:
        return base.groupBy(F.col(column).alias("key")).agg(F.sum("entities").alias("n")).select(
            F.lit(section).alias("section"), "key", "n"
        )

    countries = by("country", "by_country")
    leading = top(countries, [F.desc("n"), F.asc_nulls_last("key")], top_countries)
    listed = leading.agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()
    other = totals.select(
        F.lit("by_country").alias("section"),
        F.lit("Other").alias("key"),
        (F.col("entities") - listed).alias("n"),
    ).filter("n > 0")
    return stack(
        total_rows, by("source_system", "by_source"), by("category", "by_category"), leading, other
    )


def statistics_document(
    tall: DataFrame, sources: Sources, categories: Sequence[str], countries: int = 4
) -> DataFrame:
    """The statistics as one nested row; categories outside the list add up to Other."""

    def pick(section: str, key: str):
        return F.coalesce(
            F.sum(F.when((F.col("section") == section) & (F.col("key") == key), F.col("n"))),
            F.lit(0),
        )

    def struct(pairs: dict):
        return F.struct(*[c.alias(n) for n, c in pairs.items()])

    known = {c: pick("by_category", c) for c in categories}
    listed = reduce(lambda a, b: a + b, known.values())
    in_category = F.coalesce(F.sum(F.when(F.col("section") == "by_category", F.col("n"))), F.lit(0))
    country = F.when(F.col("section") == "by_country", F.struct(F.col("key"), F.col("n")))
    return tall.agg(
        pick("total", "entities").alias("total"),
        pick("total", "active").alias("active"),
        struct(
            {
                f"{sources.left}_only": pick("by_source", sources.left),
                f"{sources.right}_only": pick("by_source", sources.right),
                "matched": pick("by_source", "both"),
            }
        ).alias("by_source"),
        struct({**known, "Other": in_category - listed}).alias("by_category"),
        # At most ``countries`` + 1 entries by construction.
        F.array_sort(F.collect_list(country)).alias("by_country"),
        struct(
            {
                n: pick("total", n)
                for n in ("with_coordinates", "with_phone", "with_website", "enriched")
            }
        ).alias("data_quality"),
        struct(
            {
                n: pick("total", n)
                for n in _measures(sources)
                if n.startswith(("phone_from_", "website_from_"))
            }
        ).alias("provenance"),
    )


def histogram(df: DataFrame, column: str, width: float) -> DataFrame:
    """(bucket, n): rows per band of ``width``, by the band's lower edge."""
    bucket = F.floor(F.col(column) / width)
    return (
        df.filter(C.present(column))
        .groupBy(bucket.alias("_b"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.round(F.col("_b") * width, 9).alias("bucket"), "n")
    )
