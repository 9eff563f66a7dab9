"""Record linkage between two feeds: exact keys, then blocked fuzzy text on the rest."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions.geo import haversine_m
from ..functions.similarity import (
    SIGNATURE_COLUMNS,
    could_exceed,
    jaro_winkler,
    with_signature,
)
from ..session import stage
from . import text_index
from .decisions import APPROVED, approved_pairs, without_rejected
from .joins import CHUNK_ROWS, anti_not_in, by_shuffle, hot_keys, split_hot_keys
from .numbering import best_per, number_rows
from .shape import stack

# Distinct texts of one block that meet in one task, per side: the default of ``text_rows``.
# A pair here costs far more than the bytes of its two rows, so chunks are small.
SCORED_CHUNK_ROWS = 512
# Text pairs of a block up to which counting postings is not worth it: the default of ``index_pairs``.
INDEX_PAIRS = 1 << 20
# Ids in an array of ``exact_pairs``: the default of its ``chunk_rows``.  Spark holds the pairs of two
# arrays at once, so arrays are small.
PAIRED_ROWS = 256
# Pairs of ids that a task of ``exact_pairs`` writes, on average.
TASK_PAIRS = 1 << 22


@dataclass(frozen=True)
class LinkRule:
    """Equal ``keys`` make a link; with ``text``, its score must also pass ``threshold``."""

    name: str
    keys: Sequence[str]
    text: str | None = None
    threshold: float = 0.90


# The two rules of the standard run, in order.
STANDARD_RULES = (
    LinkRule("exact_name_state", ("name", "state_province")),
    LinkRule("fuzzy_name_city", ("state_province", "city"), "name", 0.90),
)


def match_frame(
    df: DataFrame, id_column: str, keys: Sequence[str], where: Column | None = None
) -> DataFrame:
    """Id and normalized match keys of the rows that take part in linking."""
    if where is not None:
        df = df.filter(where)
    return df.select(id_column, *[C.match_key(k).alias(k) for k in keys])


def exact_pairs(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_id: str,
    right_id: str,
    chunk_rows: int = PAIRED_ROWS,
) -> DataFrame:
    """Every pair with equal keys; NULL keys never match.

    The result is many-to-many by definition, so the work lies in its pairs, not in the rows read.  Keys
    that both sides hold get a number, and their ids go into arrays of some ``chunk_rows``.  Each array
    meets each one of the other side, and there are as many partitions as the pairs ask for, whatever
    their bytes.  Keys are not sent along with the arrays.
    """
    keys = list(keys)
    a = left.select(F.col(left_id).alias("_left"), *keys).dropna(subset=keys)
    b = right.select(F.col(right_id).alias("_right"), *keys).dropna(subset=keys)

    def sizes(df: DataFrame, side: str) -> DataFrame:
        return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(f"{side}_rows"))

    shared = stage(
        sizes(a, "_left").join(sizes(b, "_right"), keys).withColumn("_key", F.monotonically_increasing_id()), "shared-keys"
    )
    pairs = shared.agg(F.sum(F.col("_left_rows") * F.col("_right_rows"))).first()[0] or 0
    # An explicit count keeps Spark from merging partitions that are small in bytes but not in pairs.
    parts = max(a.sparkSession.sparkContext.defaultParallelism, pairs // TASK_PAIRS)

    def arrays(df: DataFrame, own: str, other: str) -> DataFrame:
        """Arrays of ids, once for every array of the other side."""
        chunks = [F.ceil(F.col(f"{s}_rows") / chunk_rows).alias(f"{s}_chunks") for s in (own, other)]
        rows = df.join(shared, keys).select("_key", own, *chunks)
        # Staged for the numbers: rows of one id, or of none, are spread over arrays as any others.
        rows = stage(rows.withColumn("_row", F.monotonically_increasing_id()), "shared-rows")
        return (
            rows.groupBy("_key", F.pmod(F.xxhash64("_row"), f"{own}_chunks").alias(f"{own}_chunk"), f"{other}_chunks")
            .agg(F.collect_list(F.struct(own)).alias(f"{own}_ids"))
            .withColumn(f"{other}_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"{other}_chunks") - 1)))
            .drop(f"{other}_chunks")
            .repartition(parts, "_key", "_left_chunk", "_right_chunk")
        )

    met = arrays(a, "_left", "_right").join(arrays(b, "_right", "_left"), ["_key", "_left_chunk", "_right_chunk"])
    listed = met.select(F.explode("_left_ids._left").alias(left_id), "_right_ids")
    return listed.select(left_id, F.explode("_right_ids._right").alias(right_id))


def _sketched(df: DataFrame, block: Sequence[str], text: str) -> DataFrame:
    """Distinct texts by block with their sketches and an id; staged, since several steps read them."""
    texts = df.select(*block, F.col(text).alias("_text")).dropna().distinct()
    rows = with_signature(texts, "_text").filter("size > 0")
    return stage(rows.withColumn("_id", F.monotonically_increasing_id()), "texts")


def _side(df: DataFrame, suffix: str) -> DataFrame:
    return df.withColumnsRenamed({c: f"{c}_{suffix}" for c in ("_id", "_text", *SIGNATURE_COLUMNS)})


def _met_by_product(a: DataFrame, b: DataFrame, block: Sequence[str], threshold: float, text_rows: int) -> DataFrame:
    """(block, _text_a, _text_b) of blocks whose texts all meet, large ones chunk by chunk.

    The native bound is part of the join condition, so pairs it rules out never leave the join.
    """
    a, b = _side(a, "a"), _side(b, "b")
    hot = hot_keys(a, b, block, text_rows)
    # The work here is pairs, not bytes: an explicit count keeps the partitions from
    # being merged, with one for every pair of chunks.
    chunk_pairs = hot.agg(F.sum(F.col("_left_chunks") * F.col("_right_chunks"))).first()[0] or 0
    spark = a.sparkSession
    parts = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")),
        4 * spark.sparkContext.defaultParallelism,
        int(chunk_pairs),
    )
    a, b, keys = split_hot_keys(a, b, block, F.col("_text_a"), F.col("_text_b"), text_rows, hot)
    a, b = a.repartition(parts, *keys), b.repartition(parts, *keys)
    return a.join(b, keys).filter(could_exceed("a", "b", threshold)).select(*block, "_text_a", "_text_b")


def _met_by_index(
    a: DataFrame, b: DataFrame, posted: tuple[DataFrame, DataFrame], block: Sequence[str], threshold: float
) -> DataFrame:
    """(block, _text_a, _text_b) of pairs that meet in the index; texts are fetched for what is left."""
    ids = text_index.candidates(*posted, block, threshold)
    left = a.select(*block, F.col("_id").alias("_id_a"), F.col("_text").alias("_text_a"))
    right = b.select(*block, F.col("_id").alias("_id_b"), F.col("_text").alias("_text_b"))
    return ids.join(left, [*block, "_id_a"]).join(right, [*block, "_id_b"]).select(*block, "_text_a", "_text_b")


def candidate_texts(
    a: DataFrame, b: DataFrame, block: Sequence[str], threshold: float,
    text_rows: int = SCORED_CHUNK_ROWS, index_pairs: int = INDEX_PAIRS,
) -> DataFrame:
    """(block, _text_a, _text_b): pairs of sketched texts that may score above the threshold.

    A block of at most ``index_pairs`` pairs is paired up outright.  For a larger one the postings of
    the index are counted first, and the index is taken if its texts meet less often there.
    Both ways find every pair that passes, so the choice is about work only.
    """
    count = F.count(F.lit(1))
    pairs = a.groupBy(*block).agg(count.alias("_a")).join(b.groupBy(*block).agg(count.alias("_b")), list(block))
    large = stage(
        pairs.select(*block, (F.col("_a") * F.col("_b")).alias("_pairs")).filter(F.col("_pairs") > index_pairs), "blocks"
    )
    if large.isEmpty():
        return _met_by_product(a, b, block, threshold, text_rows)
    in_large = large.select(*block)
    large_a = stage(a.join(in_large, list(block), "left_semi"), "texts")
    large_b = large_a if b is a else stage(b.join(in_large, list(block), "left_semi"), "texts")
    posted = text_index.staged_postings(large_a, large_b, block, threshold)
    met = large.join(text_index.meetings(*posted, block), list(block), "left")
    # A block of which no two texts share an item has no pair at all.
    indexed = stage(met.filter(F.coalesce("_meetings", F.lit(0)) < F.col("_pairs")).select(*block), "blocks")
    chosen = tuple(p.join(indexed, list(block), "left_semi") for p in posted)
    rest_a = a.join(indexed, list(block), "left_anti")
    rest_b = rest_a if b is a else b.join(indexed, list(block), "left_anti")
    return stack(
        _met_by_product(rest_a, rest_b, block, threshold, text_rows),
        _met_by_index(large_a, large_b, chosen, block, threshold),
    )


def similar_texts(
    left: DataFrame,
    right: DataFrame,
    block: Sequence[str],
    text: str,
    threshold: float,
    inclusive: bool = False,
    text_rows: int = SCORED_CHUNK_ROWS,
    index_pairs: int = INDEX_PAIRS,
) -> DataFrame:
    """Distinct text pairs of a block scoring above the threshold: (block, _text_a, _text_b, score).

    Copies collapse before any pairing.  ``candidate_texts`` finds the pairs that may
    pass, and only those are scored.
    """
    block = list(block)
    a = _sketched(left, block, text)
    b = a if right is left else _sketched(right, block, text)
    score = F.col("score")
    found = candidate_texts(a, b, block, threshold, text_rows, index_pairs)
    return found.withColumn("score", jaro_winkler("_text_a", "_text_b")).filter(
        score >= threshold if inclusive else score > threshold
    )


def fuzzy_pairs(
    left: DataFrame,
    right: DataFrame,
    block: Sequence[str],
    text: str,
    threshold: float,
    left_id: str,
    right_id: str,
    inclusive: bool = False,
    text_rows: int = SCORED_CHUNK_ROWS,
    chunk_rows: int = CHUNK_ROWS,
    index_pairs: int = INDEX_PAIRS,
) -> DataFrame:
    """Pairs with equal block keys whose text scores above the threshold: ids and score.

    Copies of a text come back in chunks of ``chunk_rows``: a pair of texts is repeated
    for every pair of chunks, each side fetches the rows of its chunk, and the two
    meet on texts and chunks.  Texts with more copies than that are few, and only they are listed.  A task thus writes at most ``chunk_rows`` squared pairs of
    two texts, however often they occur.
    """
    block = list(block)

    def copies(df: DataFrame, id_column: str, side: str) -> tuple[DataFrame, DataFrame]:
        """Chunk counts of the texts with more than one chunk, and the rows with their chunk."""
        rows = df.select(id_column, *block, F.col(text).alias(f"_text_{side}")).dropna(subset=[*block, f"_text_{side}"])
        on = [*block, f"_text_{side}"]
        counts = rows.groupBy(*on).agg(F.ceil(F.count(F.lit(1)) / chunk_rows).alias(f"_chunks_{side}"))
        hot = stage(counts.filter(F.col(f"_chunks_{side}") > 1), "hot-texts")
        chunk = F.pmod(F.xxhash64(id_column), F.coalesce(f"_chunks_{side}", F.lit(1)))
        return hot, rows.join(hot, on, "left").withColumn(f"_chunk_{side}", chunk).drop(f"_chunks_{side}")

    a_chunks, a = copies(left, left_id, "a")
    b_chunks, b = copies(right, right_id, "b")
    zero = F.lit(0).cast("long")
    pairs = stage(
        similar_texts(left, right, block, text, threshold, inclusive, text_rows, index_pairs)
        .join(a_chunks, [*block, "_text_a"], "left")
        .join(b_chunks, [*block, "_text_b"], "left")
        .withColumn("_chunk_a", F.explode(F.sequence(zero, F.coalesce("_chunks_a", F.lit(1)) - 1)))
        .withColumn("_chunk_b", F.explode(F.sequence(zero, F.coalesce("_chunks_b", F.lit(1)) - 1)))
        .drop("_chunks_a", "_chunks_b"),
        "similar",
    )
    both = [*block, "_text_a", "_text_b", "_chunk_a", "_chunk_b"]
    found_left = by_shuffle(pairs).join(a, [*block, "_text_a", "_chunk_a"])
    found_right = by_shuffle(pairs.drop("score")).join(b, [*block, "_text_b", "_chunk_b"])
    return by_shuffle(found_left).join(by_shuffle(found_right), both).select(left_id, right_id, "score")


def link(
    left: DataFrame,
    right: DataFrame,
    left_id: str,
    right_id: str,
    rules: Sequence[LinkRule] = STANDARD_RULES,
    assume_non_null: bool = False,
    decisions: DataFrame | None = None,
) -> DataFrame:
    """Bridge (left_id, right_id, match_strategy, score); all many-to-many links are kept.

    Rules run in order, and each sees only ids that earlier rules left on both sides
    (``NOT IN`` semantics, NULL rules included).  Frames come from ``match_frame``.
    An exact link scores 1.  Each rule's links are staged: later rules, the merge and
    the mapping all read them.  Under ``decisions`` approved pairs are links before any rule, and
    a rejected pair is none, so its ids are left for later rules.
    """
    links: DataFrame | None = None
    if decisions is not None:
        given = approved_pairs(decisions, left, right, left_id, right_id)
        links = stage(
            given.select(left_id, right_id, F.lit(APPROVED).alias("match_strategy"), F.lit(1.0).alias("score")), "links"
        )
    for rule in rules:
        rest_left, rest_right = left, right
        if links is not None:
            rest_left = anti_not_in(left, left_id, links, left_id, assume_non_null)
            rest_right = anti_not_in(right, right_id, links, right_id, assume_non_null)
        if rule.text is None:
            found = exact_pairs(rest_left, rest_right, rule.keys, left_id, right_id)
            found = found.withColumn("score", F.lit(1.0))
        else:
            found = fuzzy_pairs(
                rest_left, rest_right, rule.keys, rule.text, rule.threshold, left_id, right_id
            )
        if decisions is not None:
            found = without_rejected(found, decisions, left_id, right_id)
        found = stage(
            found.select(
                left_id, right_id, F.lit(rule.name).alias("match_strategy"), "score"
            ),
            "links",
        )
        links = found if links is None else stack(links, found)
    if links is None:
        raise ValueError("link needs at least one rule")
    return links


def best_links(
    left: DataFrame,
    right: DataFrame,
    left_id: str,
    right_id: str,
    rules: Sequence[LinkRule] = STANDARD_RULES,
    assume_non_null: bool = False,
) -> DataFrame:
    """The best of each left id's links as ``link`` lists them: (left_id, right_id, match_strategy, score).

    The highest score to nine places counts, then the lowest right id.  Copies of a key or a text
    share their links, so the lowest right id of each is all that a left row has to meet; pairs of
    ids, of which copies make rows times rows, are never listed.
    """
    bests: list[DataFrame] = []
    used: list[DataFrame] = []
    for rule in rules:
        rest_left, rest_right = left, right
        if bests:
            rest_left = anti_not_in(left, left_id, stack(*bests), left_id, assume_non_null)
            rest_right = anti_not_in(right, right_id, stack(*used), right_id, assume_non_null)
        on = [*rule.keys] if rule.text is None else [*rule.keys, rule.text]
        a, b = (stage(df.dropna(subset=on), "rest") for df in (rest_left, rest_right))
        # A null id sorts first, as in a minimum over the listed pairs.
        lowest = b.groupBy(*on).agg(F.min(F.struct(right_id)).alias("_lowest"))
        if rule.text is None:
            near = lowest.select(*on, "_lowest", F.lit(1.0).alias("score"))
            met = a.select(*on).distinct()
        else:
            pairs = stage(similar_texts(a, b, rule.keys, rule.text, rule.threshold), "similar")
            offered = by_shuffle(pairs).join(lowest.withColumnRenamed(rule.text, "_text_b"), [*rule.keys, "_text_b"])
            order = F.struct((-F.round("score", 9)).alias("_o"), F.col("_lowest"), F.col("score"))
            near = offered.groupBy(*rule.keys, "_text_a").agg(F.min(order).alias("_best")).select(
                *rule.keys, F.col("_text_a").alias(rule.text), "_best._lowest", "_best.score"
            )
            met = pairs.select(*rule.keys, F.col("_text_b").alias(rule.text)).distinct()
        row = [F.col(f"_lowest.{right_id}"), F.lit(rule.name).alias("match_strategy"), F.col("score")]
        linked = a.select(left_id, *on).join(by_shuffle(near), on).select(left_id, *row)
        bests.append(stage(best_per(linked, [left_id], [-F.round("score", 9), right_id]), "links"))
        used.append(stage(b.select(right_id, *on).join(by_shuffle(met), on, "left_semi").select(right_id).distinct(), "used"))
    if not bests:
        raise ValueError("best_links needs at least one rule")
    return stack(*bests)


def multi_match(links: DataFrame, left_id: str, right_id: str) -> DataFrame:
    """Ids linked to more than one distinct partner: (side, id, partners)."""

    def side(label: str, own: str, other: str) -> DataFrame:
        return (
            links.groupBy(F.col(own).cast("string").alias("id"))
            .agg(F.countDistinct(other).alias("partners"))
            .filter("partners > 1")
            .select(F.lit(label).alias("side"), "id", "partners")
        )

    return stack(side("left", left_id, right_id), side("right", right_id, left_id))


def by_similarity(queue: DataFrame) -> DataFrame:
    """Pending review rows, the most alike names first."""
    return queue.filter("review_status = 'pending'").orderBy(F.desc("name_similarity"), "review_id")


@dataclass(frozen=True)
class Bands:
    """Score bands: above ``high`` links on its own, ``low`` to ``high`` is for review."""

    high: float = 0.95
    low: float = 0.85
    same_address: float = 0.70


def scored_pairs(
    left: DataFrame,
    right: DataFrame,
    left_id: str,
    right_id: str,
    name: str = "name",
    state: str = "state_province",
    city: str = "city",
    address: str = "address_hash",
    bands: Bands = Bands(),
) -> DataFrame:
    """Pairs any band can use: (left_id, right_id, score, exact, same_place, same_address).

    Staged: tiers, flags and the queue all read them, and scoring is the costly part.
    """
    flags = ("exact", "same_place", "same_address")

    def flagged(pairs: DataFrame, flag: str) -> DataFrame:
        return pairs.withColumns({f: F.lit(f == flag) for f in flags})

    exact = exact_pairs(left, right, [name, state], left_id, right_id)
    place = fuzzy_pairs(
        left, right, [state, city], name, bands.low, left_id, right_id, inclusive=True
    )
    there = fuzzy_pairs(left, right, [address], name, bands.same_address, left_id, right_id)
    found = stack(
        flagged(exact.withColumn("score", F.lit(1.0)), "exact"),
        flagged(place, "same_place"),
        flagged(there, "same_address"),
    )
    return stage(
        found.groupBy(left_id, right_id).agg(
            F.max("score").alias("score"), *[F.bool_or(f).alias(f) for f in flags]
        ),
        "pairs",
    )


def tier(pairs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """Add ``confidence``: high links on its own, medium goes to review; the rest is dropped.

    An approved pair (``decided_pairs``) is high whatever its score.
    """
    score = F.col("score")
    high = F.col("exact") | (F.col("same_place") & (score > bands.high))
    if "approved" in pairs.columns:
        high |= F.col("approved")
    medium = (F.col("same_place") & C.in_band(score, bands.low, bands.high)) | (
        F.col("same_address") & (score > bands.same_address)
    )
    confidence = F.when(high, F.lit("high")).when(medium, F.lit("medium"))
    return pairs.withColumn("confidence", confidence).filter(C.present("confidence"))


def review_flags(
    tiered: DataFrame, left_id: str, right_id: str, bands: Bands = Bands()
) -> DataFrame:
    """Pairs a person should see, with the first reason that applies."""

    def partners(own: str, other: str, name: str) -> DataFrame:
        """Ids with two partners or more, found without gathering the distinct ones."""
        ends = tiered.groupBy(own).agg(F.min(other).alias("_first"), F.max(other).alias("_last"))
        return ends.filter(F.col("_first") < F.col("_last")).select(own, F.lit(True).alias(name))

    score = F.col("score")
    reason = (
        F.when(F.col("same_place") & C.in_band(score, bands.low, bands.high), "borderline_name")
        .when(
            F.col("same_address") & (score > bands.same_address) & (score < bands.low),
            "same_address_diff_name",
        )
        .when(
            C.present("_left_partners") | C.present("_right_partners"), "multiple_matches"
        )
    )
    return (
        tiered.join(by_shuffle(partners(left_id, right_id, "_left_partners")), left_id, "left")
        .join(by_shuffle(partners(right_id, left_id, "_right_partners")), right_id, "left")
        .withColumn("match_reason", reason)
        .filter(C.present("match_reason"))
        .select(left_id, right_id, "score", "match_reason")
    )


def review_queue(
    flagged: DataFrame,
    left: DataFrame,
    right: DataFrame,
    left_id: str,
    right_id: str,
    run_time: dt.datetime,
    name: str = "name",
    street: str = "street_address",
    address: str = "address_hash",
) -> DataFrame:
    """Pending review rows with both names and addresses and a repeatable id.

    ``address_similarity`` is 0 metres for equal hashes, else the distance where
    both sides have coordinates.  Pairs are numbered with a number for either row, and what the rows
    hold comes after that, so names are not sorted and written with every pair of theirs.
    """

    def details(df: DataFrame, id_column: str, side: str) -> DataFrame:
        rows = df.select(
            id_column,
            F.col(name).alias(f"{side}_name"),
            F.col(street).alias(f"{side}_address"),
            F.col(address).alias(f"_{side}_hash"),
            F.col("latitude").alias(f"_{side}_lat"),
            F.col("longitude").alias(f"_{side}_lon"),
        )
        return stage(rows.withColumn(f"_{side}_row", F.monotonically_increasing_id()), "details")

    of_left, of_right = details(left, left_id, "left"), details(right, right_id, "right")
    pairs = (
        by_shuffle(flagged)
        .join(of_left.select(left_id, "_left_row"), left_id)
        .join(of_right.select(right_id, "_right_row"), right_id)
    )
    numbered = (
        by_shuffle(number_rows(pairs, [left_id, right_id], "review_id"))
        .join(of_left.drop(left_id), "_left_row")
        .join(of_right.drop(right_id), "_right_row")
        .withColumn(
            "address_similarity",
            F.when(F.col("_left_hash") == F.col("_right_hash"), F.lit(0.0)).otherwise(
                haversine_m("_left_lat", "_left_lon", "_right_lat", "_right_lon")
            ),
        )
    )
    return numbered.select(
        "review_id",
        left_id,
        right_id,
        "left_name",
        "right_name",
        "left_address",
        "right_address",
        "match_reason",
        F.col("score").alias("name_similarity"),
        "address_similarity",
        F.lit("pending").alias("review_status"),
        F.lit(run_time).cast("timestamp").alias("created_at"),
    )
