"""Mix sources to target shares by Pareto order sampling, in DataFrame functions only.

Sources in order of code point (null last) weigh 5, 2, 1, 5, 2, 1, ... and share the size of
all documents; a target stops at ``limit`` times its source's size and the excess is shared
again by weight.  Inside a source a document of ``b`` binary digits of size is expected
``lambda * (64 - b)`` times, at most ``limit`` times, so that a long document is repeated
somewhat less; lambda makes the expected words the target.  The whole part of that number
are certain copies.  The fraction is an inclusion probability: documents are ranked by
random odds over inclusion odds and taken in that order until the words that the certain
copies leave open are filled.  The sample is thus fixed in words, up to half a document.

The order is a range-partitioned sort of narrow rows with running sums per partition, so a
source that holds a third of all rows spreads over many tasks.

Defined cases: null and empty texts have size 0 and are taken 0 times; null sources are one
source; rows of equal id draw the same random number, and of rows that tie each is taken
by its own place in the order; empty tables give no rows; reruns agree (the random number is
a digest of the id and a seed).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.numbering import number_rows
from ..session import stage
from .common import free_names, n_words

WEIGHTS = (5, 2, 1)
LIMIT = 3


def shared_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """(source, source_size, target) from one row (source, source_size) per source.

    The rate per unit of weight is raised until no target lies above its limit; each round
    is one aggregate over the sources, and only its two sums reach the driver.
    """
    order = [F.col("source").isNull(), F.coalesce("source", F.lit(""))]
    ranked = number_rows(sizes, order, "rank")
    cycle = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    ranked = ranked.select("source", "source_size", cycle.cast("long").alias("weight"))
    most = F.col("source_size") * limit
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    rate = 0.0
    while True:
        full = most <= F.col("weight") * F.lit(rate)
        held, open_weight = ranked.agg(
            F.sum(F.when(full, most)), F.sum(F.when(~full, F.col("weight")))
        ).first()
        if not open_weight:
            break
        raised = (total - (held or 0)) / open_weight
        if raised <= rate:
            break
        rate = raised
    return ranked.select(
        "source", "source_size",
        F.least(most.cast("double"), F.col("weight") * F.lit(rate)).alias("target"),
    )


def expected_copies(cells: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Add ``expected``: copies of each document of a cell (source, digits, cell_size, target).

    ``lambda`` by filling: with the classes below one at the limit, the rest share what is
    left by weight; the first class where that stays within the limit gives it.  A source
    has 64 classes at most.
    """
    below = Window.partitionBy("source").orderBy("digits").rowsBetween(Window.unboundedPreceding, -1)
    above = Window.partitionBy("source").orderBy("digits").rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy("source")
    weight = F.lit(64) - F.col("digits")
    shares = cells.withColumn("held", limit * F.coalesce(F.sum("cell_size").over(below), F.lit(0))).withColumn(
        "open", F.sum(weight * F.col("cell_size")).over(above)
    )
    rate = (F.col("target") - F.col("held")) / F.nullif("open", F.lit(0))
    shares = shares.withColumn("rate", rate)
    fits = F.col("rate") * weight <= limit
    shares = shares.withColumn("rate", F.min_by("rate", F.when(fits, F.col("digits"))).over(whole))
    expected = F.coalesce(F.least(F.col("rate") * weight, F.lit(float(limit))), F.lit(float(limit)))
    return shares.withColumn("expected", expected).drop("held", "open", "rate")


def uniform(id_col: str, seed: int) -> Column:
    """A number between 0 and 1, both excluded, from a digest of the id."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    limit: int = LIMIT,
    seed: int = 7,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) of every row."""
    base = stage(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).cast("string").alias("source"),
            n_words(text_col).alias("size"),
        ),
        "mix-sizes",
    )
    digits = F.length(F.bin("size"))
    cells = stage(
        base.groupBy("source", digits.alias("digits")).agg(F.sum("size").alias("cell_size")), "mix-cells"
    )
    targets = stage(
        shared_targets(
            cells.groupBy("source").agg(F.sum("cell_size").alias("source_size")), weights, limit
        ),
        "mix-targets",
    )
    named = targets.select(F.col("source").alias("of"), "source_size", "target")
    shares = expected_copies(
        cells.join(named, F.col("source").eqNullSafe(F.col("of"))).drop("of"), limit
    )
    certain = F.floor("expected")
    whole = Window.partitionBy("source")
    shares = stage(
        shares.select(
            "source", "digits", "source_size", "target",
            certain.alias("certain"),
            (F.col("expected") - certain).alias("odds"),
            (F.col("target") - F.sum(certain * F.col("cell_size")).over(whole)).alias("left"),
        ),
        "mix-shares",
    )
    of, at = shares.withColumnsRenamed({"source": "of", "digits": "at"}), F.length(F.bin("size"))
    u, p = uniform("doc_id", seed), F.col("odds")
    ranked = base.join(of, F.col("source").eqNullSafe(F.col("of")) & (at == F.col("at"))).withColumn(
        # A document that is sure of no further copy comes after all others.
        "order", F.when(p > 0, (u / (1 - u)) / (p / (1 - p))).otherwise(F.lit(float("inf")))
    )
    by = [F.col("source").isNull(), F.col("source"), F.col("order"), F.col("doc_id"), F.col("size")]
    placed = stage(
        ranked.drop("of", "at").repartitionByRange(*by).withColumn("part", F.spark_partition_id()), "mix-order"
    )
    sums = placed.groupBy("source", "part").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        F.col("source").alias("of"), F.col("part").alias("at"),
        F.coalesce(F.sum("words").over(before), F.lit(0)).alias("offset"),
    )
    run = Window.partitionBy("part", "source").orderBy("order", "doc_id", "size")
    so_far = F.sum("size").over(run.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = placed.withColumn("so_far", so_far).join(
        offsets, F.col("source").eqNullSafe(F.col("of")) & (F.col("part") == F.col("at"))
    )
    middle = F.col("offset") + F.col("so_far") - F.col("size") / 2
    extra = (F.col("odds") > 0) & (middle <= F.col("left"))
    copies = (F.col("certain") + extra.cast("long")).cast("long")
    return placed.select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
    )


def mixed_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options
) -> DataFrame:
    """``docs`` with every document as often as the mix takes it.

    Rows equal in id, source and size share their copies: as many as were given to all of them.
    """
    size, name, copies, id_, nth, given = free_names(docs, "size", "of", "copies", "id", "nth", "given")
    keys = ["doc_id", "source", "size"]
    counts = (
        mix(docs, id_col, text_col, source_col, **options)
        .groupBy(*keys)
        .agg(F.sum("copies").alias(copies), F.count(F.lit(1)).alias(given))
        .withColumnsRenamed({"doc_id": id_, "source": name, "size": nth})
    )
    sized = docs.withColumn(size, n_words(text_col))
    met = sized.join(
        counts,
        sized[id_col].eqNullSafe(counts[id_])
        & sized[source_col].cast("string").eqNullSafe(counts[name])
        & (sized[size] == counts[nth]),
    )
    each = F.ceil(F.col(copies) / F.col(given)).cast("int")
    return met.filter(F.col(copies) > 0).withColumn(copies, F.explode(F.sequence(F.lit(1), each))).select(*docs.columns)


#: The same mix as SQL over ``documents``, for any relation with doc_id, text and source.
MIX_SQL = """
    WITH base AS (
        SELECT doc_id, source, size, len(bin(size)) AS digits
        FROM (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM {docs})
    ),
    cells AS (SELECT source, digits, sum(size)::BIGINT AS cell_size FROM base GROUP BY ALL),
    sources AS (
        SELECT source, sum(cell_size)::BIGINT AS source_size,
               [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight
        FROM cells GROUP BY source
    ),
    filled AS (
        SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (ORDER BY source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT
                  / (sum(weight) OVER (ORDER BY source_size / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS rate
        FROM sources
    ),
    level AS (SELECT arg_min(rate, source_size / weight) FILTER (rate * weight <= 3 * source_size) AS rate FROM filled),
    targets AS (
        SELECT source, source_size, least((3 * source_size)::DOUBLE, weight * level.rate) AS target FROM sources, level
    ),
    shares AS (
        SELECT c.*, t.source_size, t.target,
               (t.target - coalesce(3 * sum(cell_size) OVER (PARTITION BY c.source ORDER BY digits ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT)
               / nullif(sum((64 - digits) * cell_size) OVER (PARTITION BY c.source ORDER BY digits ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0)::BIGINT AS rate
        FROM cells c JOIN targets t ON c.source IS NOT DISTINCT FROM t.source
    ),
    rated AS (
        SELECT * EXCLUDE (rate), coalesce(least(arg_min(rate, digits) FILTER (rate * (64 - digits) <= 3) OVER (PARTITION BY source) * (64 - digits), 3.0), 3.0)::DOUBLE AS expected
        FROM shares
    ),
    parts AS (
        SELECT source, digits, source_size, target, floor(expected)::BIGINT AS certain, expected - floor(expected) AS odds,
               target - sum(floor(expected)::BIGINT * cell_size) OVER (PARTITION BY source)::BIGINT AS open_words
        FROM rated
    ),
    drawn AS (
        SELECT b.doc_id, b.source, b.size, p.* EXCLUDE (source, digits),
               (('0x' || md5('7:' || b.doc_id)[:13])::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u
        FROM base b JOIN parts p ON b.source IS NOT DISTINCT FROM p.source AND b.digits = p.digits
    ),
    ordered AS (
        SELECT *, CASE WHEN odds > 0 THEN (u / (1 - u)) / (odds / (1 - odds)) ELSE 'inf'::DOUBLE END AS place FROM drawn
    ),
    placed AS (
        SELECT *, sum(size) OVER (PARTITION BY source ORDER BY place, doc_id, size ROWS UNBOUNDED PRECEDING)::BIGINT - size / 2 AS middle
        FROM ordered
    ),
    mixed AS (
        SELECT doc_id, source, size, source_size, target,
               certain + (odds > 0 AND middle <= open_words)::BIGINT AS copies
        FROM placed
    )
"""
