"""Personal data: fixed patterns, and more of the same by bootstrapped contextual extraction.

DataFrame functions only.  The fixed patterns give emails, ip addresses, card and phone numbers, and
secrets: strings of ``SECRET_LENGTH`` letters and digits or more, of many different ones, that are
assigned (after ``=`` or ``:``, quoted or not).  These are the seeds.  Words left of a seed, with
their punctuation, are lexical patterns (the last word, the last two, the last three);
identifier-like runs (four digits or more) and groups that no seed covers are candidates and have
such patterns too.  A group is a run of four digits or more with the runs that one space, slash, colon or
bracket (and a space, slash, dot or dash beside it) joins to it, digit to digit; an IBAN written in
groups; a run of hexadecimal groups and colons; or an email-like form (``a@b``, ``a(at)b``, ``a[at]b``).  The digits count over the whole group.
A run of three characters or more with one to three digits is too common to be named by what it says: it
is named place by place, by the patterns of that place alone, and counts among the identifiers of its patterns.
A candidate inside a larger one can be named, but does not count as an identifier of a pattern,
and yields to the larger one if both are named.  Patterns and distinct identifiers form a graph, scored in ``ROUNDS`` rounds:

    pattern     sum of the scores of its identifiers of a kind / (its identifiers + ``DOUBT``)
    identifier  1 - product over its patterns at ``CONFIDENT`` or more of (1 - score)

Seeds keep score 1.  Candidates of four digits that end at ``CONFIDENT`` or more become spans of their best kind.
Identifiers count once, however many copies of a document hold them.

Positions are code points.  Spark's functions give matches and what lies between them, not
places; a running sum over the matches of one document gives those.  The fixed patterns are
written without repeated groups, which Java's matcher recurses over: first a
separator inside a number or a host name is replaced by a private-use character of the same
length.

Defined cases: null texts are empty and have no spans; a null id is kept; repeated rows
get equal spans; further columns are not read; no rows give no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage

KINDS = ("email", "ip", "card", "phone")
ALL_KINDS = (*KINDS, "secret")
ROUNDS = 3
DOUBT = 2.0
CONFIDENT = 0.7
SECRET_LENGTH = 20
SECRET_VARIETY = 8  # different characters of a secret

_IN_NUMBER, _IN_NAME, _OTHER = "\ue000", "\ue001", "\ue002"
_IN_GROUP, _BRACKET, _COLON = "\ue003", "\ue004", "\ue005"
_PRIVATE = _IN_NUMBER + _IN_NAME + _IN_GROUP + _BRACKET + _COLON
_EMAIL = (
    rf"(?:\G|(?<![A-Za-z0-9._%+{_IN_NAME}-]))[A-Za-z0-9._%+{_IN_NAME}-]++"
    rf"@[A-Za-z0-9-]+{_IN_NAME}[A-Za-z0-9{_IN_NAME}-]+"
)
_IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = rf"[0-9][0-9{_IN_NUMBER}]+"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_CANDIDATE = r"(?<![A-Za-z0-9._@+-])(?:[A-Za-z._@+-]*+[0-9]){4}[A-Za-z0-9._@+-]*+"
_FEW = r"(?<![A-Za-z0-9._@+-])(?!(?:[A-Za-z._@+-]*+[0-9]){4})(?=[A-Za-z._@+-]*+[0-9])[A-Za-z0-9._@+-]{3,}+"
_SECRET = rf"(?<=[=:]\x20?[\x22']?)(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])(?=[0-9+/_-]*+[A-Za-z])[A-Za-z0-9+/_-]{{{SECRET_LENGTH},}}+"
_IN_RUN = rf"A-Za-z0-9._@+{_IN_GROUP}{_BRACKET}{_COLON}-"
_AT = r"(?:@|\x20?[(\[](?:at|AT)[)\]]\x20?)"
_GROUP = (
    rf"(?<![%{_IN_RUN}])(?:[A-Za-z0-9._%+-]++{_AT}[A-Za-z0-9][A-Za-z0-9.-]*+"
    rf"|(?=[A-Fa-f:{_COLON}]*+[0-9])(?=(?:[:{_COLON}]*+[0-9A-Fa-f]){{4}})(?:[0-9A-Fa-f]{{0,4}}[:{_COLON}]){{2,7}}[0-9A-Fa-f]{{0,4}}(?![{_IN_RUN[:-1]}:-])"
    rf"|(?:[(\[](?=[0-9]++{_BRACKET}))?(?:[A-Za-z._@+{_IN_GROUP}{_BRACKET}{_COLON}-]*+[0-9]){{4}}[{_IN_RUN}]*+)"
)
#: What joins the runs of a group, each with the character of the same length that replaces it.
_JOINS = (
    (r"(?<=[0-9])[)\]](?=[\x20./-]?[0-9])", _BRACKET),
    (rf"(?:(?<=[0-9])|(?<=[0-9][\x20./-]))[(\[](?=[0-9]++{_BRACKET})", _BRACKET),
    (rf"(?<=[0-9{_BRACKET}])[\x20/](?=[0-9{_BRACKET}])", _IN_GROUP),
    (r"(?<=[0-9]):(?=[0-9])", _COLON),
    (r"(?<=\b[A-Z]{2}[0-9]{2})\x20(?=[A-Z]{4}\x20[0-9])", _IN_GROUP),
    (rf"(?<=[A-Z]{{2}}[0-9]{{2}}{_IN_GROUP}[A-Z]{{4}})\x20(?=[0-9])", _IN_GROUP),
)
_BYTE = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
_LEFT = 80  # characters before a match in which its two words are looked for

HIT = "array<struct<kind:string,i:int,gap:int,m:string,left:string>>"


def _hits(text: Column, pattern: str, kind: str, possible: Column) -> Column:
    """The matches of a pattern in order, each with the length and end of what precedes it."""
    zipped = F.arrays_zip(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"), F.split(text, pattern, -1).alias("p")
    )
    found = F.transform(
        F.filter(zipped, lambda z: z["m"].isNotNull()),
        lambda z, i: F.struct(
            F.lit(kind).alias("kind"),
            i.alias("i"),
            F.length(z["p"]).alias("gap"),
            z["m"].alias("m"),
            F.right(z["p"], F.lit(_LEFT)).alias("left"),
        ),
    )
    return F.when(possible, found.cast(HIT)).otherwise(F.array().cast(HIT))


def _luhn(digits: Column) -> Column:
    doubled = F.transform(
        F.sequence(F.lit(1), F.length(digits)),
        lambda i: F.substring(F.reverse(digits), i, F.lit(1)).cast("int") * (2 - i % 2),
    )
    return F.aggregate(doubled, F.lit(0), lambda total, d: total + F.when(d > 9, d - 9).otherwise(d)) % 10 == 0


def _valid() -> Column:
    digits = F.regexp_replace("m", "[^0-9]", "")
    n = F.length(digits)
    return (
        F.when(F.col("kind") == "ip", F.col("m").rlike(rf"\A{_BYTE}\.{_BYTE}\.{_BYTE}\.{_BYTE}\z"))
        .when(F.col("kind") == "card", n.between(14, 19) & _luhn(F.when(n <= 19, digits).otherwise("0")))
        .when(F.col("kind") == "phone", n.between(10, 15))
        .when(F.col("kind") == "secret", F.size(F.array_distinct(F.split(F.lower("m"), ""))) >= SECRET_VARIETY)
        .otherwise(F.lit(True))
    )


def _patterns() -> Column:
    """The last one, two and three words left of a match, lower-cased; punctuation alone says nothing."""
    words = F.filter(F.split(F.lower("left"), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n = F.size(words)
    one = F.when(n >= 1, F.element_at(words, -1))
    more = [F.when(n >= k, F.concat_ws(" ", F.slice(words, F.greatest(n - (k - 1), F.lit(1)), k))) for k in (2, 3)]
    return F.filter(F.array(one, *more), lambda p: F.coalesce(p.rlike(r"[\p{L}\p{N}]"), F.lit(False)))


def _found(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row, doc_id, hits): matches of every pattern in every whole text."""
    text = F.coalesce(text_col, F.lit(""))
    plain = F.translate(text, _PRIVATE, _OTHER * len(_PRIVATE))
    numbers = F.regexp_replace(plain, r"(?<=[0-9])[\x20-](?=[0-9])", _IN_NUMBER)
    names = F.regexp_replace(plain, r"(?<=[A-Za-z0-9-])\.(?=[A-Za-z0-9-])", _IN_NAME)
    groups = reduce(lambda t, join: F.regexp_replace(t, *join), _JOINS, plain)
    digit = text.rlike("[0-9]")
    hits = F.concat(
        _hits(names, _EMAIL, "email", F.contains(text, F.lit("@"))),
        _hits(plain, _IP, "ip", text.rlike(r"[0-9]\.[0-9]")),
        _hits(numbers, _CARD, "card", digit),
        _hits(plain, _PHONE, "phone", F.contains(text, F.lit("+"))),
        _hits(plain, _SECRET, "secret", digit & text.rlike("[=:]")),
        _hits(plain, _CANDIDATE, "candidate", digit),
        _hits(plain, _FEW, "few", digit),
        _hits(groups, _GROUP, "group", digit | text.rlike(_AT)),
    )
    return docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), hits.alias("hits"))


def _placed(found: DataFrame) -> DataFrame:
    """One row per match with its place: (row, kind, few, start, end, m, patterns)."""
    hits = found.select("row", F.explode("hits").alias("h")).select("row", "h.*")
    run = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap") + F.length("m")).over(run)
    placed = hits.withColumn("end", end).withColumn("start", F.col("end") - F.length("m"))
    # A stop at the end of a run of characters belongs to the sentence.
    tail = F.length(F.regexp_extract("m", r"[._+:-]+\z", 0))
    is_candidate = F.col("kind").isin("candidate", "group", "few")
    return placed.filter(is_candidate | _valid()).select(
        "row", F.when(is_candidate, F.lit("candidate")).otherwise(F.col("kind")).alias("kind"),
        (F.col("kind") == "few").alias("few"), "start",
        F.when(is_candidate, F.col("end") - tail).otherwise(F.col("end")).alias("end"),
        F.when(is_candidate, F.substring(F.col("m"), F.lit(1), F.length("m") - tail)).otherwise(F.col("m")).alias("m"),
        _patterns().alias("patterns"),
    )


def _uncovered(placed: DataFrame) -> DataFrame:
    """Seeds, and the candidates that overlap none of them; ``inner`` if they lie in a larger or equal one."""
    by_start = Window.partitionBy("row").orderBy("start", "end")
    is_seed = F.col("kind") != "candidate"
    before = F.max(F.when(is_seed, F.col("end"))).over(by_start.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    after = F.min(F.when(is_seed, F.col("start"))).over(by_start.rangeBetween(Window.currentRow, Window.unboundedFollowing))
    clear = (F.coalesce(before, F.lit(-1)) <= F.col("start")) & (F.coalesce(after, F.col("end")) >= F.col("end"))
    spans = placed.withColumn("clear", clear).filter(is_seed | F.col("clear")).drop("clear")
    return spans.withColumn("inner", ~is_seed & _inside(["row", is_seed]))


def _inside(keys: list) -> Column:
    """Whether a span lies in another one with the same keys; of equal spans all but one do."""
    before = Window.partitionBy(*keys).orderBy("start", F.desc("end")).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.max("end").over(before) >= F.col("end"), F.lit(False))


def _rank() -> Column:
    return F.array_position(F.array(*[F.lit(k) for k in ALL_KINDS]), F.col("kind"))


def discovered(
    spans: DataFrame, rounds: int = ROUNDS, doubt: float = DOUBT, confident: float = CONFIDENT
) -> tuple[DataFrame, DataFrame]:
    """(m, kind) of the candidates that confident patterns name, with their best kind; and the last
    round's confident patterns (pattern, kind, trust)."""
    edges = spans.select("m", F.explode("patterns").alias("pattern"), "inner").groupBy("m", "pattern")
    edges = stage(edges.agg(F.min("inner").alias("inner")), "context-edges")
    counted = edges.filter(~F.col("inner"))
    degree = stage(counted.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")), "context-degrees")
    seeds = stage(
        spans.filter("kind <> 'candidate'").select("m", "kind").distinct().withColumn("score", F.lit(1.0)), "context-seeds"
    )
    scores = seeds
    for _ in range(rounds):
        patterns = stage(
            counted.join(scores, "m")
            .groupBy("pattern", "kind")
            .agg(F.sum("score").alias("total"))
            .join(degree, "pattern")
            .withColumn("trust", F.col("total") / (F.col("n") + doubt))
            .filter(F.col("trust") >= confident)
            .select("pattern", "kind", "trust"),
            "context-patterns",
        )
        named = (
            edges.join(patterns, "pattern")
            .groupBy("m", "kind")
            .agg(_any_trust().alias("score"))
        )
        new = named.join(seeds.select("m", "kind"), ["m", "kind"], "left_anti")
        scores = stage(seeds.unionByName(new), "context-scores")
    best = F.max_by("kind", F.struct("score", -_rank()))
    named = (
        scores.join(seeds.select("m").distinct(), "m", "left_anti")
        .filter(F.col("score") >= confident)
        .groupBy("m")
        .agg(best.alias("kind"))
    )
    return named, patterns


def _any_trust() -> Column:
    return 1 - F.exp(F.sum(F.log(1 - F.col("trust"))))


def named_by_place(spans: DataFrame, patterns: DataFrame, confident: float = CONFIDENT) -> DataFrame:
    """(row, start, end, kind) of runs with few digits whose own patterns are confident of a kind."""
    here = spans.filter("few AND NOT inner").select("row", "start", "end", F.explode("patterns").alias("pattern"))
    kinds = here.join(patterns, "pattern").groupBy("row", "start", "end", "kind").agg(_any_trust().alias("score"))
    best = F.max_by("kind", F.struct("score", -_rank())).alias("kind")
    return kinds.filter(F.col("score") >= confident).groupBy("row", "start", "end").agg(best)


def _joined(spans: Column) -> Column:
    order = F.array_sort(spans)
    return F.concat_ws(",", F.transform(order, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, base, spans) of every row: arrays of (start, rank, kind, end)."""
    found = stage(_found(docs, id_col, text_col), "private-hits")
    spans = stage(_uncovered(_placed(found)), "private-spans")
    is_base = F.col("kind").isin(*KINDS).alias("base")
    seeds = spans.filter("kind <> 'candidate'").select("row", "kind", "start", "end", is_base)
    named, patterns = discovered(spans)
    more = (
        spans.filter("kind = 'candidate' AND NOT few")
        .drop("kind")
        .join(named, "m")
        .withColumn("inner", _inside(["row"]))
        .filter(~F.col("inner"))
        .select("row", "kind", "start", "end", F.lit(False).alias("base"))
    )
    placed = named_by_place(spans, patterns).select("row", "kind", "start", "end", F.lit(False).alias("base"))
    rank = _rank()
    span = F.struct("start", rank.alias("rank"), "kind", "end")
    per_row = (
        seeds.unionByName(more)
        .unionByName(placed)
        .groupBy("row")
        .agg(F.collect_list(F.when(F.col("base"), span)).alias("base"), F.collect_list(span).alias("spans"))
    )
    kind = "array<struct<start:bigint,rank:bigint,kind:string,end:bigint>>"
    return found.select("row", "doc_id").join(per_row, "row", "left").select(
        "doc_id",
        *[F.array_sort(F.coalesce(F.col(c).cast(kind), F.array().cast(kind))).alias(c) for c in ("base", "spans")],
    )


def digest(found: DataFrame) -> DataFrame:
    """Counts of each kind, the digest of the base spans, and all spans as text."""
    counts = [F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"),
        F.size("spans").cast("long").alias("n_spans"),
    )


def masked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) of every row with ``[kind]`` in place of each span.

    For ids that are keys.  Overlapping spans are masked up to the end of the last.
    """
    found = personal_data(docs, id_col, text_col).select(F.col("doc_id").alias("of"), "spans")
    text = F.coalesce(text_col, F.lit(""))
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at"))

    def step(done: Column, s: Column) -> Column:
        fresh = s["start"] >= done["at"]
        plain = F.substring(text, (done["at"] + 1).cast("int"), (s["start"] - done["at"]).cast("int"))
        out = F.when(fresh, F.concat(done["out"], plain, F.lit("["), s["kind"], F.lit("]"))).otherwise(done["out"])
        return F.struct(out.alias("out"), F.greatest(done["at"], s["end"]).alias("at"))

    rest = F.aggregate(
        "spans", start, step, lambda done: F.concat(done["out"], F.substring(text, (done["at"] + 1).cast("int"), F.length(text)))
    )
    return docs.join(found, docs[id_col].eqNullSafe(found["of"])).select(F.col(id_col), rest.alias(text_col))
