"""Quality rules: figures of each document, and lines that many documents of a host share.

Lines are normalised (ASCII letters lower-cased, digits to 0, white space to one space) and
hashed together with their host.  A line is shared if more than ``most_docs`` documents of its host hold it,
whatever the size of the host.  Copies of a text count once.  So do near copies and pages
without content of their own: a text counts as a document if at least ``own_share`` of the words of its
distinct lines stand in lines that no other text of the host holds, and all other texts that hold a
line count as one for it.  So no text is condemned by its copies.  Shared lines are removed, and a document is
rejected that fails the base rules or keeps less than ``least_left`` of its words.

Shared lines are rows (host, line, texts that hold it), however many a host has.  The lines of
the distinct texts meet them by a join on host and line, in which a line of more than
``chunk_rows`` texts is cut in chunks by the text; what a text holds of them comes back to its
documents by a join on host and text.  So no row and no task holds the lines of a host.

Defined cases: null texts have no words and fail the base rules; null hosts are one host;
repeated rows get equal results; lines without a word are never shared and are kept; further
columns are carried along, and added names never clash; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import stage
from .common import free_names

MOST_DOCS = 10
OWN_SHARE = 0.2
LEAST_LEFT = 0.3
LEAST_WORDS = 50
PART_ROWS = 256  # worked off at a time
CHUNK_ROWS = 1024  # texts of one shared line that meet it in one task
SYMBOLS = b"#*$%&|<>"
_SHAPE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789", b"abcdefghijklmnopqrstuvwxyz000000000")
_NOT_SYMBOLS = bytes(b for b in range(256) if b not in SYMBOLS)


def line_hash(line: bytes) -> int:
    """Signed hash of a normalised line."""
    value = xxhash.xxh64_intdigest(b" ".join(line.translate(_SHAPE).split()))
    return value - (1 << 64) if value >> 63 else value


def n_repeat_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur twice or more."""
    if len(words) < 4:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    # Pairs are numbered again, so that a triple fits 64 bits whatever the text.
    pairs = ids[:-1] * len(numbers) + ids[1:]
    if len(numbers) >= 1 << 20:
        pairs = np.unique(pairs, return_inverse=True)[1]
    _, which, counts = np.unique(pairs[:-1] * len(numbers) + ids[2:], return_inverse=True, return_counts=True)
    again = counts[which] > 1
    covered = np.zeros(len(words), bool)
    for i in range(3):
        covered[i : i + len(again)] |= again
    return int(covered.sum())


def figures(data: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text."""
    words = data.split()
    in_words = b"".join(words)
    # Continuation bytes of UTF-8 are 10xxxxxx; all others begin a code point.
    chars = int(np.count_nonzero((np.frombuffer(in_words, np.uint8) & 0xC0) != 0x80))
    lines = [line for line in data.split(b"\n") if line.split(None, 1)]
    symbols = len(data.translate(None, _NOT_SYMBOLS))
    return len(words), chars, symbols, len(lines) - len(set(lines)), n_repeat_words(words)


def _host(host: Column) -> Column:
    """The host as text that is never null: a null host is one host."""
    return F.coalesce(F.concat(F.lit("="), host.cast("string")), F.lit(""))


def _text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text.cast("binary"), F.lit(b"")))


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Some rows at a time, so that few texts are Python objects at once."""
    for batch in batches:
        for begin in range(0, batch.num_rows, PART_ROWS):
            yield batch.slice(begin, PART_ROWS)


def _hash_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _parts(batches):
        lines, words = [], []
        for text in batch.column(2).cast(pa.binary()).to_pylist():
            found = {line_hash(line): len(line.split()) for line in (text or b"").split(b"\n") if line.split(None, 1)}
            lines.append(list(found))
            words.append(list(found.values()))
        arrays = [pa.array(lines, pa.list_(pa.int64())), pa.array(words, pa.list_(pa.int32()))]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *arrays], names=["host", "text", "lines", "words"])


def text_lines(docs: DataFrame, text_col: str = "text", host_col: str = "source") -> DataFrame:
    """(host, text, lines, words): hashes and lengths of the distinct lines of every distinct text of a host."""
    host, text = _host(F.col(host_col)), F.col(text_col)
    hashed = docs.select(host.alias("host"), _text_key(text).alias("key"), text.alias("text")).mapInArrow(
        _hash_lines, "host string, text long, lines array<long>, words array<int>"
    )
    both = F.first(F.struct("lines", "words")).alias("held")
    return stage(hashed.groupBy("host", "text").agg(both).select("host", "text", "held.*"), "lines")


def texts_with_content(texts: DataFrame, own_share: float = OWN_SHARE) -> DataFrame:
    """(host, text) of the texts that count as documents: enough of their words are in lines of their own.

    A line with one text names that text, so the words of its own lines are summed without a join.
    """
    held = texts.select("host", "text", F.explode(F.arrays_zip("lines", "words")).alias("of")).select("host", "text", "of.*")
    alone = held.groupBy("host", "lines").agg(
        F.count(F.lit(1)).alias("n"), F.min("text").alias("text"), F.min("words").alias("words")
    )
    own = alone.filter("n = 1").groupBy("host", "text").agg(F.sum("words").alias("own"))
    total = texts.select("host", "text", F.aggregate("words", F.lit(0).cast("long"), lambda a, b: a + b).alias("total"))
    return total.join(own, ["host", "text"]).filter(F.col("own") >= F.col("total") * F.lit(own_share)).select("host", "text")


def shared_lines(texts: DataFrame, most_docs: int = MOST_DOCS, own_share: float = OWN_SHARE) -> DataFrame:
    """(host, line, docs, texts): the lines that documents share, how many do, and how many texts hold each."""
    content = texts_with_content(texts, own_share).withColumn("counts", F.lit(1))
    held = texts.join(content, ["host", "text"], "left").select(
        "host", F.coalesce("counts", F.lit(0)).alias("counts"), F.explode("lines").alias("line")
    )
    docs = F.sum("counts") + F.max(1 - F.col("counts"))
    counted = held.groupBy("host", "line").agg(docs.alias("docs"), F.count(F.lit(1)).alias("texts"))
    return counted.filter(F.col("docs") > most_docs)


def lines_to_remove(texts: DataFrame, shared: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(host, text, lines): the shared lines that each text holds, for texts with any."""
    chunks = F.ceil(F.col("texts") / chunk_rows)
    hot = stage(shared.filter(F.col("texts") > chunk_rows).select("host", "line", chunks.alias("chunks")), "hot-lines")
    held = (
        texts.select("host", "text", F.explode("lines").alias("line"))
        .join(hot, ["host", "line"], "left")
        .withColumn("chunk", F.pmod(F.xxhash64("text"), F.coalesce("chunks", F.lit(1))))
    )
    met = shared.select("host", "line", F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)).alias("chunk"))
    return held.join(met, ["host", "line", "chunk"]).groupBy("host", "text").agg(F.collect_list("line").alias("lines"))


RULES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, removed_words long"
)
_RULE_TYPES = pa.struct(
    [(f.split()[0], {"long": pa.int64(), "boolean": pa.bool_()}[f.split()[1]]) for f in RULES.split(", ")]
)


def _judge(least_left: float, carried: int, text_at: int | None, name: str):
    """Rows are the carried columns, then the text unless it is one of them, and the shared lines that it holds."""

    def judge(data: bytes, shared: frozenset[int]) -> tuple[dict, bytes]:
        n, chars, symbols, dup_lines, repeats = figures(data)
        removed, left = 0, data
        if shared:
            lines = data.split(b"\n")
            gone = [bool(line.split(None, 1)) and line_hash(line) in shared for line in lines]
            removed = sum(len(line.split()) for line, out in zip(lines, gone) if out)
            left = b"\n".join(line for line, out in zip(lines, gone) if not out)
        failed = n < LEAST_WORDS or 100 * repeats > 50 * n
        kept = not failed and n - removed >= least_left * n
        values = (n, chars, symbols, dup_lines, repeats, failed, kept, removed)
        return dict(zip(_RULE_TYPES.names, values)), left

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            texts = batch.column(carried if text_at is None else text_at).cast(pa.binary())
            rules, left = [], []
            for text, shared in zip(texts, batch.column(batch.num_columns - 1)):
                found, rest = judge(text.as_py() or b"", frozenset(shared.as_py() or ()))
                rules.append(found)
                if text_at is not None:
                    left.append(rest if found["removed_words"] else text.as_py())
            arrays = batch.columns[:carried]
            if text_at is not None:
                arrays[text_at] = pa.array(left, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.array(rules, _RULE_TYPES)], names=[*batch.schema.names[:carried], name]
            )

    return run


def judged(
    docs: DataFrame, text_col: str = "text", host_col: str = "source", carry: list[str] | None = None,
    name: str = "rules", most_docs: int = MOST_DOCS, own_share: float = OWN_SHARE, least_left: float = LEAST_LEFT,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """The columns ``carry`` (all by default) and a struct ``name`` with figures and verdict.

    A carried text column comes without its shared lines.
    """
    carry = docs.columns if carry is None else carry
    of, key, lines, text = free_names(docs, "of", "key", "lines", "whole_text")
    texts = text_lines(docs, text_col, host_col)
    shared = stage(shared_lines(texts, most_docs, own_share), "shared-lines")
    held = lines_to_remove(texts, shared, chunk_rows).withColumnsRenamed({"host": of, "text": key, "lines": lines})
    held = stage(held, "held-lines")
    same = (_host(docs[host_col]) == held[of]) & (_text_key(docs[text_col]) == held[key])
    # Merged at any size, so that disk grows with the input and skewed copies are split by bytes.
    met = docs.join(held.hint("merge"), same, "left")
    text_at = carry.index(text_col) if text_col in carry else None
    rows = met.select(*carry, *([F.col(text_col).alias(text)] if text_at is None else []), lines)
    fields = docs.select(*carry).schema.add(name, StructType.fromDDL(RULES))
    return rows.mapInArrow(_judge(least_left, len(carry), text_at, name), fields)


def keep_good(docs: DataFrame, text_col: str = "text", host_col: str = "source", **limits) -> DataFrame:
    """The documents that the rules keep, without their shared lines; ``n_chars`` follows the text."""
    (name,) = free_names(docs, "rules")
    kept = judged(docs, text_col, host_col, name=name, **limits).filter(F.col(name)["kept"])
    if "n_chars" in docs.columns:
        changed = F.col(name)["removed_words"] > 0
        length = F.length(text_col).cast(docs.schema["n_chars"].dataType)
        kept = kept.withColumn("n_chars", F.when(changed, length).otherwise(F.col("n_chars")))
    return kept.drop(name)


RULES_SQL = """
    WITH words AS (
        SELECT doc_id, source, coalesce(text, '') AS text,
               regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
        FROM documents
    ),
    split AS (
        SELECT *, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
        FROM words
    ),
    windows AS (
        SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM words)
    ),
    repeats AS (
        SELECT doc_id, count(DISTINCT place) AS n_repeat_words
        FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS place FROM windows WHERE n > 1)
        GROUP BY doc_id
    ),
    shapes AS (
        SELECT doc_id, source, text, unnest(lines) AS line FROM split
    ),
    normal AS (
        SELECT *, len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS n,
               array_to_string(regexp_extract_all(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789', 'abcdefghijklmnopqrstuvwxyz000000000'), '[^\\x20\\x09-\\x0D]+'), ' ') AS shape
        FROM shapes
    ),
    held AS (SELECT DISTINCT source, text, shape, n FROM normal),
    counted AS (SELECT source, shape, count(*) AS texts FROM held GROUP BY source, shape),
    content AS (
        SELECT source, text, coalesce(sum(n) FILTER (texts = 1), 0) >= 0.2 * sum(n) AS own
        FROM held JOIN counted USING (source, shape) GROUP BY source, text
    ),
    shared AS (
        SELECT source, shape FROM held JOIN content USING (source, text)
        GROUP BY source, shape HAVING count(*) FILTER (own) + max((NOT own)::INT) > 10
    ),
    removed AS (
        SELECT doc_id, sum(n) AS removed FROM normal SEMI JOIN shared USING (source, shape) GROUP BY doc_id
    ),
    base AS (
        SELECT doc_id, len(w)::BIGINT AS n_words, len(array_to_string(w, ''))::BIGINT AS word_chars,
               len(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
               (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
               coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(removed, 0) AS removed
        FROM split LEFT JOIN repeats USING (doc_id) LEFT JOIN removed USING (doc_id)
    )
    SELECT * EXCLUDE (removed), n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
           NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_words - removed >= 0.3 * n_words AS kept
    FROM base
"""
