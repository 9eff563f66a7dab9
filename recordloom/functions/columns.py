"""Column helpers: predicates, text, numbers, categories, ids.  All stay in the JVM."""

from __future__ import annotations

import unicodedata
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- predicates -------------------------------------------------------------


def is_true(c: Column | str) -> Column:
    """True only for TRUE; NULL counts as false."""
    return as_column(c).eqNullSafe(F.lit(True))


def not_in_literals(c: Column | str, values: Sequence[str]) -> Column:
    """SQL ``NOT IN`` over literals: a NULL value yields NULL, so a filter drops the row."""
    return ~as_column(c).isin(list(values))


def trimmed_equals(c: Column | str, value: str) -> Column:
    return trim_spaces(c) == F.lit(value)


def present(c: Column | str) -> Column:
    return as_column(c).isNotNull()


def in_band(c: Column | str, low: float, high: float) -> Column:
    return as_column(c).between(low, high)


def contains_text(q: str, columns: Sequence[Column | str]) -> Column:
    """Case-insensitive substring test over several columns; NULL columns never hit."""
    needle = F.lower(F.lit(q))
    hits = [F.coalesce(F.contains(F.lower(as_column(c)), needle), F.lit(False)) for c in columns]
    return reduce(lambda a, b: a | b, hits)


# --- text -------------------------------------------------------------------

_SPACES = "".join(chr(p) for p in range(0x10000) if unicodedata.category(chr(p)) == "Zs")


def trim_spaces(c: Column | str) -> Column:
    """Strip every Unicode space separator, not only U+0020; tabs and newlines stay."""
    return F.btrim(as_column(c), F.lit(_SPACES))


def match_key(c: Column | str) -> Column:
    return F.lower(trim_spaces(c))


def lower_text(c: Column | str) -> Column:
    return F.lower(as_column(c))


def join_parts(*parts: Column | str, sep: str = " ") -> Column:
    """NULL parts are skipped, empty ones are not; all NULL gives an empty string."""
    return trim_spaces(F.concat_ws(sep, *[as_column(p) for p in parts]))


def prefix_phone(c: Column | str, length: int = 10, prefix: str = "+1") -> Column:
    """Prefix numbers of exactly ``length`` characters, else NULL; digits are not checked."""
    column = as_column(c)
    return F.when(F.length(column) == length, F.concat(F.lit(prefix), column))


def concat_strict(*parts: Column | str) -> Column:
    """Concatenation in which any NULL part makes the result NULL."""
    return F.concat(*[as_column(p) for p in parts])


# --- numbers ----------------------------------------------------------------


def bounded_decimal(
    c: Column | str, low: float, high: float, precision: int = 10, scale: int = 6
) -> Column:
    """Decimal inside the inclusive range, else NULL.  NaN is above every bound."""
    column = as_column(c)
    return F.when(
        (column >= F.lit(low)) & (column <= F.lit(high)),
        column.cast(f"decimal({precision},{scale})"),
    )


def round_half_even(c: Column | str, digits: int) -> Column:
    return F.bround(as_column(c), digits)


# --- categories and preferences ---------------------------------------------


def map_category(
    c: Column | str, categories: Mapping[str, str], default: str = "Unknown"
) -> Column:
    """Exact, case-sensitive lookup; unmapped values and NULL become ``default``."""
    by_target: dict[str, list[str]] = {}
    for value, target in categories.items():
        by_target.setdefault(target, []).append(value)
    column = as_column(c)
    result = F.lit(default)
    for target, values in by_target.items():
        result = F.when(column.isin(values), F.lit(target)).otherwise(result)
    return result


def prefer(*columns: Column | str) -> Column:
    return F.coalesce(*[as_column(c) for c in columns])


def prefer_with_source(candidates: Mapping[str, Column | str]) -> tuple[Column, Column]:
    """First non-NULL candidate, and the label of the source that supplied it (or NULL)."""
    columns = {label: as_column(c) for label, c in candidates.items()}
    source = F.coalesce(*[F.when(c.isNotNull(), F.lit(label)) for label, c in columns.items()])
    return F.coalesce(*columns.values()), source


def open_end(c: Column | str, end: str = "9999-12-31") -> Column:
    return F.coalesce(as_column(c), F.to_date(F.lit(end)))


def source_flag(
    left_id: Column | str, right_id: Column | str, left: str, right: str, both: str = "both"
) -> Column:
    has_left, has_right = as_column(left_id).isNotNull(), as_column(right_id).isNotNull()
    return (
        F.when(has_left & has_right, F.lit(both))
        .when(has_left, F.lit(left))
        .when(has_right, F.lit(right))
    )


def gold_id(
    left_id: Column | str,
    right_id: Column | str,
    *fallback: Column | str,
    left: str,
    right: str,
) -> Column:
    """Prefixed id: the left id, else the right id, else a digest of the fallback parts."""
    a, b = as_column(left_id).cast("string"), as_column(right_id).cast("string")
    digest = F.md5(F.concat(F.lit(""), *[F.coalesce(as_column(p), F.lit("")) for p in fallback]))
    return F.coalesce(
        F.concat(F.lit(f"{left}_"), a),
        F.concat(F.lit(f"{right}_"), b),
        F.concat(F.lit("gen_"), digest),
    )


def as_json(*columns: Column | str) -> Column:
    return F.to_json(F.struct(*[as_column(c) for c in columns]))


# --- aggregate expressions --------------------------------------------------


def count_where(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def ordered_structs(order: Sequence[Column | str], fields: Mapping[str, Column | str]) -> Column:
    """Array of structs per group, sorted by ``order``.

    The caller bounds the group (see ``part_entries`` in ``operators/gold.py``): an array lives in
    one row.
    """
    keys = [as_column(o).alias(f"_o{i}") for i, o in enumerate(order)]
    body = F.struct(*[as_column(c).alias(name) for name, c in fields.items()])
    rows = F.array_sort(F.collect_list(F.struct(*keys, body.alias("_body"))))
    return F.transform(rows, lambda row: row["_body"])


def ordered_concat(value: Column | str, order: Sequence[Column | str], sep: str) -> Column:
    """Text of a group's non-NULL values joined in ``order``; NULL if there are none."""
    kept = as_column(value)
    keys = [as_column(o).alias(f"_o{i}") for i, o in enumerate(order)]
    entry = F.when(kept.isNotNull(), F.struct(*keys, kept.cast("string").alias("_v")))
    rows = F.array_sort(F.collect_list(entry))
    joined = F.array_join(F.transform(rows, lambda row: row["_v"]), sep)
    return F.when(F.size(rows) > 0, joined)
