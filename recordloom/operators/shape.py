"""Projections, filters and unions over whole frames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C


@dataclass(frozen=True)
class FeedSpec:
    """How one feed becomes standard columns.

    ``columns`` maps an output name to a source path (dots reach into structs) or to
    several paths whose texts are joined.  The other fields refine outputs by name;
    ``true_flags`` and ``excluded`` filter on source paths.
    """

    columns: Mapping[str, str | Sequence[str]]
    bounds: Mapping[str, tuple[float, float]] = field(default_factory=dict)
    lowered: Sequence[str] = ()
    categories: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    phones: Sequence[str] = ()
    true_flags: Sequence[str] = ()
    excluded: Mapping[str, Sequence[str]] = field(default_factory=dict)


def standardize(df: DataFrame, spec: FeedSpec) -> DataFrame:
    """One projection over one filter; only the needed (nested) columns are read."""
    for flag in spec.true_flags:
        df = df.filter(C.is_true(flag))
    for path, values in spec.excluded.items():
        df = df.filter(C.not_in_literals(path, values))

    outputs = []
    for name, path in spec.columns.items():
        column = F.col(path) if isinstance(path, str) else C.join_parts(*path)
        if name in spec.bounds:
            column = C.bounded_decimal(column, *spec.bounds[name])
        if name in spec.lowered:
            column = C.lower_text(column)
        if name in spec.categories:
            column = C.map_category(column, spec.categories[name])
        if name in spec.phones:
            column = C.prefix_phone(column)
        outputs.append(column.alias(name))
    return df.select(*outputs)


def with_constants(df: DataFrame, constants: Mapping[str, tuple[object, str]]) -> DataFrame:
    """Add typed constants, NULL included: ``{name: (value, type)}``."""
    return df.withColumns({n: F.lit(v).cast(t) for n, (v, t) in constants.items()})


def nest(
    df: DataFrame, structs: Mapping[str, Mapping[str, str]], keep: Sequence[str] = ()
) -> DataFrame:
    """Fold flat columns into named structs, after the kept top-level columns."""
    folded = [
        F.struct(*[F.col(source).alias(name) for name, source in fields.items()]).alias(struct)
        for struct, fields in structs.items()
    ]
    return df.select(*keep, *folded)


def stack(*frames: DataFrame) -> DataFrame:
    """UNION ALL by name; a column a frame lacks is a typed NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def filter_by(df: DataFrame, **equals: object) -> DataFrame:
    """Conjunction of the equalities that were given; ``None`` means no condition."""
    for name, value in equals.items():
        if value is not None:
            df = df.filter(F.col(name) == F.lit(value))
    return df


def lookup(df: DataFrame, key: str, value: object) -> DataFrame:
    """Rows with this id; an unknown id gives an empty frame."""
    return df.filter(F.col(key) == F.lit(value))


def text_search(df: DataFrame, q: str, columns: Sequence[str]) -> DataFrame:
    return df.filter(C.contains_text(q, columns))
