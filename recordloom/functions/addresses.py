"""Rule-based address text normalization and address digests.

A stand-in for a trained address parser: it folds case, accents, punctuation and
common street and unit words, and keeps the five-digit part of a US postal code.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import as_column

# Long form of street, direction and unit words to the short form.
ABBREVIATIONS = {
    "alley": "aly",
    "apartment": "apt",
    "avenue": "ave",
    "boulevard": "blvd",
    "building": "bldg",
    "circle": "cir",
    "court": "ct",
    "drive": "dr",
    "east": "e",
    "expressway": "expy",
    "floor": "fl",
    "freeway": "fwy",
    "highway": "hwy",
    "lane": "ln",
    "north": "n",
    "northeast": "ne",
    "northwest": "nw",
    "parkway": "pkwy",
    "place": "pl",
    "plaza": "plz",
    "road": "rd",
    "room": "rm",
    "route": "rte",
    "south": "s",
    "southeast": "se",
    "southwest": "sw",
    "square": "sq",
    "street": "st",
    "suite": "ste",
    "terrace": "ter",
    "trail": "trl",
    "turnpike": "tpke",
    "unit": "unit",
    "west": "w",
}


def _accent_table() -> tuple[str, str]:
    """Precomposed Latin letters whose decomposition is one base letter plus marks."""
    accented, plain = [], []
    for point in range(0x00C0, 0x0250):
        parts = unicodedata.normalize("NFKD", chr(point))
        base = [p for p in parts if not unicodedata.combining(p)]
        if len(parts) > 1 and len(base) == 1:
            accented.append(chr(point))
            plain.append(base[0])
    return "".join(accented), "".join(plain)


_ACCENTED, _PLAIN = _accent_table()


def fold_accents(c: Column | str) -> Column:
    """Drop accents from Latin letters, precomposed or followed by combining marks."""
    return F.regexp_replace(F.translate(as_column(c), _ACCENTED, _PLAIN), r"\p{M}+", "")


def normalize_address(
    c: Column | str, abbreviations: Mapping[str, str] = ABBREVIATIONS
) -> Column:
    """Lower case, no accents, no punctuation, single spaces, short word forms."""
    text = fold_accents(F.lower(as_column(c)))
    text = F.trim(F.regexp_replace(text, r"[^\p{L}\p{N}]+", " "))
    entries = [F.lit(part) for pair in abbreviations.items() for part in pair]
    short = F.create_map(*entries)
    words = F.transform(
        F.split(text, " "), lambda word: F.coalesce(F.try_element_at(short, word), word)
    )
    return F.array_join(words, " ")


def normalize_postal(c: Column | str) -> Column:
    """The five-digit prefix of a US code; other codes lose case and punctuation only."""
    column = F.trim(as_column(c))
    plain = F.regexp_replace(F.lower(column), r"[^\p{L}\p{N}]+", "")
    return F.when(
        F.regexp_like(column, F.lit(r"^[0-9]{5}(-?[0-9]{4})?$")), F.substring(column, 1, 5)
    ).otherwise(plain)


def address_hash(*components: Column | str) -> Column:
    """MD5 of the normalized components joined by a bar; a missing one counts as empty."""
    return F.md5(
        F.concat_ws("|", *[F.coalesce(as_column(c), F.lit("")) for c in components])
    )
