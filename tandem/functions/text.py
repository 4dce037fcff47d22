"""Text predicates and token extraction, all built-in (JVM-side) expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns and words the reports match on.
UUID_PATTERN = r"([0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12})"
COLLECT_TOKEN = "COLLECT"
MCDONALDS_GROUP = "McDonald%s"          # compared as a plain string, not a pattern
MCDONALDS_NAME_LIKE = "%McDonald%s%"    # a LIKE pattern
FOOD_QUALITY_WORD = "FOOD_QUALITY"
DELIVERY_SERVICE_WORD = "DELIVERY_SERVICE"
MISSING_ITEM_WORDS = [
    "COMPLAINT_ON_ORDER_ITEM",
    "ENTIRE_ORDER_INCORRECT",
    "INCORRECT_OR_MISSED_ITEM",
    "COMPLAINT_ON_ENTIRE_ORDER",
    "MISSING_INCORRECT_ITEMS",
]
LATE_ORDER_LIKES = ["%rds_late%", "%late_order%"]
FOOD_QUALITY_LIKES = ["%food_quality%", "%quality_of_food%"]
SATELLITE_ZONE_LIKE = "SAT - %"


def folded(word: str) -> str:
    """The compatibility form of a text without case (NFKC, full case folding)."""
    once = unicodedata.normalize("NFKC", word).casefold()
    return unicodedata.normalize("NFKC", once)


def _expansions() -> dict[str, str]:
    """Single characters of the Latin and letter-like blocks and the Latin ligatures
    whose folded form is several characters ('ß', 'ﬁ', '½', '™')."""
    blocks = [*range(0x80, 0x250), *range(0x1E00, 0x1F00), *range(0x2000, 0x2190), *range(0xFB00, 0xFB07)]
    return {chr(c): folded(chr(c)) for c in blocks
            if len(folded(chr(c))) > 1 and not folded(chr(c)).isspace() and not any(map(unicodedata.combining, folded(chr(c))))}


_EXPANSIONS = _expansions()


def written_out(text: Column) -> Column:
    """``text`` with the characters that stand for several letters written out."""
    pairs = F.array(*[F.struct(F.lit(one).alias("one"), F.lit(several).alias("several")) for one, several in _EXPANSIONS.items()])
    without = F.translate(text, "".join(_EXPANSIONS), "")  # in one pass: does the text hold any?
    return F.when(F.octet_length(without) < F.octet_length(text),
                  F.aggregate(pairs, text, lambda done, p: F.replace(done, p["one"], p["several"]))).otherwise(text)


def contains_folded(plain: Column, word: str) -> Column:
    """`contains_ci` for a text that is :func:`written_out` already."""
    return F.contains(F.collate(plain, "UNICODE_CI"), F.collate(F.lit(folded(word)), "UNICODE_CI"))


def contains_ci(text: Column, word: str) -> Column:
    """Substring test on normalised texts: without regard to case, character width or
    other compatibility forms, and equal for composed and combining accents; null text
    gives null.

    The comparison is the JVM's (a Unicode collation without case).  It matches whole
    characters only, so characters that stand for several letters are written out first,
    in texts that hold any."""
    return contains_folded(written_out(text), word)


def contains_any_ci(text: Column, words) -> Column:
    out = None
    for w in words:
        t = contains_ci(text, w) == F.lit(True)
        out = t if out is None else (out | t)
    return out


def like_any(text: Column, patterns) -> Column:
    out = None
    for p in patterns:
        t = text.like(p)
        out = t if out is None else (out | t)
    return out


def token_count(text: Column, pattern: str) -> Column:
    """Number of non-overlapping matches of ``pattern`` (no capture group)."""
    return F.array_size(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))


def extract_all(text: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def is_mcdonalds(grouping: Column, name_short: Column) -> Column:
    hit = (grouping == F.lit(MCDONALDS_GROUP)) | name_short.like(MCDONALDS_NAME_LIKE)
    return F.when(hit, F.lit(1)).otherwise(F.lit(0))
