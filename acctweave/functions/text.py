"""Text normalisation and comparison."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# every character Python's str.split() treats as a space; (?U) adds the Unicode ones
SPACE = r"(?U)[\s\x1c-\x1f]"

# postal street suffixes; ours, the cleansing rules themselves are not public
STREET_SUFFIXES = {
    "AVENUE": "AVE",
    "BOULEVARD": "BLVD",
    "COURT": "CT",
    "DRIVE": "DR",
    "HIGHWAY": "HWY",
    "LANE": "LN",
    "PARKWAY": "PKWY",
    "PLACE": "PL",
    "ROAD": "RD",
    "SQUARE": "SQ",
    "STREET": "ST",
    "TERRACE": "TER",
}


def text_of(col: Column) -> Column:
    """As text, with null as the empty string."""
    return F.coalesce(col.cast("string"), F.lit(""))


def first_word(col: Column) -> Column:
    """First word of a text; '' when there is none."""
    return F.get(F.split(F.regexp_replace(col, f"^{SPACE}+", ""), f"{SPACE}+", 2), F.lit(0))


def compact(col: Column) -> Column:
    """Without blanks (the plain space only)."""
    return F.replace(col, F.lit(" "), F.lit(""))


def digits(col: Column) -> Column:
    return F.regexp_replace(col, "[^0-9]", "")


def standard_name(col: Column) -> Column:
    """Upper case, single blanks, no outer blanks."""
    return F.upper(F.trim(F.regexp_replace(col, f"{SPACE}+", " ")))


def standard_line(col: Column) -> Column:
    """Address line as ``standard_name`` with street suffixes in their short form."""
    suffixes = F.create_map(*(F.lit(x) for x in chain.from_iterable(STREET_SUFFIXES.items())))
    words = F.split(F.regexp_replace(standard_name(col), "[.,]", ""), " ")
    return F.array_join(
        F.transform(words, lambda w: F.coalesce(F.try_element_at(suffixes, w), w)), " "
    )


def similarity(a: Column, b: Column) -> Column:
    """1 - edit distance / longer length; 0 when both are blank."""
    longer = F.greatest(F.length(a), F.length(b))
    return F.when(longer == 0, F.lit(0.0)).otherwise(1 - F.levenshtein(a, b) / longer)


def edits_up_to(a: Column, b: Column, least: Column | float) -> Column:
    """Edit distance of texts that may still have the ``similarity`` ``least``, else below 0.

    The difference of the lengths is looked at first, and the distance is only taken as far as
    ``least`` allows; a result -n says that there are n edits at least.
    """
    longer, gap = F.greatest(F.length(a), F.length(b)), F.abs(F.length(a) - F.length(b))
    allowed = F.floor(longer * (1 - F.lit(least)) + 1e-9).cast("int")
    near = F.call_function("levenshtein", a, b, allowed)
    return F.when(gap > allowed, -gap).otherwise(F.when(near < 0, -(allowed + 1)).otherwise(near))
