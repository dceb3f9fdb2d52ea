"""Column expressions; everything here stays inside the JVM."""

from acctweave.functions.exchange import (
    match_outcome,
    parse_cleansing_body,
    parse_match_body,
)
from acctweave.functions.text import (
    compact,
    digits,
    edits_up_to,
    first_word,
    similarity,
    standard_line,
    standard_name,
    text_of,
)

__all__ = [
    "compact",
    "digits",
    "edits_up_to",
    "first_word",
    "match_outcome",
    "parse_cleansing_body",
    "parse_match_body",
    "similarity",
    "standard_line",
    "standard_name",
    "text_of",
]
