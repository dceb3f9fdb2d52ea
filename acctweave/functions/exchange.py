"""Parsers for the bodies of the two service answers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from acctweave import layouts
from acctweave.functions.text import SPACE

# ---- match answers: newline-delimited JSON ----

LINE_BREAK = r"[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"
BLANK = f"^{SPACE}*$"
MATCH_LINE = "array<struct<clusterId:string,avgMatchProb:string>>"
WHOLE_LINE = "struct<line:struct<clusterId:string,avgMatchProb:string>>"
STRICT_JSON = {"allowSingleQuotes": "false"}


def parse_match_body(body: Column) -> Column:
    """``array<struct<clusterId string, avgMatchProb double>>``; null when any line is malformed.

    Each line is parsed inside brackets, so a bare value or a second object on the line fail instead
    of being half read; and once more inside an object, which text after a bracket that closes the
    wrapper early leaves without an end. Blank lines are skipped and a blank body is an empty
    array.
    """
    lines = F.filter(
        F.split(F.coalesce(body, F.lit("")), LINE_BREAK), lambda line: ~F.rlike(line, F.lit(BLANK))
    )

    def parse(line: Column) -> Column:
        inside = F.from_json(F.concat(F.lit('{"line":'), line, F.lit("}")), WHOLE_LINE, STRICT_JSON)
        hits = F.from_json(F.concat(F.lit("["), line, F.lit("]")), MATCH_LINE, STRICT_JSON)
        return F.when(inside["line"].isNotNull(), hits).otherwise(F.array())

    parsed = F.transform(lines, parse)
    # the parse is wrapped in a one-element array so that the check and the result share it
    checked = F.filter(
        F.array(parsed),
        lambda answer: F.forall(
            answer, lambda hit: (F.size(hit) == 1) & F.get(hit, F.lit(0)).isNotNull()
        ),
    )
    return F.transform(
        F.get(checked, F.lit(0)),
        lambda hit: F.struct(
            F.get(hit, F.lit(0))["clusterId"].alias("clusterId"),
            F.replace(F.get(hit, F.lit(0))["avgMatchProb"], F.lit('"'), F.lit(""))
            .try_cast("double")
            .alias("avgMatchProb"),
        ),
    )


def match_outcome(status: Column, body: Column) -> Column:
    """Clusters of a usable answer (status 200, well formed), else null."""
    return F.when(status == 200, parse_match_body(body))


# ---- cleansing answers: namespaced XML ----

STRICT_XML = {"ignoreNamespace": "true", "ignoreSurroundingSpaces": "false"}
#: Comments, CDATA sections and processing instructions, and the stretches between them.
PIECES = r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>|<\?.*?\?>|<?[^<]*"
FIRST_NAME, LAST_NAME = r"^\s*<([^\s/>]+)", r"</([^\s>]+)\s*>\s*$"
#: An answer is read inside this element, so that what follows its root is looked at, too.
WRAPPER = "whole-answer"

# account answers keep only the text of an element, which parses in half the time
_ELEMENT = {
    "ACCOUNTS": "string",
    "CONTACT": "struct<_VALUE:string,_FaultCode:string,_FaultDesc:string>",
}
_NAMES = {
    "ACCOUNTS": ["OrgNm string"],
    "CONTACT": [f"{e} string" for e in layouts.PERSON_ELEMENTS.values()],
}


def profile_schema(process_type: str) -> str:
    """The children of the profile that are read by name."""
    names = ", ".join(_NAMES[process_type])
    return f"{names}, Phone struct<_VALUE:string,_PhAreaCd:string>, _corrupt_record string"


def address_schema(process_type: str) -> str:
    fields = [f"{e} {_ELEMENT[process_type]}" for e in layouts.ADDRESS_ELEMENTS.values()]
    fields += [f"_{a} string" for a in layouts.ADDRESS_ATTRIBUTES.values()]
    return f"{', '.join(fields)}, _corrupt_record string"


def plain_markup(body: Column) -> Column:
    """An XML text without comments and processing instructions, CDATA sections as escaped text.

    In what is left of a well-formed document, ``<`` opens a tag and nothing else.
    """

    def plain(piece: Column) -> Column:
        text = F.substring(piece, F.lit(10), F.length(piece) - 12)
        for mark, reference in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
            text = F.replace(text, F.lit(mark), F.lit(reference))
        return (
            F.when(F.startswith(piece, F.lit("<![CDATA[")), text)
            .when(F.startswith(piece, F.lit("<!--")) | F.startswith(piece, F.lit("<?")), F.lit(""))
            .otherwise(piece)
        )

    pieces = F.regexp_extract_all(body, F.lit(PIECES), F.lit(0))
    special = F.contains(body, F.lit("<!")) | F.contains(body, F.lit("<?"))
    return F.when(special, F.array_join(F.transform(pieces, plain), "")).otherwise(body)


def _element(markup: Column, name: str) -> Column:
    """The first element of that local name at any depth, '' without one.

    For ``plain_markup``, in which no other text can look like its tags. Elements of that name inside
    it are not expected, and leave a part that does not parse.
    """
    tag = rf"(?:[^\s<>/:]+:)?{name}"
    pattern = rf"(?s)<{tag}(?:\s[^<]*?)?(?:/>|(?<!/)>.*?</{tag}\s*>)"
    return F.regexp_extract(markup, pattern, 0)


def parse_cleansing_body(body: Column, process_type: str) -> Column:
    """``array<struct>`` with the parsed ``profile`` and ``address``; empty if not usable.

    Usable is a well-formed document of one root with a profile in it. The profile may sit at any
    depth, and the address at any depth below the profile, under any prefix; both are found by local
    name among the tags alone, so comments and CDATA sections never look like them. Without an
    address its fields are null. A document with a type declaration is not usable.
    """
    layouts.check_process_type(process_type)

    def read(markup: Column) -> Column:
        profile = _element(markup, "Profile")
        address = _element(profile, "Address")
        whole = F.concat(F.lit(f"<{WRAPPER}>"), markup, F.lit(f"</{WRAPPER}>"))
        document = F.from_xml(whole, "_corrupt_record string, _unused string", STRICT_XML)
        one_root = F.regexp_extract(markup, FIRST_NAME, 1) == F.regexp_extract(markup, LAST_NAME, 1)
        sound = one_root & (profile != "") & document["_corrupt_record"].isNull()
        return F.when(
            sound,
            F.struct(
                F.from_xml(profile, profile_schema(process_type), STRICT_XML).alias("profile"),
                F.when(
                    address != "", F.from_xml(address, address_schema(process_type), STRICT_XML)
                ).alias("address"),
            ),
        )

    # arrays of one element, so that each step is evaluated once
    return F.filter(
        F.transform(F.array(plain_markup(body)), read),
        lambda p: p.isNotNull()
        & p["profile"].isNotNull()
        & p["profile"]["_corrupt_record"].isNull()
        & p["address"]["_corrupt_record"].isNull(),
    )
