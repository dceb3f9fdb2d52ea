import json
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from acctweave import layouts
from acctweave import operators as op
from acctweave.functions.exchange import parse_match_body

RESPONSE = "BU_REC_ID string, status int, body string"
STAGE = [
    "BU_REC_ID", "SRC_ID", "SRC_TP_CD", "STD_ORG_NAME", "STD_ORG_ADDRESS_LINE_1",
    "STD_ORG_ADDRESS_LINE_2", "STD_ORG_CITY", "STD_ORG_STATE", "STD_ORG_ZIP_CODE",
    "STD_ORG_ZIP_SUPP", "STD_ORG_COUNTRY", "STD_ORG_PHONE_NUMBER", "STD_ORG_AREACD",
]


def stage(spark, **values):
    row = dict.fromkeys(STAGE) | values
    return spark.createDataFrame([tuple(row.values())], ", ".join(f"{c} string" for c in row))


# ---- features and requests ----


def test_match_request_document(spark):
    df = stage(
        spark, BU_REC_ID="r1", SRC_ID="7", SRC_TP_CD="CRM", STD_ORG_NAME="Acme  Nut\u00a0co",
        STD_ORG_ADDRESS_LINE_1="1 A ST", STD_ORG_ZIP_CODE="07030", STD_ORG_PHONE_NUMBER="2015550123",
        STD_ORG_AREACD="201",
    )
    sent = json.loads(op.match_requests(df).first().request)
    record = sent["record"]
    assert sent["recordId"] == "r1" and len(record) == 24
    assert record["site_fax"] is None and record["EMAIL"] is None
    expected = {
        "site_zip9": "07030-", "site_phone_7": "2015550", "site_phone_6": "201555",
        "site_address_full": "1 A ST ", "original_source_and_ID": "CRM:::7",
        "COMPANY_NAME": "2015550123", "business_name": "ACME  NUT\u00a0CO",
        "ml_company_name": "ACMENUT\u00a0CO", "ml_company_first_word": "ACME", "site_city": "",
    }
    assert {k: record[k] for k in expected} == {k: [v] for k, v in expected.items()}


@pytest.mark.parametrize(
    ("name", "first"), [("", ""), (None, ""), ("  \t b c", "B"), ("x\u2003y", "X"), ("one", "ONE")]
)
def test_first_word_of_blank_and_odd_names(spark, name, first):
    features = op.match_features(stage(spark, STD_ORG_NAME=name))
    assert features.first().record.ml_company_first_word == [first]


def test_cleansing_requests(spark):
    names = ("BU_REC_ID", *layouts.ACCOUNT_REQUEST.values())
    df = spark.createDataFrame([("r", *["v"] * 9, None)], ", ".join(f"{n} string" for n in names))
    assert rows(op.cleanse_requests(df)) == [("r", *["v"] * 9, "")]
    contact = ("BU_REC_ID", *layouts.CONTACT_INPUT)
    df = spark.createDataFrame(
        [tuple(c.lower() for c in contact)], ", ".join(f"{n} string" for n in contact)
    )
    sent = op.cleanse_requests(df, "CONTACT").first().asDict()
    assert sent["OrgNm"] == "" and sent["Title"] == "" and sent["Email"] == "per_email"
    assert "per_fax_number" not in sent.values()
    with pytest.raises(ValueError, match="process type"):
        op.cleanse_requests(df, "OTHER")


# ---- match answers ----

ONE = '{"clusterId": "C1", "avgMatchProb": 0.5}'
ANSWERS = [
    ("three", 200, f'{ONE}\n\n{ONE.replace("C1", "C2")}\r\n  {ONE.replace("C1", "C3")} \n'),
    ("none", 200, " \n\n"),
    ("empty", 200, None),
    ("keyless", 200, '{"other": 1}'),
    ("numeric", 200, '{"clusterId": 12, "avgMatchProb": 1}'),
    ("bad", 200, f"{ONE}\noops"),
    ("trailing", 200, f"{ONE} {ONE}"),
    ("two", 200, f"{ONE},{ONE}"),
    ("array", 200, "[1]"),
    ("single", 200, "{'clusterId': 'C1'}"),
    ("error", 500, "failed"),
    ("timeout", None, None),
]
BAD = {"bad", "trailing", "two", "array", "single", "error"}


def records(spark, ids):
    return spark.createDataFrame([(i, i.upper()) for i in ids], "BU_REC_ID string, SRC_ID string")


def test_match_policies(spark):
    df = records(spark, [a[0] for a in ANSWERS] + ["missing"])
    answers = spark.createDataFrame(ANSWERS, RESPONSE)
    matched = [
        ("keyless", "KEYLESS", None, None),
        ("numeric", "NUMERIC", "12", 1.0),
        ("three", "THREE", "C1", 0.5),
        ("three", "THREE", "C2", 0.5),
        ("three", "THREE", "C3", 0.5),
    ]
    unmatched = [(i, i.upper(), None, None) for i in ("none", "empty", "timeout", "missing")]
    assert rows(op.attach_matches(df, answers, "strict")) == sorted(matched, key=repr)
    lenient = op.attach_matches(df, answers, "lenient")
    assert rows(lenient) == sorted(matched + unmatched, key=repr)
    assert lenient.schema["ORG_MATCH_CONFIDENCE"].dataType.simpleString() == "double"
    with pytest.raises(ValueError, match="policy"):
        op.attach_matches(df, answers, "other")


def test_match_rejects(spark):
    answers = spark.createDataFrame(ANSWERS, RESPONSE)
    found = {r.BU_REC_ID: r.reason for r in op.rejects(answers, "match").collect()}
    expected = dict.fromkeys(BAD, "malformed") | {"error": "status", "timeout": "no answer"}
    assert found == expected
    asked = records(spark, ["three", "missing"])
    assert rows(op.rejects(answers, "match", requests=asked)) == [
        ("missing", "match", None, "no answer")
    ]


def test_all_null_matches_and_empty_input(spark):
    none = spark.createDataFrame([], RESPONSE)
    df = records(spark, ["a", "b"])
    assert [r[2:] for r in rows(op.attach_matches(df, none))] == [(None, None)] * 2
    assert rows(op.attach_matches(df, none, "strict")) == []
    assert rows(op.attach_matches(df.limit(0), none)) == []
    assert rows(op.rejects(none, "match")) == []


def test_the_latest_answer_counts(spark):
    answers = spark.createDataFrame(
        [("a", "2", 200, ONE), ("a", "1", 200, "oops"), ("b", "1", 200, ONE), ("b", "9", 500, None)],
        "BU_REC_ID string, received_at string, status int, body string",
    )
    assert rows(op.attach_matches(records(spark, ["a", "b"]), answers)) == [("a", "A", "C1", 0.5)]


def test_match_row_counts_on_random_answers(spark):
    rng = random.Random(7)
    answers, lenient, strict = [], 0, 0
    for i in range(300):
        status, n = rng.choice([200, 200, 200, 500, None]), rng.randrange(4)
        answers.append((f"r{i}", status, "\n".join([ONE] * n)))
        lenient += max(1, n) if status == 200 else status is None
        strict += n if status == 200 else 0
    df, answers = records(spark, [f"r{i}" for i in range(300)]), spark.createDataFrame(answers, RESPONSE)
    kept = rows(op.attach_matches(df, answers, "lenient"))
    sure = rows(op.attach_matches(df, answers, "strict"))
    assert (len(kept), len(sure)) == (lenient, strict) and set(sure) <= set(kept)


# ---- cleansing answers ----

ADDRESS = (
    '<d:Address xmlns:d="urn:d" FaultCode="F1" DPV_Status="Y">'
    '<d:AddrLine1> 1 A &amp; B ST </d:AddrLine1><d:AddrCity FaultCode="S1" FaultDesc="moved">X'
    '</d:AddrCity><d:AddrZip FaultCode="Z9"/><d:ELot><![CDATA[<1>]]></d:ELot></d:Address>'
)


def document(names="<a:OrgNm>ACME</a:OrgNm>", wrap="a:Answer"):
    return (
        '<e:Envelope xmlns:e="urn:e" xmlns:a="urn:a"><e:Body>'
        f'<{wrap}><a:Profile Id="1">{names}{ADDRESS}'
        '<p:Phone xmlns:p="urn:p" PhAreaCd="201">2015550123</p:Phone></a:Profile>'
        f"</{wrap}></e:Body></e:Envelope>"
    )


def cleansed(spark, body, process_type="ACCOUNTS"):
    df = spark.createDataFrame([("r", 200, body)], RESPONSE)
    found = op.flatten_cleansing(df, process_type).collect()
    return found[0].asDict() if found else None


@pytest.mark.parametrize("wrap", ["a:Answer", "a:Other"])
def test_account_answer(spark, wrap):
    got = cleansed(spark, document(wrap=wrap))
    assert len(got) == 30 and not any(v is None for v in got.values())
    expected = {
        "NAME": "ACME", "ADDR1": " 1 A & B ST ", "CITY": "X", "ZIP": "", "ELOT": "<1>", "NOTES": "",
        "FAULT_CD": "F1", "DPV_STATUS": "Y", "CMRA_CD": "", "PHONE": "2015550123", "AREACD": "201",
    }
    assert {k: got[f"STD_ORG_{k}"] for k in expected} == expected


def test_empty_organisation_name_stays_null(spark):
    assert cleansed(spark, document("<a:OrgNm/>"))["STD_ORG_NAME"] is None


def test_contact_answer(spark):
    names = "<a:FirstNm>ANN</a:FirstNm><a:LastNm>LEE</a:LastNm><a:Gender/>"
    got = cleansed(spark, document(names), "CONTACT")
    assert len(got) == 1 + 6 + 26 + 36 + 2
    expected = {
        "FIRST_NAME": "ANN", "LAST_NAME": "LEE", "MIDDLE_INIT": "", "GENDER": "", "CITY": "X",
        "CITY_FAULT_CD": "S1", "CITY_FAULT_DESC": "moved", "ZIP": "", "ZIP_FAULT_CD": "Z9",
        "FAULT_CD": "F1", "DPV_STATUS": "Y", "ELOT_FAULT_CD": "", "PHONE": "2015550123",
    }
    assert {k: got[f"STD_PER_{k}"] for k in expected} == expected


LOOKALIKE = "<!-- </a:Profile> --><a:Raw><![CDATA[<d:Address></a:Profile>]]></a:Raw><?x <a:Profile>?>"


@pytest.mark.parametrize(
    "change",
    [
        lambda d: d.replace("<d:Address ", "<w:W xmlns:w='u'><w:V><d:Address ").replace("</d:Address>", "</d:Address></w:V></w:W>"),
        lambda d: d.replace("<a:OrgNm>", f"{LOOKALIKE}<a:OrgNm>"),
        lambda d: d.replace("<e:Body>", f"<e:Body>{LOOKALIKE.replace('<?x <a:Profile>?>', '')}"),
        lambda d: '<?xml version="1.0" encoding="UTF-8"?>\n' + d + "<!-- end -->",
        lambda d: d.replace("<d:AddrCity", "<!-- <d:AddrCity>Y</d:AddrCity> --><d:AddrCity"),
        lambda d: d.replace(">ACME<", "><![CDATA[AC]]>ME<"),
    ],
)
def test_an_answer_is_found_at_any_depth_and_between_lookalikes(spark, change):
    assert cleansed(spark, change(document())) == cleansed(spark, document())


def test_a_profile_without_an_address(spark):
    got = cleansed(spark, document().replace(ADDRESS, ""))
    assert got["STD_ORG_NAME"] == "ACME" and got["STD_ORG_CITY"] == "" and got["STD_ORG_PHONE"]


def test_text_with_markup_in_a_section_stays_text(spark):
    got = cleansed(spark, document("<a:OrgNm><![CDATA[A & <B> ]] C]]></a:OrgNm>"))
    assert got["STD_ORG_NAME"] == "A & <B> ]] C"


UNUSABLE = ["gateway page", "", None, document()[:-9], document() + "x", "<a><b/></a>",
    "<!DOCTYPE html>" + document(), "<a><![CDATA[" + document() + "]]></a>"]


@pytest.mark.parametrize("body", UNUSABLE)
def test_unusable_cleansing_bodies(spark, body):
    assert cleansed(spark, body) is None
    df = spark.createDataFrame([("r", 200, body)], RESPONSE)
    assert rows(op.rejects(df, "cleanse")) == [("r", "cleanse", 200, "malformed")]


def test_cleansing_keeps_every_record(spark):
    answers = spark.createDataFrame(
        [("ok", 200, document()), ("bad", 200, "oops"), ("error", 500, document())], RESPONSE
    )
    df = op.attach_cleansing(records(spark, ["ok", "bad", "error", "missing"]), answers)
    names = {r.BU_REC_ID: (r.STD_ORG_NAME, r.STD_ORG_CITY) for r in df.collect()}
    assert names == {"ok": ("ACME", "X")} | dict.fromkeys(("bad", "error", "missing"), (None, None))
    nothing = op.attach_cleansing(records(spark, ["a"]), answers.limit(0))
    assert len(nothing.columns) == 31 and nothing.first().STD_ORG_NAME is None


def test_each_body_is_parsed_once(spark):
    answers = spark.createDataFrame(ANSWERS, RESPONSE)
    df = records(spark, ["a"])
    plans = {
        "from_json(": [
            op.attach_matches(df, answers, "lenient"),
            op.attach_matches(df, answers, "strict"),
            op.rejects(answers, "match"),
        ],
        "from_xml(": [op.attach_cleansing(df, answers), op.rejects(answers, "cleanse")],
    }
    for parser, frames in plans.items():
        for frame in frames:
            plan = frame._jdf.queryExecution().optimizedPlan().toString()
            # the content (profile and address of their own), and the soundness of what is around it
            assert plan.count(parser) == (2 if parser == "from_json(" else 3)


def test_text_after_a_closing_bracket_makes_a_line_malformed(spark):
    hit = '{"clusterId":"A","avgMatchProb":"0.5"}'
    bodies = [(hit + "] junk",), (hit + "]" + hit,), (hit + "]",), (hit + "}",), (hit,)]
    got = spark.createDataFrame(bodies, "body string").select(parse_match_body(F.col("body")).alias("m"))
    assert [r.m and r.m[0].clusterId for r in got.collect()] == [None, None, None, None, "A"]


def test_of_answers_at_one_time_a_usable_one_counts(spark):
    rows = [("r", 500, "bad"), ("r", 200, "good"), ("s", None, "none"), ("s", 200, "good")]
    got = op.latest_responses(spark.createDataFrame(rows, "BU_REC_ID string, status int, body string"))
    assert {r.BU_REC_ID: r.body for r in got.collect()} == {"r": "good", "s": "good"}
