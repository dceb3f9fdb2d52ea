"""The two service exchanges as tables: request rows out, response rows in.

A response table has ``BU_REC_ID``, ``status`` (null for a failed transport) and ``body``, and may
have ``received_at``. Responses meet their records in an equi-join on the record id.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acctweave import layouts
from acctweave.functions import compact, first_word, match_outcome, parse_cleansing_body, text_of
from acctweave.operators.columns import RECORD_ID
from acctweave.operators.sieve import sift

#: Name of the column that a response table may be partitioned by: the feed that was answered.
FEED = "FEED"

# ---- requests ----


def cleanse_requests(df: DataFrame, process_type: str = "ACCOUNTS") -> DataFrame:
    """One row per record with the fields the cleansing service is sent."""
    fields = {"ACCOUNTS": layouts.ACCOUNT_REQUEST, "CONTACT": layouts.CONTACT_REQUEST}[
        layouts.check_process_type(process_type)
    ]
    return df.select(
        RECORD_ID,
        *((text_of(F.col(c)) if c else F.lit("")).alias(element) for element, c in fields.items()),
    )


def match_features(df: DataFrame) -> DataFrame:
    """``recordId`` and the nested ``record`` of 24 features from 13 standardized columns."""
    return df.select(text_of(F.col(RECORD_ID)).alias("recordId"), _record().alias("record"))


def _record() -> Column:
    def std(name: str) -> Column:
        return text_of(F.col(f"STD_ORG_{name}"))

    name = F.upper(std("NAME"))
    line1, line2 = std("ADDRESS_LINE_1"), std("ADDRESS_LINE_2")
    zip5, zip4, phone = std("ZIP_CODE"), std("ZIP_SUPP"), std("PHONE_NUMBER")
    # fixed values: the feature names of the matching service's contract, in its order
    features = {
        "site_address_1": line1,
        "site_address_2": line2,
        "site_address_full": F.concat_ws(" ", line1, line2),
        "site_city": std("CITY"),
        "site_country": std("COUNTRY"),
        "site_zip5": zip5,
        "site_zip9": F.concat_ws("-", zip5, zip4),
        "site_phone_7": F.substring(phone, 1, 7),
        "site_phone_areacode": std("AREACD"),
        "site_state": std("STATE"),
        "site_fax": None,
        "business_name": name,
        "original_source_and_ID": F.concat_ws(
            ":::", text_of(F.col("SRC_TP_CD")), text_of(F.col("SRC_ID"))
        ),
        "site_zip4": zip4,
        "phone_number_most_frequent": phone,
        "site_phone_full_number": phone,
        "EMAIL": None,
        "site_phone_number_10dig": phone,
        "COMPANY_NAME": phone,  # the service contract carries the phone under this key
        "site_phone_6": F.substring(phone, 1, 6),
        "ml_company_name": compact(name),
        "ml_company_first_word": first_word(name),
        "site_address_1_original": line1,
        "business_name_gr": name,
    }
    absent = F.lit(None).cast("array<string>")
    return F.struct(
        *((absent if v is None else F.array(v)).alias(key) for key, v in features.items())
    )


def match_requests(df: DataFrame) -> DataFrame:
    """``BU_REC_ID`` and the JSON document sent for it; absent features stay as explicit nulls."""
    return match_features(df).select(
        F.col("recordId").alias(RECORD_ID),
        F.to_json(F.struct("recordId", "record"), {"ignoreNullFields": "false"}).alias("request"),
    )


# ---- responses ----


def latest_responses(responses: DataFrame) -> DataFrame:
    """One response per record id, the latest by ``received_at``; of equal times, a usable one.

    A plain aggregate: repeated answers for one id are reduced before the shuffle, and the result
    is already partitioned on the record id for the join that follows.
    """
    order = [F.col(c) for c in ("received_at",) if c in responses.columns]
    order += [F.col("status").eqNullSafe(200).alias("usable"), F.col("status"), F.col("body")]
    return responses.groupBy(RECORD_ID).agg(F.max(F.struct(*order)).alias("answer")).select(
        RECORD_ID, "answer.status", "answer.body"
    )


def answers_for(
    records: DataFrame, responses: DataFrame, feeds: Sequence[str] | None = None
) -> DataFrame:
    """The responses that can concern ``records``: all of theirs, and few others.

    ``feeds`` names the feeds that ``records`` come from; a response table partitioned by ``FEED`` is
    then read in those partitions only. Within them a filter of bounded size, built from the record
    ids, drops answers to other records at the scan, before any of them is shuffled.
    """
    if feeds is not None:
        responses = responses.where(F.col(FEED).isin(*feeds))
    return sift(responses, records.select(RECORD_ID), RECORD_ID)


def flatten_cleansing(responses: DataFrame, process_type: str = "ACCOUNTS") -> DataFrame:
    """One row per usable cleansing answer: the record id and its ``STD_*`` columns.

    Missing or empty values are '', but an empty organisation name stays null.
    """
    parts = parse_cleansing_body(F.col("body"), process_type)
    parsed = responses.where("status = 200").select(RECORD_ID, F.explode(parts).alias("p"))

    if process_type == "ACCOUNTS":
        prefix, name = "STD_ORG_", ["nullif(p.profile.OrgNm, '') AS STD_ORG_NAME"]
        columns = {f: f"p.address.{e}" for f, e in layouts.ADDRESS_ELEMENTS.items()}
    else:
        prefix, name = "STD_PER_", []
        columns = {field: f"p.profile.{e}" for field, e in layouts.PERSON_ELEMENTS.items()}
        for field, element in layouts.ADDRESS_ELEMENTS.items():
            columns[field] = f"p.address.{element}._VALUE"
            columns[f"{field}_FAULT_CD"] = f"p.address.{element}._FaultCode"
            columns[f"{field}_FAULT_DESC"] = f"p.address.{element}._FaultDesc"
    columns |= {f: f"p.address._{a}" for f, a in layouts.ADDRESS_ATTRIBUTES.items()}
    columns |= {"PHONE": "p.profile.Phone._VALUE", "AREACD": "p.profile.Phone._PhAreaCd"}
    texts = (f"coalesce({path}, '') AS {prefix}{field}" for field, path in columns.items())
    return parsed.selectExpr(RECORD_ID, *name, *texts)


def attach_cleansing(
    records: DataFrame,
    responses: DataFrame,
    process_type: str = "ACCOUNTS",
    feeds: Sequence[str] | None = None,
) -> DataFrame:
    """Every record with its ``STD_*`` columns; they are null where no usable answer came.

    Only answers to these records, from ``feeds`` if named, are reduced (see ``answers_for``).
    """
    own = answers_for(records, responses, feeds)
    flat = flatten_cleansing(latest_responses(own), process_type)
    return records.join(flat, RECORD_ID, "left")


def attach_matches(
    records: DataFrame,
    responses: DataFrame,
    policy: str = "lenient",
    feeds: Sequence[str] | None = None,
) -> DataFrame:
    """One row per record and matched cluster, with ``ORG_ID`` and ``ORG_MATCH_CONFIDENCE``.

    ======================================  ==============  =========
    answer                                  lenient         strict
    ======================================  ==============  =========
    status 200 with clusters                a row for each  the same
    status 200 without clusters             one null row    dropped
    no answer (transport error)             one null row    dropped
    other status, or a malformed body       dropped         dropped
    ======================================  ==============  =========

    Only answers to these records, from ``feeds`` if named, are reduced (see ``answers_for``).
    """
    if policy not in ("lenient", "strict"):
        raise ValueError(f"policy must be 'lenient' or 'strict', not {policy!r}")
    status, body = F.col("_status"), F.col("_body")
    own = answers_for(records, responses, feeds)
    answers = latest_responses(own).select(
        RECORD_ID, F.col("status").alias("_status"), F.col("body").alias("_body")
    )
    if policy == "strict":
        # exploding the expression itself parses each body once
        cluster = F.explode(match_outcome(status, body))
        joined = records.join(answers, RECORD_ID)
    else:
        cluster = F.explode_outer("_clusters")
        parsed = answers.select(
            RECORD_ID, "_status", match_outcome(status, body).alias("_clusters")
        )
        joined = records.join(parsed, RECORD_ID, "left").where(
            F.col("_status").isNull() | F.col("_clusters").isNotNull()
        )
    return joined.select(*records.columns, cluster.alias("_cluster")).select(
        *records.columns,
        F.col("_cluster.clusterId").alias("ORG_ID"),
        F.col("_cluster.avgMatchProb").alias("ORG_MATCH_CONFIDENCE"),
    )


def rejects(
    responses: DataFrame,
    stage: str,
    process_type: str = "ACCOUNTS",
    requests: DataFrame | None = None,
    feeds: Sequence[str] | None = None,
) -> DataFrame:
    """Answers that could not be used: record id, stage ('cleanse' or 'match'), status, reason.

    Given ``requests``, only their answers are read (from ``feeds`` if named), and records without
    any answer are reported too.
    """
    if stage == "match":
        usable = match_outcome(F.col("status"), F.col("body")).isNotNull()
    elif stage == "cleanse":
        usable = F.size(parse_cleansing_body(F.col("body"), process_type)) > 0
    else:
        raise ValueError(f"stage must be 'cleanse' or 'match', not {stage!r}")
    reason = (
        F.when(F.col("status").isNull(), "no answer")
        .when(F.col("status") != 200, "status")
        .when(~F.coalesce(usable, F.lit(False)), "malformed")
    )
    if requests is not None:
        responses = answers_for(requests, responses, feeds)
    latest = latest_responses(responses)
    if requests is not None:
        latest = requests.select(RECORD_ID).join(latest, RECORD_ID, "left")
    # one array element per reject: a filter on ``reason`` would parse each body twice
    return latest.select(
        RECORD_ID,
        F.lit(stage).alias("stage"),
        "status",
        F.explode(F.array_compact(F.array(reason))).alias("reason"),
    )
