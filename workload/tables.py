"""Account data derived from the test tables (see FIXTURES.md).

Everything is a row-wise or set-based derivation of whole tables: accounts come from ``customer``
and ``supplier``, service answers from ``orders``, the address reference from ``supplier``.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import partial, wraps

from pyspark.sql import DataFrame, SparkSession

from acctweave import layouts, plans
from acctweave import operators as op
from acctweave.scratch import shared_dir
from acctweave.specs import AuditSpec, FeedSpec

NOW = datetime(2025, 4, 15, 9, 30, 5)
USER = "batch"
FILE = "accounts.csv.k1"
SPEC = FeedSpec.accounts(FILE)
AUDIT = AuditSpec.default()

RECORD_ID = "md5(concat(length(kind), ':', kind, length(string(k)), ':', k)) AS BU_REC_ID"


WRITTEN: dict[tuple, str] = {}


def dealt(df: DataFrame) -> DataFrame:
    """``df`` in as many partitions, and files, as there are cores."""
    return op.spread(df, df.sparkSession.sparkContext.defaultParallelism)


def written(
    derive: Callable[..., DataFrame], lay: Callable[[DataFrame], DataFrame] = dealt
) -> Callable[..., DataFrame]:
    """Write a derived table to the shared folder once per session and read it from there after.

    A feed, a response table or a reference lies in storage, in several files, before a job starts;
    so it does here. ``lay`` is what a table goes through on its way to the files.
    """

    @wraps(derive)
    def read(spark: SparkSession, sf_dir: str, *args: str) -> DataFrame:
        key = (spark.sparkContext.applicationId, sf_dir, derive.__name__, *args)
        if key not in WRITTEN:
            path = shared_dir(spark, derive.__name__)
            op.write_out(lay(derive(spark, sf_dir, *args)), path, "PARQUET")
            WRITTEN[key] = path
        return spark.read.parquet(WRITTEN[key])

    return read


#: For tables dealt by their small columns already, so that long texts are made where they are written.
written_as_is = partial(written, lay=lambda df: df)


def _as(columns: dict[str, str]) -> list[str]:
    return [f"{expression} AS {name}" for name, expression in columns.items()]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def parties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and suppliers under one numeric key ``k``, with kind and state."""
    customers = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS k", "c_mktsegment AS kind", "c_nationkey AS n_nationkey"
    )
    suppliers = table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS k", "'SUPPLIER' AS kind", "s_nationkey AS n_nationkey"
    )
    nation = table(spark, sf_dir, "nation").selectExpr("n_nationkey", "n_name AS state")
    return customers.union(suppliers).join(nation, "n_nationkey").drop("n_nationkey")


ACCOUNT = {
    "SRC_ID": "string(k)",
    "SRC_TP_CD": "kind",
    "ORG_NAME": "if(k % 53 = 0, '', concat(kind, ' Store ', k % 40))",
    "ORG_ADDRESS_LINE_1": "concat(k % 90 + 1, ' Main Street')",
    "ORG_ADDRESS_LINE_2": "CASE WHEN k % 3 = 0 THEN concat('Suite ', k % 17) END",
    "ORG_ADDRESS_LINE_3": "string(NULL)",
    "ORG_CITY": "concat('City ', k % 25)",
    "ORG_STATE": "state",
    "ORG_ZIP_CODE": "CASE WHEN k % 29 <> 0 THEN lpad(string(k % 60 + 501), 5, '0') END",
    "ORG_ZIP_SUPP": "CASE WHEN k % 7 <> 0 THEN lpad(string(k % 1000), 4, '0') END",
    "ORG_COUNTRY": "'US'",
    "ORG_PHONE_NUMBER": "concat('201', lpad(string(k % 300), 7, '0'))",
    "ORG_FAX_NUMBER": "string(NULL)",
    "ORG_WEBSITE": "concat('w', k, '.example')",
}


@written
def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 14 input columns, nulls included."""
    return parties(spark, sf_dir).selectExpr(*_as(ACCOUNT))


def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts with audit columns and record ids, nulls blanked."""
    return plans.prepare_feed(accounts(spark, sf_dir), FILE, NOW, USER)


# the standardized layout as the account itself fills it
OWN = {
    "NAME": "upper(ORG_NAME)",
    "ADDR1": "upper(ORG_ADDRESS_LINE_1)",
    "ADDR2": "ORG_ADDRESS_LINE_2",
    "CITY": "ORG_CITY",
    "STATE": "ORG_STATE",
    "ZIP": "ORG_ZIP_CODE",
    "ZIP4": "ORG_ZIP_SUPP",
    "COUNTRY": "ORG_COUNTRY",
    "PHONE": "ORG_PHONE_NUMBER",
    "AREACD": "left(ORG_PHONE_NUMBER, 3)",
}


def own_standard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts with all columns the output layout is projected from; ZIP parts may be null."""
    df = op.add_audit(accounts(spark, sf_dir), AUDIT, FILE, NOW, USER)
    std = {f"STD_ORG_{f}": OWN.get(f, "string(NULL)") for f in layouts.STD_ORG_FIELDS}
    return op.add_record_id(df, "hash").selectExpr("*", *_as(std))


@written
def stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 48-column layout without a service."""
    return op.project_output(own_standard(spark, sf_dir), SPEC)


# ---- service answers: one per order, so customers have several and suppliers none ----


def _answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order key ``o`` and party columns, dealt before any body is made from them."""
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_custkey AS k", "o_orderkey AS o", "o_orderdate"
    )
    customers = parties(spark, sf_dir).where("kind <> 'SUPPLIER'")
    received = "concat(date_format(o_orderdate, 'yyyy-MM-dd'), '#', lpad(string(o), 12, '0'))"
    return dealt(orders.join(customers, "k")).selectExpr(
        "k", "kind", "state", "o", RECORD_ID, f"{received} AS received_at"
    )


@written_as_is
def match_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status and newline-delimited JSON by the order key."""

    def line(i: int) -> str:
        return f"""if(o % 4 > {i}, concat('{{"clusterId": "C', o % 97, '-{i}", "avgMatchProb": 0.',
            lpad(string(o % 50 + 50 - {i}), 2, '0'), '}}\\n'), '')"""

    body = f"""if(o % 37 = 0, concat({line(0)}, '{{oops\\n'),
        concat({line(0)}, {line(1)}, {line(2)}, '\\n'))"""
    return (
        _answers(spark, sf_dir)
        .selectExpr("*", "CASE WHEN o % 20 = 0 THEN 500 WHEN o % 20 <> 1 THEN 200 END AS status")
        .selectExpr(
            "BU_REC_ID", "received_at", "status", f"CASE WHEN status = 200 THEN {body} END AS body"
        )
    )


# values of the address fields of a cleansing answer
CLEANSED = {
    "ADDR1": "concat(k % 90 + 1, ' MAIN ST')",
    "ADDR2": f"upper({ACCOUNT['ORG_ADDRESS_LINE_2']})",
    "COUNTY": "concat('COUNTY ', o % 12)",
    "CITY": f"upper({ACCOUNT['ORG_CITY']})",
    "STATE": "state",
    "ZIP": ACCOUNT["ORG_ZIP_CODE"],
    "ZIP4": ACCOUNT["ORG_ZIP_SUPP"],
    "COUNTRY": "'US'",
    "LONG": "concat('-74.', k % 100)",
    "LAT": "concat('40.', k % 90)",
    "PRIM_RANGE": "string(k % 90 + 1)",
    "NOTES": "concat(' note ', o % 5)",
    "STREET_TYPE": "'ST'",
    "DLVRY_POINT_CD": "lpad(string(k % 90 + 1), 2, '0')",
    "ROUTE_CD": "concat('C', lpad(string(o % 70), 3, '0'))",
    "CHECK_DIGIT": "string(k % 10)",
    "ELOT": "lpad(string(o % 500), 4, '0')",
    "ELOT_ORDER": "if(o % 2 = 0, 'A', 'D')",
    "FAULT_CD": "if(o % 17 = 0, 'F1', '')",
    "FAULT_DESC": "if(o % 17 = 0, 'not found', '')",
    "ADDR_TYPE": "'S'",
    "DPV_STATUS": "if(o % 2 = 0, 'Y', 'N')",
    "CMRA_CD": "'N'",
    "DPV_NOTE": "concat('AA', o % 3)",
    "ADDR_LOC_TYPE": "'B'",
    "RESIDENT_DLVRY_IND": "if(k % 5 = 0, 'Y', 'N')",
}

PERSON_CLEANSED = {
    "FIRST_NAME": "concat('FIRST', k % 19)",
    "MIDDLE_INIT": "if(k % 2 = 0, 'M', '')",
    "LAST_NAME": "concat('LAST', k)",
    "PREFIX": "if(k % 2 = 0, 'MS', 'MR')",
    "SUFFIX": "if(k % 23 = 0, 'JR', '')",
    "GENDER": "if(k % 2 = 0, 'F', 'M')",
}


def _element(name: str, value: str, attributes: str = "''") -> str:
    escaped = f"coalesce(replace(replace({value}, '&', '&amp;'), '<', '&lt;'), '')"
    return f"concat('<{name}', {attributes}, '>', {escaped}, '</{name}>')"


def _document(process_type: str) -> str:
    """SQL expression of the XML body."""
    city_fault = """if(o % 11 = 0, ' FaultCode="S1" FaultDesc="city changed"', '')"""
    elements = {
        f: _element(f"d:{name}", CLEANSED[f], city_fault if f == "CITY" else "''")
        for f, name in layouts.ADDRESS_ELEMENTS.items()
    }
    elements["NOTES"] = f"if(o % 13 = 0, '', {elements['NOTES']})"  # left out now and then
    county = f"d:{layouts.ADDRESS_ELEMENTS['COUNTY']}"
    elements["COUNTY"] = f"""if(o % 23 = 0,
        concat('<{county}><![CDATA[', {CLEANSED['COUNTY']}, ']]></{county}>'), {elements['COUNTY']})"""
    attributes = [
        f"""' {name}="', {CLEANSED[f]}, '"'""" for f, name in layouts.ADDRESS_ATTRIBUTES.items()
    ]
    if process_type == "ACCOUNTS":
        names = [_element("a:OrgNm", f"upper({ACCOUNT['ORG_NAME']})")]
    else:
        names = [
            _element(f"a:{layouts.PERSON_ELEMENTS[f]}", v) for f, v in PERSON_CLEANSED.items()
        ]
    parts = [
        """'<e:Envelope xmlns:e="urn:envelope" xmlns:a="urn:profile"><e:Body><a:Answer>'""",
        """'<a:Profile Id="', BU_REC_ID, '">'""",
        # text that looks like the markup around it
        """if(o % 19 = 0, '<!-- </a:Profile> --><a:Raw><![CDATA[<d:Address></a:Profile>]]></a:Raw>', '')""",
        *names,
        """if(o % 7 = 0, '<w:Found xmlns:w="urn:found"><w:Best>', '')""",  # deeper now and then
        """'<d:Address xmlns:d="urn:address"'""",
        *attributes,
        "'>'",
        *elements.values(),
        "'</d:Address>'",
        "if(o % 7 = 0, '</w:Best></w:Found>', '')",
        _element(
            "p:Phone", ACCOUNT["ORG_PHONE_NUMBER"], """' xmlns:p="urn:phone" PhAreaCd="201"'"""
        ),
        "'</a:Profile></a:Answer></e:Body></e:Envelope>'",
    ]
    return f"concat({', '.join(parts)})"


@written_as_is
def cleansing_responses(
    spark: SparkSession, sf_dir: str, process_type: str = "ACCOUNTS"
) -> DataFrame:
    """Status and namespaced XML by the order key."""
    body = f"""CASE WHEN status <> 200 THEN NULL
        WHEN o % 41 = 0 THEN 'gateway page'
        WHEN o % 43 = 0 THEN '<e:Envelope xmlns:e="urn:envelope"><e:Body/></e:Envelope>'
        WHEN status = 200 THEN {_document(process_type)} END AS body"""
    return (
        _answers(spark, sf_dir)
        .selectExpr("*", "CASE WHEN o % 31 = 0 THEN 500 WHEN o % 31 <> 1 THEN 200 END AS status")
        .selectExpr("BU_REC_ID", "received_at", "status", body)
    )


# ---- contacts ----

CONTACT = {
    "PER_FIRST_NAME": "concat('First', k % 19)",
    "PER_MIDDLE_NAME": "CASE WHEN k % 2 = 0 THEN 'm' END",
    "PER_LAST_NAME": "concat('Last', k)",
    "PER_PREFIX": "if(k % 2 = 0, 'Ms', 'Mr')",
    "PER_SUFFIX": "CASE WHEN k % 23 = 0 THEN 'Jr' END",
    "PER_ADDRESS_LINE_1": ACCOUNT["ORG_ADDRESS_LINE_1"],
    "PER_ADDRESS_LINE_2": ACCOUNT["ORG_ADDRESS_LINE_2"],
    "PER_ADDRESS_LINE_3": ACCOUNT["ORG_ADDRESS_LINE_3"],
    "PER_CITY": ACCOUNT["ORG_CITY"],
    "PER_STATE": ACCOUNT["ORG_STATE"],
    "PER_ZIP_CODE": ACCOUNT["ORG_ZIP_CODE"],
    "PER_ZIP_SUPP": ACCOUNT["ORG_ZIP_SUPP"],
    "PER_COUNTRY": ACCOUNT["ORG_COUNTRY"],
    "PER_PHONE_NUMBER": ACCOUNT["ORG_PHONE_NUMBER"],
    "PER_FAX_NUMBER": ACCOUNT["ORG_FAX_NUMBER"],
    "PER_EMAIL": "concat('p', k, '@example.org')",
}


CONTACT_FIELDS = [
    *layouts.PERSON_ELEMENTS,
    *(f for f in layouts.ADDRESS_FIELDS),
    *(f"{f}_{kind}" for f in layouts.ADDRESS_ELEMENTS for kind in ("FAULT_CD", "FAULT_DESC")),
    "PHONE",
    "AREACD",
]
# inputs are renamed on their way out; the standardized columns keep their names
CONTACT_OUTPUT = (
    [("BU_REC_ID", "BU_REC_ID")]
    + [(c, f"SRC_{c}") for c in CONTACT]
    + [(f"STD_PER_{f}", f"STD_PER_{f}") for f in CONTACT_FIELDS]
)
CONTACT_SPEC = FeedSpec.from_dict(
    {
        "file_config": {"process_type": "CONTACT"},
        "input_fields": [
            {"position": i, "name": c, "type": "STRING"} for i, c in enumerate(CONTACT)
        ],
        "output_fields": [
            {"position": i, "source_field": source, "target_field": target}
            for i, (source, target) in enumerate(CONTACT_OUTPUT)
        ],
    }
)


@written
def contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``BU_REC_ID`` and the 16 contact input columns, one contact per account."""
    return parties(spark, sf_dir).selectExpr(RECORD_ID, *_as(CONTACT))


# ---- reference tables for the native operators ----

REFERENCE = {
    "ADDR1": "concat(h, ' main  st.')",
    "CITY": "concat('CITY ', z % 25)",
    "STATE": "'NJ'",
    "ZIP": "lpad(string(z), 5, '0')",
    "ZIP4": "lpad(string(h), 4, '0')",
    "COUNTRY": "'US'",
    "PRIM_RANGE": "string(h)",
    "STREET_TYPE": "'ST'",
    "DPV_STATUS": "if(h % 2 = 0, 'Y', 'N')",
}


@written
def address_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses of the suppliers; several suppliers share one."""
    rows = table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey % 90 + 1 AS h", "s_suppkey % 60 + 501 AS z"
    )
    fields = {f: REFERENCE.get(f, "string(NULL)") for f in layouts.ADDRESS_FIELDS}
    return rows.selectExpr(*_as(fields))


@written
def cluster_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All accounts as cluster members: one cluster per name and ZIP, every third name misspelt."""
    members = parties(spark, sf_dir).selectExpr(
        "k",
        RECORD_ID.replace("BU_REC_ID", "MEMBER_ID"),
        f"{ACCOUNT['ORG_NAME']} AS org_name",
        f"coalesce({ACCOUNT['ORG_ZIP_CODE']}, '') AS zip5",
        f"{ACCOUNT['ORG_ADDRESS_LINE_1']} AS line1",
        f"{ACCOUNT['ORG_PHONE_NUMBER']} AS phone",
    )
    clusters = members.groupBy("org_name", "zip5").agg({"MEMBER_ID": "min"})
    return members.join(clusters, ["org_name", "zip5"]).selectExpr(
        "concat('C-', `min(MEMBER_ID)`) AS ORG_ID",
        "MEMBER_ID",
        "if(k % 3 = 0, left(org_name, greatest(length(org_name) - 1, 0)), org_name) AS name",
        "line1",
        "zip5",
        "left(phone, 3) AS areacode",
        "phone",
    )


INPUTS = (
    accounts,
    stage,
    match_responses,
    cleansing_responses,
    contacts,
    address_reference,
    cluster_master,
)
