"""SQL for DuckDB over the test tables, one statement per query with the same result."""

from __future__ import annotations

import re

from acctweave import layouts
from acctweave.specs import FeedSpec
from workload.tables import FILE, USER

NOW = "2025-Apr-15 09:30:05"
SPEC = FeedSpec.accounts()

# shared subqueries, in dependency order
CTES = {
    "parties": """
        SELECT c_custkey AS k, c_mktsegment AS kind, n_name AS state
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        UNION ALL
        SELECT s_suppkey, 'SUPPLIER', n_name
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "accounts": """
        SELECT md5(concat(length(kind), ':', kind, length(cast(k AS varchar)), ':', k)) AS BU_REC_ID, k,
          cast(k AS varchar) AS SRC_ID, kind AS SRC_TP_CD,
          CASE WHEN k % 53 = 0 THEN ''
               ELSE concat(kind, ' Store ', cast(k % 40 AS varchar)) END AS ORG_NAME,
          concat(cast(k % 90 + 1 AS varchar), ' Main Street') AS ORG_ADDRESS_LINE_1,
          CASE WHEN k % 3 = 0 THEN concat('Suite ', cast(k % 17 AS varchar)) END
            AS ORG_ADDRESS_LINE_2,
          cast(NULL AS varchar) AS ORG_ADDRESS_LINE_3,
          concat('City ', cast(k % 25 AS varchar)) AS ORG_CITY, state AS ORG_STATE,
          CASE WHEN k % 29 = 0 THEN NULL
               ELSE lpad(cast(k % 60 + 501 AS varchar), 5, '0') END AS ORG_ZIP_CODE,
          CASE WHEN k % 7 = 0 THEN NULL
               ELSE lpad(cast(k % 1000 AS varchar), 4, '0') END AS ORG_ZIP_SUPP,
          'US' AS ORG_COUNTRY,
          concat('201', lpad(cast(k % 300 AS varchar), 7, '0')) AS ORG_PHONE_NUMBER,
          cast(NULL AS varchar) AS ORG_FAX_NUMBER,
          concat('w', cast(k AS varchar), '.example') AS ORG_WEBSITE
        FROM parties""",
    # newest order of each customer: the answer that counts
    "newest": """
        SELECT md5(concat(length(c_mktsegment), ':', c_mktsegment,
            length(cast(c_custkey AS varchar)), ':', c_custkey)) AS BU_REC_ID,
          c_custkey AS k, o_orderkey AS o
        FROM customer JOIN (
          SELECT o_custkey, o_orderkey, row_number() OVER (
            PARTITION BY o_custkey
            ORDER BY cast(o_orderdate AS date) DESC, o_orderkey DESC) AS age
          FROM orders) ON o_custkey = c_custkey
        WHERE age = 1""",
    "match_answers": """
        SELECT BU_REC_ID,
          CASE WHEN o % 20 = 0 THEN 500 WHEN o % 20 <> 1 THEN 200 END AS status,
          CASE WHEN o % 20 NOT IN (0, 1) AND o % 37 <> 0 THEN o % 4 END AS n_clusters, o
        FROM newest""",
    "damaged_lines": """
        SELECT SRC_TP_CD AS kind, true AS sound FROM accounts WHERE SRC_TP_CD = 'SUPPLIER'
        UNION ALL
        SELECT 'header', false FROM accounts WHERE SRC_TP_CD = 'SUPPLIER'
        UNION ALL
        SELECT unnest(CASE k % 10 WHEN 0 THEN ['short'] WHEN 1 THEN ['surplus'] WHEN 2 THEN ['quotes']
          WHEN 3 THEN ['quotes', 'quotes'] ELSE [SRC_TP_CD] END), k % 10 > 3
        FROM accounts WHERE SRC_TP_CD <> 'SUPPLIER'""",
    "steps": "SELECT unnest([0, 1, 2]) AS i",
    "cleansed": """
        SELECT n.BU_REC_ID,
          nullif(upper(a.ORG_NAME), '') AS STD_ORG_NAME,
          concat(cast(n.k % 90 + 1 AS varchar), ' MAIN ST') AS STD_ORG_ADDR1,
          coalesce(upper(a.ORG_ADDRESS_LINE_2), '') AS STD_ORG_ADDR2,
          concat('COUNTY ', cast(o % 12 AS varchar)) AS STD_ORG_COUNTY,
          upper(a.ORG_CITY) AS STD_ORG_CITY, a.ORG_STATE AS STD_ORG_STATE,
          coalesce(a.ORG_ZIP_CODE, '') AS STD_ORG_ZIP,
          coalesce(a.ORG_ZIP_SUPP, '') AS STD_ORG_ZIP4,
          'US' AS STD_ORG_COUNTRY,
          concat('-74.', cast(n.k % 100 AS varchar)) AS STD_ORG_LONG,
          concat('40.', cast(n.k % 90 AS varchar)) AS STD_ORG_LAT,
          cast(n.k % 90 + 1 AS varchar) AS STD_ORG_PRIM_RANGE,
          CASE WHEN o % 13 = 0 THEN '' ELSE concat(' note ', cast(o % 5 AS varchar)) END
            AS STD_ORG_NOTES,
          'ST' AS STD_ORG_STREET_TYPE,
          lpad(cast(n.k % 90 + 1 AS varchar), 2, '0') AS STD_ORG_DLVRY_POINT_CD,
          concat('C', lpad(cast(o % 70 AS varchar), 3, '0')) AS STD_ORG_ROUTE_CD,
          cast(n.k % 10 AS varchar) AS STD_ORG_CHECK_DIGIT,
          lpad(cast(o % 500 AS varchar), 4, '0') AS STD_ORG_ELOT,
          CASE WHEN o % 2 = 0 THEN 'A' ELSE 'D' END AS STD_ORG_ELOT_ORDER,
          CASE WHEN o % 17 = 0 THEN 'F1' ELSE '' END AS STD_ORG_FAULT_CD,
          CASE WHEN o % 17 = 0 THEN 'not found' ELSE '' END AS STD_ORG_FAULT_DESC,
          'S' AS STD_ORG_ADDR_TYPE,
          CASE WHEN o % 2 = 0 THEN 'Y' ELSE 'N' END AS STD_ORG_DPV_STATUS,
          'N' AS STD_ORG_CMRA_CD,
          concat('AA', cast(o % 3 AS varchar)) AS STD_ORG_DPV_NOTE,
          'B' AS STD_ORG_ADDR_LOC_TYPE,
          CASE WHEN n.k % 5 = 0 THEN 'Y' ELSE 'N' END AS STD_ORG_RESIDENT_DLVRY_IND,
          a.ORG_PHONE_NUMBER AS STD_ORG_PHONE,
          '201' AS STD_ORG_AREACD,
          n.k, o
        FROM newest n JOIN accounts a ON a.BU_REC_ID = n.BU_REC_ID
        WHERE o % 31 NOT IN (0, 1) AND o % 41 <> 0 AND o % 43 <> 0""",
    "reference": """
        SELECT DISTINCT s_suppkey % 90 + 1 AS h, s_suppkey % 60 + 501 AS z FROM supplier""",
    "members": """
        SELECT concat('C-', min(BU_REC_ID) OVER (PARTITION BY ORG_NAME, coalesce(ORG_ZIP_CODE, '')))
            AS ORG_ID, BU_REC_ID AS MEMBER_ID,
          upper(CASE WHEN k % 3 = 0 THEN left(ORG_NAME, greatest(length(ORG_NAME) - 1, 0))
               ELSE ORG_NAME END) AS name,
          upper(ORG_ADDRESS_LINE_1) AS line1, coalesce(ORG_ZIP_CODE, '') AS zip5,
          left(ORG_PHONE_NUMBER, 3) AS areacode, ORG_PHONE_NUMBER AS phone
        FROM accounts""",
}

STD_COLUMNS = [f"STD_ORG_{f}" for f in layouts.STD_ORG_FIELDS]
INPUT = [name for name, _ in SPEC.inputs]
AUDIT = {
    "CREATED_DT": f"'{NOW}'",
    "LAST_UPDATED_DT": f"'{NOW}'",
    "LAST_UPDATED_USER": f"'{USER}'",
    "SRC_INPUT_FILE_NAME": f"'{FILE}'",
}
# the standardized layout as the account itself fills it
OWN = {
    "STD_ORG_NAME": "upper(ORG_NAME)",
    "STD_ORG_ADDR1": "upper(ORG_ADDRESS_LINE_1)",
    "STD_ORG_ADDR2": "ORG_ADDRESS_LINE_2",
    "STD_ORG_CITY": "ORG_CITY",
    "STD_ORG_STATE": "ORG_STATE",
    "STD_ORG_ZIP": "ORG_ZIP_CODE",
    "STD_ORG_ZIP4": "ORG_ZIP_SUPP",
    "STD_ORG_COUNTRY": "ORG_COUNTRY",
    "STD_ORG_PHONE": "ORG_PHONE_NUMBER",
    "STD_ORG_AREACD": "left(ORG_PHONE_NUMBER, 3)",
}


def _layout(values: dict[str, str]) -> str:
    return ", ".join(f"{values.get(s, s)} AS {target}" for s, target in SPEC.outputs)


def _blank(names, prefix: str = "") -> str:
    return ", ".join(f"coalesce({prefix}{n}, '') AS {n}" for n in names)


CTES["stage"] = "SELECT " + _layout(
    AUDIT | {c: OWN.get(c, "cast(NULL AS varchar)") for c in STD_COLUMNS}
) + " FROM accounts"
OUTPUT = [target for _, target in SPEC.outputs]
CTES["filled"] = (
    f"SELECT {_blank(OUTPUT)}, concat_ws('-', STD_ORG_ZIP_CODE, STD_ORG_ZIP_SUPP) AS STD_ORG_ZIP9 "
    "FROM stage"
)
CTES["standardized"] = (
    "SELECT "
    + _layout(
        AUDIT
        | {c: f"coalesce(a.{c}, '')" for c in INPUT}
        | {"BU_REC_ID": "a.BU_REC_ID"}
        | {c: f"c.{c}" for c in STD_COLUMNS}
    )
    + " FROM accounts a LEFT JOIN cleansed c ON a.BU_REC_ID = c.BU_REC_ID"
)
CTES["standardized_filled"] = CTES["filled"].replace("FROM stage", "FROM standardized")

REFERENCE_VALUES = {
    "ADDR1": "concat(cast(h AS varchar), ' main  st.')",
    "CITY": "concat('CITY ', cast(z % 25 AS varchar))",
    "STATE": "'NJ'",
    "ZIP": "lpad(cast(z AS varchar), 5, '0')",
    "ZIP4": "lpad(cast(h AS varchar), 4, '0')",
    "COUNTRY": "'US'",
    "PRIM_RANGE": "cast(h AS varchar)",
    "STREET_TYPE": "'ST'",
    "DPV_STATUS": "CASE WHEN h % 2 = 0 THEN 'Y' ELSE 'N' END",
}
_native = {
    f"STD_ORG_{f}": f"CASE WHEN h IS NULL THEN '' ELSE {REFERENCE_VALUES.get(f, chr(39) * 2)} END"
    for f in layouts.ADDRESS_FIELDS
} | {
    "STD_ORG_NAME": "upper(a.ORG_NAME)",
    "STD_ORG_PHONE": "a.ORG_PHONE_NUMBER",
    "STD_ORG_AREACD": "left(a.ORG_PHONE_NUMBER, 3)",
}
_native_source = """FROM accounts a LEFT JOIN reference
    ON replace(upper(a.ORG_ADDRESS_LINE_1), ' STREET', ' ST') = concat(cast(h AS varchar), ' MAIN ST')
    AND a.ORG_ZIP_CODE = lpad(cast(z AS varchar), 5, '0')"""
CTES["native"] = (
    "SELECT "
    + _layout(AUDIT | {c: f"coalesce(a.{c}, '')" for c in INPUT} | {"BU_REC_ID": "a.BU_REC_ID"} | _native)
    + f" {_native_source}"
)
CTES["native_filled"] = CTES["filled"].replace("FROM stage", "FROM native")


def _with(body: str) -> str:
    """``body`` with the shared subqueries it needs, in order."""
    needed, seen = [body], set()
    while needed:
        words = set(re.findall(r"\w+", needed.pop()))
        for name in CTES:
            if name in words and name not in seen:
                seen.add(name)
                needed.append(CTES[name])
    parts = [f"{name} AS ({CTES[name]})" for name in CTES if name in seen]
    return (f"WITH {', '.join(parts)} " if parts else "") + body


FEATURES = {
    "site_address_1": "STD_ORG_ADDRESS_LINE_1",
    "site_address_2": "STD_ORG_ADDRESS_LINE_2",
    "site_address_full": "STD_ORG_ADDRESS_LINE_1 || ' ' || STD_ORG_ADDRESS_LINE_2",
    "site_city": "STD_ORG_CITY",
    "site_country": "STD_ORG_COUNTRY",
    "site_zip5": "STD_ORG_ZIP_CODE",
    "site_zip9": "STD_ORG_ZIP_CODE || '-' || STD_ORG_ZIP_SUPP",
    "site_phone_7": "substr(STD_ORG_PHONE_NUMBER, 1, 7)",
    "site_phone_areacode": "STD_ORG_AREACD",
    "site_state": "STD_ORG_STATE",
    "site_fax": "cast(NULL AS varchar)",
    "business_name": "STD_ORG_NAME",
    "original_source_and_ID": "SRC_TP_CD || ':::' || SRC_ID",
    "site_zip4": "STD_ORG_ZIP_SUPP",
    "phone_number_most_frequent": "STD_ORG_PHONE_NUMBER",
    "site_phone_full_number": "STD_ORG_PHONE_NUMBER",
    "EMAIL": "cast(NULL AS varchar)",
    "site_phone_number_10dig": "STD_ORG_PHONE_NUMBER",
    "COMPANY_NAME": "STD_ORG_PHONE_NUMBER",
    "site_phone_6": "substr(STD_ORG_PHONE_NUMBER, 1, 6)",
    "ml_company_name": "replace(STD_ORG_NAME, ' ', '')",
    "ml_company_first_word": "split_part(STD_ORG_NAME, ' ', 1)",
    "site_address_1_original": "STD_ORG_ADDRESS_LINE_1",
    "business_name_gr": "STD_ORG_NAME",
}
_features = "BU_REC_ID AS recordId, " + ", ".join(f"{e} AS {n}" for n, e in FEATURES.items())
_probability = "(o % 50 + 50 - i) / 100.0::DOUBLE"


def _matched(source: str, columns: str, policy: str) -> str:
    """Records of ``source`` with their clusters by arithmetic on the newest order key."""
    if policy == "strict":
        return f"""
            SELECT {columns}, concat('C', cast(o % 97 AS varchar), '-', cast(i AS varchar)) AS ORG_ID,
              {_probability} AS ORG_MATCH_CONFIDENCE
            FROM {source} s JOIN match_answers m ON s.BU_REC_ID = m.BU_REC_ID
            JOIN steps ON i < n_clusters"""
    return f"""
        SELECT {columns},
          CASE WHEN i IS NOT NULL THEN concat('C', cast(o % 97 AS varchar), '-', cast(i AS varchar))
            END AS ORG_ID,
          CASE WHEN i IS NOT NULL THEN {_probability} END AS ORG_MATCH_CONFIDENCE
        FROM {source} s LEFT JOIN match_answers m ON s.BU_REC_ID = m.BU_REC_ID
        LEFT JOIN steps ON i < n_clusters
        WHERE status IS NULL OR n_clusters IS NOT NULL"""


def _blocks(name: str, zip5: str, areacode: str, phone: str) -> str:
    return f"""unnest([
      CASE WHEN split_part({name}, ' ', 1) <> '' AND {zip5} <> ''
        THEN 'word|' || split_part({name}, ' ', 1) || '|' || {zip5} END,
      CASE WHEN {areacode} <> '' AND {phone} <> ''
        THEN 'phone|' || {areacode} || '|' || {phone} END,
      CASE WHEN replace({name}, ' ', '') <> '' THEN 'name|' || replace({name}, ' ', '') END])"""


def _similarity(a: str, b: str) -> str:
    return f"""CASE WHEN greatest(length({a}), length({b})) = 0 THEN 0.0
      ELSE 1 - levenshtein({a}, {b})::DOUBLE / greatest(length({a}), length({b})) END"""


def _native_match(source: str, min_score: float = 0.0) -> str:
    own = _blocks("STD_ORG_NAME", "STD_ORG_ZIP_CODE", "STD_ORG_AREACD", "STD_ORG_PHONE_NUMBER")
    return f"""
        SELECT s.BU_REC_ID, c.ORG_ID, round(c.confidence, 6) AS ORG_MATCH_CONFIDENCE
        FROM {source} s LEFT JOIN (
          SELECT BU_REC_ID, ORG_ID,
            avg(0.6 * ({_similarity('name', 'm_name')})
              + 0.4 * ({_similarity('line1', 'm_line1')})) AS confidence
          FROM (
            SELECT DISTINCT a.BU_REC_ID, a.name, a.line1, m.ORG_ID, m.MEMBER_ID,
              m.name AS m_name, m.line1 AS m_line1
            FROM (
              SELECT BU_REC_ID, STD_ORG_NAME AS name, upper(STD_ORG_ADDRESS_LINE_1) AS line1,
                {own} AS block
              FROM {source}) a
            JOIN (
              SELECT ORG_ID, MEMBER_ID, name, line1,
                {_blocks('name', 'zip5', 'areacode', 'phone')} AS block FROM members) m
              ON a.block = m.block)
          GROUP BY 1, 2) c ON s.BU_REC_ID = c.BU_REC_ID AND c.confidence >= {min_score}"""


def _request(values: dict[str, str | None], columns: dict[str, str]) -> str:
    return ", ".join(
        f"coalesce({columns.get(c, c)}, '') AS {e}" if c else f"'' AS {e}" for e, c in values.items()
    )


PERSON = {
    "PER_FIRST_NAME": "concat('First', cast(k % 19 AS varchar))",
    "PER_MIDDLE_NAME": "CASE WHEN k % 2 = 0 THEN 'm' END",
    "PER_LAST_NAME": "concat('Last', cast(k AS varchar))",
    "PER_PREFIX": "CASE WHEN k % 2 = 0 THEN 'Ms' ELSE 'Mr' END",
    "PER_SUFFIX": "CASE WHEN k % 23 = 0 THEN 'Jr' END",
    "PER_EMAIL": "concat('p', cast(k AS varchar), '@example.org')",
} | {
    f"PER_{f}": f"ORG_{f}"
    for f in (
        "ADDRESS_LINE_1",
        "ADDRESS_LINE_2",
        "ADDRESS_LINE_3",
        "CITY",
        "STATE",
        "ZIP_CODE",
        "ZIP_SUPP",
        "COUNTRY",
        "PHONE_NUMBER",
        "FAX_NUMBER",
    )
}


def _contact_columns() -> str:
    columns = {
        "STD_PER_FIRST_NAME": "concat('FIRST', cast(k % 19 AS varchar))",
        "STD_PER_MIDDLE_INIT": "CASE WHEN k % 2 = 0 THEN 'M' ELSE '' END",
        "STD_PER_LAST_NAME": "concat('LAST', cast(k AS varchar))",
        "STD_PER_PREFIX": "CASE WHEN k % 2 = 0 THEN 'MS' ELSE 'MR' END",
        "STD_PER_SUFFIX": "CASE WHEN k % 23 = 0 THEN 'JR' ELSE '' END",
        "STD_PER_GENDER": "CASE WHEN k % 2 = 0 THEN 'F' ELSE 'M' END",
    }
    for field in layouts.ADDRESS_FIELDS:
        columns[f"STD_PER_{field}"] = f"STD_ORG_{field}"
        if field in layouts.ADDRESS_ELEMENTS:
            hit = field == "CITY"
            for suffix, text in (("FAULT_CD", "S1"), ("FAULT_DESC", "city changed")):
                value = f"CASE WHEN o % 11 = 0 THEN '{text}' ELSE '' END" if hit else "''"
                columns[f"STD_PER_{field}_{suffix}"] = value
    columns |= {"STD_PER_PHONE": "STD_ORG_PHONE", "STD_PER_AREACD": "STD_ORG_AREACD"}
    return ", ".join(f"{e} AS {n}" for n, e in columns.items())


_shape = """SELECT count(*) AS n_rows, cast(sum(cast(SRC_ID AS bigint)) AS bigint) AS sum_of_ids,
    cast(sum(length(STD_ORG_NAME)) AS bigint) AS name_characters FROM stage"""
_sent = ", ".join(f"true AS {n}_sent" for n in ("site_fax", "EMAIL"))
_std = ", ".join(f"c.{c}" for c in STD_COLUMNS)
_audit = ", ".join(f"{v} AS {n}" for n, v in AUDIT.items())
_kept = "s.BU_REC_ID, s.SRC_ID, s.STD_ORG_ZIP9"
_all = ", ".join(f"s.{c}" for c in [*OUTPUT, "STD_ORG_ZIP9"])
_landed = ", ".join(f"s.{c}" for c in [*OUTPUT, "STD_ORG_ZIP9"] if c != "SRC_INPUT_FILE_NAME")

_whole = " || ',' || ".join(f"coalesce({c}, '')" for c in INPUT)

BODIES = {
    "audit_columns": f"SELECT SRC_ID, SRC_TP_CD, {_audit} FROM accounts",
    "ordered_rename": "SELECT * FROM stage",
    "record_id_hash": "SELECT BU_REC_ID, SRC_TP_CD, SRC_ID FROM accounts",
    "record_id_numbered": """
        SELECT CASE WHEN n = 0 THEN BU_REC_ID ELSE md5(BU_REC_ID || '#' || n::VARCHAR) END
            AS BU_REC_ID, SRC_TP_CD, SRC_ID
        FROM (SELECT *, unnest(range(CASE k % 10 WHEN 0 THEN 2 WHEN 1 THEN 3 ELSE 1 END)) AS n
          FROM accounts)""",
    "record_id_uuid": """
        SELECT cast(count(*) AS bigint) AS n_rows, cast(1 AS bigint) AS max_per_id,
          cast(count(*) AS bigint) AS n_version_4 FROM accounts""",
    "blank_fill": f"""
        SELECT {_blank(INPUT)}, CASE WHEN k % 5 <> 0 THEN k END AS NUMBER FROM accounts""",
    "zip9": """
        SELECT BU_REC_ID, concat_ws('-', ORG_ZIP_CODE, ORG_ZIP_SUPP) AS STD_ORG_ZIP9 FROM accounts""",
    "match_features": f"SELECT {_features} FROM filled",
    "match_request_json": f"SELECT {_features}, {_sent} FROM filled",
    "parse_match_bodies": f"""
        SELECT md5(concat(length(c_mktsegment), ':', c_mktsegment,
            length(cast(c_custkey AS varchar)), ':', c_custkey)) AS BU_REC_ID,
          concat(strftime(o_orderdate, '%Y-%m-%d'), '#', lpad(cast(o AS varchar), 12, '0'))
            AS received_at,
          status, well_formed, i AS pos,
          CASE WHEN i IS NOT NULL THEN concat('C', cast(o % 97 AS varchar), '-', cast(i AS varchar))
            END AS clusterId,
          CASE WHEN i IS NOT NULL THEN {_probability} END AS avgMatchProb
        FROM (
          SELECT o_custkey, o_orderdate, o_orderkey AS o,
            CASE WHEN o_orderkey % 20 = 0 THEN 500 WHEN o_orderkey % 20 <> 1 THEN 200 END AS status,
            o_orderkey % 20 IN (0, 1) OR o_orderkey % 37 <> 0 AS well_formed,
            CASE WHEN o_orderkey % 20 NOT IN (0, 1) AND o_orderkey % 37 <> 0
              THEN o_orderkey % 4 END AS n_clusters
          FROM orders) JOIN customer ON o_custkey = c_custkey LEFT JOIN steps ON i < n_clusters""",
    "latest_match_responses": """
        SELECT BU_REC_ID, status, CASE
            WHEN coalesce(status, 0) <> 200 THEN NULL
            ELSE CASE WHEN o % 37 = 0 THEN 6 ELSE 1 END
              + (length(cast(o % 97 AS varchar)) + 43)
                * (CASE WHEN o % 37 = 0 THEN least(o % 4, 1) ELSE o % 4 END)
          END AS body_length FROM match_answers""",
    "attach_matches_lenient": _matched("filled", _kept, "lenient"),
    "attach_matches_strict": _matched("filled", _kept, "strict"),
    "rejects_match": """
        SELECT a.BU_REC_ID, 'match' AS stage, status,
          CASE WHEN status IS NULL THEN 'no answer' WHEN status <> 200 THEN 'status'
            ELSE 'malformed' END AS reason
        FROM accounts a LEFT JOIN match_answers m ON a.BU_REC_ID = m.BU_REC_ID
        WHERE n_clusters IS NULL""",
    "cleanse_request_accounts": f"""
        SELECT BU_REC_ID, {_request(layouts.ACCOUNT_REQUEST, {})} FROM accounts""",
    "cleanse_request_contact": f"""
        SELECT BU_REC_ID, {_request(layouts.CONTACT_REQUEST, PERSON)} FROM accounts""",
    "flatten_cleansing_accounts": f"SELECT BU_REC_ID, {_std} FROM cleansed c",
    "flatten_cleansing_contact": f"SELECT BU_REC_ID, {_contact_columns()} FROM cleansed",
    "attach_cleansing": f"""
        SELECT a.BU_REC_ID, {_blank(INPUT, 'a.')}, {_audit}, {_std}
        FROM accounts a LEFT JOIN cleansed c ON a.BU_REC_ID = c.BU_REC_ID""",
    "attach_cleansing_contact": f"""
        SELECT a.BU_REC_ID, {', '.join(f'{e} AS {n}' for n, e in PERSON.items())},
          p.* EXCLUDE (answered)
        FROM accounts a LEFT JOIN (
          SELECT BU_REC_ID AS answered, {_contact_columns()} FROM cleansed) p
          ON a.BU_REC_ID = answered""",
    "rejects_cleanse": """
        SELECT a.BU_REC_ID, 'cleanse' AS stage, status,
          CASE WHEN status IS NULL THEN 'no answer' WHEN status <> 200 THEN 'status'
            ELSE 'malformed' END AS reason
        FROM accounts a LEFT JOIN (
          SELECT BU_REC_ID, o,
            CASE WHEN o % 31 = 0 THEN 500 WHEN o % 31 <> 1 THEN 200 END AS status
          FROM newest) n ON a.BU_REC_ID = n.BU_REC_ID
        WHERE status IS NULL OR status <> 200 OR o % 41 = 0 OR o % 43 = 0""",
    "standardize_native": f"""
        SELECT a.BU_REC_ID, {_blank(INPUT, 'a.')}, {_audit},
          {', '.join(f'{e} AS {n}' for n, e in _native.items())} {_native_source}""",
    "match_native": _native_match("filled"),
    "match_native_confident": _native_match("filled", 0.95),
    "sorted_output": """
        SELECT SRC_ID, BU_REC_ID, row_number() OVER (ORDER BY SRC_ID, BU_REC_ID) AS place
        FROM accounts""",
    "capped_output": """
        SELECT SRC_ID, BU_REC_ID, SRC_ORG_NAME FROM stage ORDER BY SRC_ID, BU_REC_ID LIMIT 50""",
    "preview_rows": """
        SELECT SRC_ID, BU_REC_ID, SRC_ORG_NAME FROM stage ORDER BY SRC_ID, BU_REC_ID LIMIT 20""",
    "spread_invariant": _shape,
    "spread_by_key_invariant": _shape,
    "ordered_files": """
        SELECT cast(count(*) AS bigint) AS n_rows, cast(0 AS bigint) AS n_out_of_order
        FROM accounts""",
    **{
        f"sink_{kind}": f"SELECT {_blank(OUTPUT)} FROM stage"
        for kind in (
            "roundtrip_csv",
            "roundtrip_tab",
            "roundtrip_parquet",
            "roundtrip_json",
            "roundtrip_orc",
            "table",
        )
    },
    "sink_table_append": """
        SELECT BU_REC_ID, SRC_ID FROM accounts UNION ALL SELECT BU_REC_ID, SRC_ID FROM accounts""",
    "scan_inferred": f"""
        SELECT {', '.join(f'cast({c} AS bigint) AS {c}' if c in
            ('SRC_ID', 'ORG_ZIP_CODE', 'ORG_ZIP_SUPP', 'ORG_PHONE_NUMBER')
            else f"nullif({c}, '') AS {c}" for c in INPUT)} FROM accounts""",
    "scan_feed": f"""
        SELECT {', '.join(f"nullif({c}, '') AS {c}" for c in INPUT)} FROM accounts""",
    "rejects_scan": f"""
        SELECT * FROM (
          SELECT CASE WHEN SRC_TP_CD = 'SUPPLIER' THEN 'header' WHEN k % 10 IN (0, 3) THEN 'x'
              WHEN k % 10 = 1 THEN 'surplus' WHEN k % 10 = 2 THEN 'quotes' ELSE 'row' END AS kind,
            CASE WHEN SRC_TP_CD = 'SUPPLIER' THEN {_whole}
              WHEN k % 10 = 1 THEN {_whole} || ',more' WHEN k % 10 = 2 THEN {_whole} || '"open'
              ELSE concat_ws(',', SRC_ID, nullif(ORG_NAME, ''), ORG_WEBSITE) END AS line
          FROM accounts) WHERE kind <> 'x'
        UNION ALL
        SELECT 'short', SRC_ID || ',' || SRC_TP_CD FROM accounts
          WHERE SRC_TP_CD <> 'SUPPLIER' AND k % 10 = 0
        UNION ALL
        SELECT 'quotes', '"' || SRC_ID FROM accounts WHERE SRC_TP_CD <> 'SUPPLIER' AND k % 10 = 3
        UNION ALL
        SELECT 'quotes', '",' || SRC_TP_CD FROM accounts
          WHERE SRC_TP_CD <> 'SUPPLIER' AND k % 10 = 3""",
    "landing_quarantine": """
        SELECT kind, count(*) AS n FROM damaged_lines GROUP BY kind
        UNION ALL SELECT 'listed rows', count(*) FROM damaged_lines WHERE sound
        UNION ALL SELECT 'listed rejects', count(*) FROM damaged_lines WHERE NOT sound""",
    "stage_handoff": "SELECT * FROM stage",
    "partition_hook": """
        SELECT BU_REC_ID, length(STD_ORG_NAME) AS NAME_LENGTH
        FROM stage JOIN steps ON i < cast(SRC_ID AS bigint) % 3""",
    "standardize_feed": "SELECT * FROM standardized",
    "standardize_feed_native": "SELECT * FROM native",
    "match_feed_lenient": _matched("standardized_filled", _all, "lenient"),
    "match_feed_strict": _matched(
        "(SELECT * FROM standardized_filled ORDER BY SRC_ID, BU_REC_ID LIMIT 50)", _all, "strict"
    ),
    "match_feed_strict_whole": _matched("standardized_filled", _all, "strict"),
    "standardize_contacts": f"""
        SELECT a.BU_REC_ID, {', '.join(f'{e} AS SRC_{n}' for n, e in PERSON.items())},
          p.* EXCLUDE (answered)
        FROM accounts a LEFT JOIN (
          SELECT BU_REC_ID AS answered, {_contact_columns()} FROM cleansed) p
          ON a.BU_REC_ID = answered""",
    "match_feed_native": _native_match("native_filled"),
    "publish_feed": f"""
        SELECT sink, m.* FROM (SELECT unnest(['csv', 'table']) AS sink) CROSS JOIN
          ({_matched('standardized_filled', 's.BU_REC_ID', 'lenient')}) m""",
    "landing_ingest": f"""
        SELECT {', '.join(f"nullif({c}, '') AS {c}" for c in INPUT)}, true AS tagged FROM accounts""",
    "stream_feed": f"""
        SELECT m.*, cast(SRC_TP_CD = 'SUPPLIER' AS int) AS batch_id, true AS tagged
        FROM ({_matched('standardized_filled', _landed, 'lenient')}) m""",
    "stream_feed_replayed": f"""
        SELECT m.*, true AS tagged
        FROM ({_matched('standardized_filled', _landed, 'lenient')}) m""",
    # settled by the run that finds an answer of each kind: none in the first, then some, then all
    "stream_late_feed": f"""
        SELECT r.*, CASE WHEN n.BU_REC_ID IS NULL THEN 3 WHEN r.BU_REC_ID < '8' THEN 1 ELSE 2 END
            AS batch_id, true AS tagged
        FROM ({_matched('standardized_filled', _landed, 'lenient')}) r
        LEFT JOIN newest n ON n.BU_REC_ID = r.BU_REC_ID""",
}

ORACLE = {name: _with(body) for name, body in BODIES.items()}
