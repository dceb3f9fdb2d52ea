"""Column layouts of the account and contact feeds and of the two service exchanges."""

from __future__ import annotations

PROCESS_TYPES = ("ACCOUNTS", "CONTACT")

# --- fixed values: the layouts below must equal the published feed layouts ---

ACCOUNT_FILE = {
    "file_type": "CSV",
    "process_type": "ACCOUNTS",
    "delimiter": ",",
    "has_header": False,
    "encoding": "UTF-8",
}

# position, name (all STRING)
ACCOUNT_INPUT = """
1 SRC_ID
2 SRC_TP_CD
3 ORG_NAME
4 ORG_ADDRESS_LINE_1
6 ORG_ADDRESS_LINE_2
7 ORG_ADDRESS_LINE_3
8 ORG_CITY
9 ORG_STATE
10 ORG_ZIP_CODE
11 ORG_ZIP_SUPP
12 ORG_COUNTRY
13 ORG_PHONE_NUMBER
14 ORG_FAX_NUMBER
15 ORG_WEBSITE
"""

# source column, target column, in output order
ACCOUNT_OUTPUT = """
BU_REC_ID BU_REC_ID
SRC_ID SRC_ID
SRC_TP_CD SRC_TP_CD
SRC_INPUT_FILE_NAME SRC_INPUT_FILE_NAME
ORG_NAME SRC_ORG_NAME
ORG_ADDRESS_LINE_1 SRC_ORG_ADDRESS_LINE_1
ORG_ADDRESS_LINE_2 SRC_ORG_ADDRESS_LINE_2
ORG_ADDRESS_LINE_3 SRC_ORG_ADDRESS_LINE_3
ORG_CITY SRC_ORG_CITY
ORG_STATE SRC_ORG_STATE
ORG_ZIP_CODE SRC_ORG_ZIP_CODE
ORG_ZIP_SUPP SRC_ORG_ZIP_SUPP
ORG_COUNTRY SRC_ORG_COUNTRY
ORG_PHONE_NUMBER SRC_ORG_PHONE_NUMBER
ORG_FAX_NUMBER SRC_ORG_FAX_NUMBER
ORG_WEBSITE SRC_ORG_WEBSITE
STD_ORG_NAME STD_ORG_NAME
STD_ORG_ADDR1 STD_ORG_ADDRESS_LINE_1
STD_ORG_ADDR2 STD_ORG_ADDRESS_LINE_2
STD_ORG_CITY STD_ORG_CITY
STD_ORG_COUNTY STD_ORG_COUNTY
STD_ORG_STATE STD_ORG_STATE
STD_ORG_ZIP STD_ORG_ZIP_CODE
STD_ORG_ZIP4 STD_ORG_ZIP_SUPP
STD_ORG_COUNTRY STD_ORG_COUNTRY
STD_ORG_ADDR_LOC_TYPE STD_ORG_ADDR_LOC_TYPE
STD_ORG_ADDR_TYPE STD_ORG_ADDR_TYPE
STD_ORG_CHECK_DIGIT STD_ORG_CHECK_DIGIT
STD_ORG_CMRA_CD STD_ORG_CMRA_CD
STD_ORG_DLVRY_POINT_CD STD_ORG_DLVRY_POINT_CD
STD_ORG_DPV_NOTE STD_ORG_DPV_NOTE
STD_ORG_DPV_STATUS STD_ORG_DPV_STATUS
STD_ORG_ELOT STD_ORG_ELOT
STD_ORG_ELOT_ORDER STD_ORG_ELOT_ORDER
STD_ORG_FAULT_CD STD_ORG_FAULT_CD
STD_ORG_FAULT_DESC STD_ORG_FAULT_DESC
STD_ORG_LAT STD_ORG_LAT
STD_ORG_LONG STD_ORG_LONG
STD_ORG_NOTES STD_ORG_NOTES
STD_ORG_PRIM_RANGE STD_ORG_PRIM_RANGE
STD_ORG_RESIDENT_DLVRY_IND STD_ORG_RESIDENT_DLVRY_IND
STD_ORG_ROUTE_CD STD_ORG_ROUTE_CD
STD_ORG_STREET_TYPE STD_ORG_STREET_TYPE
STD_ORG_PHONE STD_ORG_PHONE_NUMBER
STD_ORG_AREACD STD_ORG_AREACD
CREATED_DT CREATED_DT
LAST_UPDATED_DT LAST_UPDATED_DT
LAST_UPDATED_USER LAST_UPDATED_USER
"""

# position, name, template
AUDIT_FIELDS = (
    (1, "CREATED_DT", "{CURRENT_DATE}"),
    (2, "LAST_UPDATED_DT", "{CURRENT_DATE}"),
    (3, "LAST_UPDATED_USER", "{CURRENT_USER}"),
    (4, "SRC_INPUT_FILE_NAME", "{INPUT_FILE_NAME}"),
)

# cleansing answer: field -> element of Address (text, may carry FaultCode / FaultDesc)
ADDRESS_ELEMENTS = {
    "ADDR1": "AddrLine1",
    "ADDR2": "AddrLine2",
    "COUNTY": "AddrCounty",
    "CITY": "AddrCity",
    "STATE": "AddrState",
    "ZIP": "AddrZip",
    "ZIP4": "AddrZip4",
    "COUNTRY": "AddrCountry",
    "LONG": "AddrLongitude",
    "LAT": "AddrLatitude",
    "PRIM_RANGE": "AddrPrimRange",
    "NOTES": "AddrNotes",
    "STREET_TYPE": "AddrStreetTp",
    "DLVRY_POINT_CD": "DeliveryPointCode",
    "ROUTE_CD": "RouteCode",
    "CHECK_DIGIT": "CheckDigit",
    "ELOT": "ELot",
    "ELOT_ORDER": "ELotOrder",
}

# cleansing answer: field -> attribute of Address
ADDRESS_ATTRIBUTES = {
    "FAULT_CD": "FaultCode",
    "FAULT_DESC": "FaultDesc",
    "ADDR_TYPE": "AddrType",
    "DPV_STATUS": "DPV_Status",
    "CMRA_CD": "DPV_CMRACd",
    "DPV_NOTE": "DPV_Note",
    "ADDR_LOC_TYPE": "AddrLocType",
    "RESIDENT_DLVRY_IND": "DPV_RsdntlDlvryInd",
}

# cleansing answer, contact form: field -> element of Profile
PERSON_ELEMENTS = {
    "FIRST_NAME": "FirstNm",
    "MIDDLE_INIT": "MiddleNm",
    "LAST_NAME": "LastNm",
    "PREFIX": "Prefx",
    "SUFFIX": "Suffx",
    "GENDER": "Gender",
}

# cleansing request: element -> input column; None is always sent blank
ACCOUNT_REQUEST = {
    "OrgNm": "ORG_NAME",
    "AddrLine1": "ORG_ADDRESS_LINE_1",
    "AddrLine2": "ORG_ADDRESS_LINE_2",
    "AddrLine3": "ORG_ADDRESS_LINE_3",
    "AddrCity": "ORG_CITY",
    "AddrState": "ORG_STATE",
    "AddrZip": "ORG_ZIP_CODE",
    "AddrZip4": "ORG_ZIP_SUPP",
    "AddrCountry": "ORG_COUNTRY",
    "Phone": "ORG_PHONE_NUMBER",
}

CONTACT_REQUEST = {
    "Title": None,
    "FirstNm": "PER_FIRST_NAME",
    "MiddleNm": "PER_MIDDLE_NAME",
    "LastNm": "PER_LAST_NAME",
    "Prefx": "PER_PREFIX",
    "Suffx": "PER_SUFFIX",
    "OrgNm": None,
    "AddrLine1": "PER_ADDRESS_LINE_1",
    "AddrLine2": "PER_ADDRESS_LINE_2",
    "AddrLine3": "PER_ADDRESS_LINE_3",
    "AddrCity": "PER_CITY",
    "AddrState": "PER_STATE",
    "AddrZip": "PER_ZIP_CODE",
    "AddrZip4": "PER_ZIP_SUPP",
    "AddrCountry": "PER_COUNTRY",
    "Phone": "PER_PHONE_NUMBER",
    "Email": "PER_EMAIL",
}

# --- end of fixed values ---

ADDRESS_FIELDS = (*ADDRESS_ELEMENTS, *ADDRESS_ATTRIBUTES)
STD_ORG_FIELDS = ("NAME", *ADDRESS_FIELDS, "PHONE", "AREACD")
CONTACT_INPUT = (
    *(c for c in CONTACT_REQUEST.values() if c and c not in ("PER_PHONE_NUMBER", "PER_EMAIL")),
    "PER_PHONE_NUMBER",
    "PER_FAX_NUMBER",
    "PER_EMAIL",
)


def check_process_type(process_type: str) -> str:
    if process_type not in PROCESS_TYPES:
        raise ValueError(f"process type must be one of {PROCESS_TYPES}, not {process_type!r}")
    return process_type
