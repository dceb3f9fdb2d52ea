import json

import pytest

from acctweave import layouts
from acctweave.specs import AuditSpec, FeedSpec


def spec_doc(**conf):
    return {
        "file_config": {"file_name": "f.csv", "process_type": "ACCOUNTS", "delimiter": "|"} | conf,
        "input_fields": [
            {"position": 7, "name": "B", "type": "STRING"},
            {"position": 2, "name": "A", "type": "STRING"},
            {"name": "LAST", "type": "INT"},
        ],
        "output_fields": [
            {"position": 2, "source_field": "A", "target_field": "A2"},
            {"position": 1, "source_field": "B", "target_field": "B1"},
        ],
    }


def test_positions_order_the_fields_and_may_have_gaps(folder):
    path = f"{folder}/spec.json"
    with open(path, "w") as f:
        json.dump(spec_doc(attributes={"has_header": True, "encoding": "ISO-8859-1"}), f)
    spec = FeedSpec.from_json(path)
    assert spec.schema.simpleString() == "struct<A:string,B:string,LAST:int>"
    assert spec.outputs == (("B", "B1"), ("A", "A2"))
    assert (spec.delimiter, spec.has_header, spec.encoding) == ("|", True, "ISO-8859-1")


def test_unknown_process_type_is_refused():
    with pytest.raises(ValueError, match="process type"):
        FeedSpec.from_dict(spec_doc(process_type="OTHER"))


def test_built_in_account_layout():
    spec = FeedSpec.accounts()
    assert len(spec.inputs) == 14 and len(spec.outputs) == 48
    assert sum(source != target for source, target in spec.outputs) == 17
    assert len(layouts.STD_ORG_FIELDS) == 29 and len(layouts.CONTACT_INPUT) == 16
    assert {f"STD_ORG_{f}" for f in layouts.STD_ORG_FIELDS} <= {s for s, _ in spec.outputs}


def test_audit_fields_without_position_come_last():
    doc = {"audit_fields": [{"name": "Z", "value": "z"}, {"position": 3, "name": "A", "value": "a"}]}
    assert AuditSpec.from_dict(doc).fields == (("A", "a"), ("Z", "z"))
