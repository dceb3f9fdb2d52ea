"""Feed and audit specs: small driver-side objects that turn into a schema and a select list."""

from __future__ import annotations

import json
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import types as T

from acctweave import layouts

LAST = 999  # position of a field that declares none

TYPES = {"STRING": "string"}  # other declared types are passed to Spark's DDL parser as they are


def _by_position(fields: list[dict]) -> list[dict]:
    return sorted(fields, key=lambda f: f.get("position", LAST))


@dataclass(frozen=True)
class FeedSpec:
    """A delimited feed: how the file is written, its input fields and its output layout."""

    file_name: str
    process_type: str
    delimiter: str
    has_header: bool
    encoding: str
    inputs: tuple[tuple[str, str], ...]
    outputs: tuple[tuple[str, str], ...]

    @classmethod
    def from_dict(cls, doc: dict) -> FeedSpec:
        conf = doc["file_config"]
        attributes = conf.get("attributes", {})
        return cls(
            file_name=conf.get("file_name", ""),
            process_type=layouts.check_process_type(conf["process_type"]),
            delimiter=conf.get("delimiter", ","),
            has_header=attributes.get("has_header", False),
            encoding=attributes.get("encoding", "UTF-8"),
            inputs=tuple(
                (f["name"], TYPES.get(f["type"].upper(), f["type"]))
                for f in _by_position(doc["input_fields"])
            ),
            outputs=tuple(
                (f["source_field"], f["target_field"]) for f in _by_position(doc["output_fields"])
            ),
        )

    @classmethod
    def from_json(cls, path: str) -> FeedSpec:
        return cls.from_dict(json.loads(Path(path).read_text(encoding="utf-8")))

    @classmethod
    def accounts(cls, file_name: str = "") -> FeedSpec:
        """The built-in 14-column account feed with its 48-column output."""
        conf = layouts.ACCOUNT_FILE
        inputs = [line.split() for line in layouts.ACCOUNT_INPUT.strip().splitlines()]
        outputs = [line.split() for line in layouts.ACCOUNT_OUTPUT.strip().splitlines()]
        return cls(
            file_name=file_name,
            process_type=conf["process_type"],
            delimiter=conf["delimiter"],
            has_header=conf["has_header"],
            encoding=conf["encoding"],
            inputs=tuple((name, "string") for _, name in inputs),
            outputs=tuple((source, target) for source, target in outputs),
        )

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(", ".join(f"`{name}` {kind}" for name, kind in self.inputs))

    @property
    def stage_schema(self) -> T.StructType:
        """Schema of the standardized layout, for the hand-off between the two stages."""
        return T.StructType([T.StructField(target, T.StringType()) for _, target in self.outputs])


@dataclass(frozen=True)
class AuditSpec:
    """Ordered (name, template) pairs."""

    fields: tuple[tuple[str, str], ...]

    @classmethod
    def from_dict(cls, doc: dict) -> AuditSpec:
        return cls(tuple((f["name"], f["value"]) for f in _by_position(doc["audit_fields"])))

    @classmethod
    def from_json(cls, path: str) -> AuditSpec:
        return cls.from_dict(json.loads(Path(path).read_text(encoding="utf-8")))

    @classmethod
    def default(cls) -> AuditSpec:
        return cls(tuple((name, template) for _, name, template in layouts.AUDIT_FIELDS))
