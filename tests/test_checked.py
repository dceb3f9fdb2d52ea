"""Checked scans and ingests: every line is a row or a reject, and no file stops another."""

import os

import pytest
from conftest import rows
from test_files import small_spec, write

from acctweave import sources, streaming
from acctweave.specs import FeedSpec

SPEC = small_spec(has_header=False)
LINES = 'ID|ZIP\n1|07030\n2\n3|1|2\n4|"a|b"\n5|"open\n\n6|"two\nlines"\n7|say \\"x\\"\n'


def checked(spark, path, spec=SPEC, **options):
    df = sources.scan_checked(spark, path, spec, header=True, **options)
    return rows(sources.sound_rows(df)), [(r[1], r[2]) for r in rows(sources.scan_rejects(df))]


def test_every_line_is_a_row_or_a_reject(spark, folder):
    good, bad = checked(spark, write(f"{folder}/a.csv", LINES))
    assert good == [("1", "07030"), ("4", "a|b"), ("7", 'say \\"x\\"')]
    assert sorted(bad) == [
        ("quotes", '5|"open'), ("quotes", '6|"two'), ("quotes", 'lines"'), ("short", "2"),
        ("surplus", "3|1|2"),
    ]


def test_records_may_span_lines_where_asked_for(spark, folder):
    text = 'ID|ZIP\n1|07030\n2\n6|"two\nlines"\n7|x|y\n'
    good, bad = checked(spark, write(f"{folder}/a.csv", text), multiline=True)
    assert good == [("1", "07030"), ("6", "two\nlines")]
    assert sorted(bad) == [("short", "2"), ("surplus", "7|x|y")]


@pytest.mark.parametrize("multiline", [False, True])
def test_a_wrong_header_rejects_its_file_only(spark, folder, multiline):
    write(f"{folder}/in/good.csv", "ID|ZIP\n1|07030\n")
    write(f"{folder}/in/wrong.csv", "ZIP|ID\n07030|1\n")
    write(f"{folder}/in/none.csv", "")
    good, bad = checked(spark, f"{folder}/in", multiline=multiline)
    assert good == [("1", "07030")]
    assert bad == [("header", "07030|1"), ("header", "ZIP|ID")]


def test_declared_types_and_encodings(spark, folder):
    spec = FeedSpec.from_dict(
        {
            "file_config": {
                "process_type": "ACCOUNTS",
                "delimiter": "|",
                "attributes": {"encoding": "ISO-8859-1", "has_header": True},
            },
            "input_fields": [
                {"position": 1, "name": "ID", "type": "INT"},
                {"position": 2, "name": "NAME", "type": "STRING"},
            ],
            "output_fields": [],
        }
    )
    path = write(f"{folder}/a.csv", "ID|NAME\n1|é\nx|b\n", encoding="iso-8859-1")
    df = sources.scan_checked(spark, path, spec)
    assert rows(sources.sound_rows(df)) == [(1, "é")]
    assert rows(sources.scan_rejects(df)) == [("a.csv", "value", "x|b")]


def test_rows_equal_those_of_the_plain_scan(spark, folder):
    path = write(f"{folder}/a.csv", 'ID|ZIP\n1|\n|2\n"3"|""\n 4 |"a b"\n')
    df = sources.scan_checked(spark, path, SPEC, header=True)
    assert rows(sources.sound_rows(df)) == rows(sources.scan_feed(spark, path, SPEC, header=True))


def test_a_bad_file_does_not_stop_the_stream(spark, folder):
    paths = {n: f"{folder}/{n}" for n in ("in", "out", "bad", "files", "offsets")}
    os.makedirs(paths["in"])

    def ingest():
        streaming.ingest_checked(
            spark, paths["in"], SPEC, paths["out"], paths["bad"], paths["files"], paths["offsets"], True
        )

    write(f"{paths['in']}/a.csv", "ID|ZIP\n1|07030\n2\n")
    ingest()
    write(f"{paths['in']}/b.csv", "ZIP|ID\n07030|1\n")
    write(f"{paths['in']}/c.csv", "ID|ZIP\n3|10001\n")
    ingest()
    ingest()
    assert rows(spark.read.parquet(paths["out"]).select("ID", "ZIP", "LANDED_FILE")) == [
        ("1", "07030", "a.csv"), ("3", "10001", "c.csv"),
    ]
    assert rows(spark.read.parquet(paths["files"]).drop("batch_id")) == [
        ("a.csv", 1, 1, "partly"), ("b.csv", 0, 2, "quarantined"), ("c.csv", 1, 0, "ingested"),
    ]
    assert spark.read.parquet(paths["bad"]).count() == 3
