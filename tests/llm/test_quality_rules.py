"""Quality rules: measures against plain Python, order of the cascade, and what is never evaluated."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from acctweave.llm import quality_rules as qr

DOCS = "doc_id bigint, text string, verdict string, words int"
TEXTS = [
    "a b c a b c a b",
    "the same line\nthe same line\n\n \nother\r\nother",
    "x # y * z\x0bv\x0cw $%&|<>",
    "one two",
    "",
    None,
    " \t\n ",
    "repeat repeat repeat repeat",
    "  no-break space stays a word",
    "long " * 20_000 + "end",
    " ".join(f"w{i}" for i in range(300)),
]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def repeated(ws):
    times = Counter(zip(ws, ws[1:], ws[2:], strict=False))
    return len({i + k for i in range(len(ws) - 2) if times[tuple(ws[i : i + 3])] > 1 for k in range(3)})


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "v", 1) for i, t in enumerate(TEXTS)], DOCS)


def test_measures_equal_plain_python(docs):
    text = F.coalesce("text", F.lit(""))
    ws, lines = qr.words_of(text), qr.lines_of(text)
    found = docs.select(
        "doc_id",
        ws.alias("ws"),
        qr.letters_in(ws).alias("letters"),
        qr.symbols(text).alias("symbols"),
        qr.duplicates(lines).alias("duplicates"),
        qr.repeated_words(ws).alias("repeated"),
    )
    for r in found.collect():
        own = TEXTS[r.doc_id] or ""
        kept = [x for x in own.split("\n") if words(x)]
        assert r.ws == words(own)
        assert r.letters == sum(map(len, r.ws))
        assert r.symbols == len(re.findall(r"[#*$%&|<>]", own))
        assert r.duplicates == len(kept) - len(set(kept))
        assert r.repeated == repeated(r.ws)


def test_judge_keeps_rows_and_clashing_columns(docs):
    out = qr.judge(docs)
    assert out.columns == [*docs.columns, "verdict_"] and out.count() == len(TEXTS)
    judged = {r.doc_id: r.verdict_ for r in out.collect()}
    # which of several rules that reject it is named, the measured order decides
    assert judged[2] is not None and {judged[10], judged[4], judged[5]} == {None}
    assert qr.judge(docs.where("false")).count() == 0


def test_rules_go_by_rejections_per_second():
    rules = [qr.Rule(n, lambda t, w, x: F.lit(True)) for n in "abc"]
    measured = [qr.Measured(rules[0], 2.0, 0.5), qr.Measured(rules[1], 0.1, 0.2), qr.Measured(rules[2], 1.0, 0.5)]
    assert [r.name for r in qr.order(measured)] == ["b", "c", "a"]


def test_later_rules_are_not_evaluated(docs):
    fails = qr.Rule("fails", lambda t, w, x: F.raise_error(F.lit("evaluated")).cast("boolean"))
    all_of_them = qr.Rule("all", lambda t, w, x: F.lit(True))
    text = F.coalesce("text", F.lit(""))
    named = qr.cascade([all_of_them, fails], text, qr.words_of(text), qr.lines_of(text))
    assert {r[0] for r in docs.select(named).collect()} == {"all"}


def test_order_does_not_change_what_is_kept(docs):
    text = F.coalesce("text", F.lit(""))
    parts = text, qr.words_of(text), qr.lines_of(text)
    there, back = (qr.cascade(rules, *parts).isNull() for rules in (qr.RULES, qr.RULES[::-1]))
    assert docs.where(there != back).count() == 0
