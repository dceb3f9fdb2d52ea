"""Quality rules as a short-circuit cascade: cheap rules that reject much are asked first.

Every rule is one boolean expression over a text and its words. Cost and selectivity of each are
measured on a sample, the rules are put in order of rejections per second, and one ``CASE`` asks
them in that order: a text that a rule rejects never meets the rules behind it. The order decides
what the cascade costs, not what it keeps. All of it is Spark SQL expressions, without a shuffle.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acctweave.llm import common
from acctweave.operators.handoff import hand_off

#: Rows, as expected, that costs and selectivities are measured on, and the partitions they fill.
SAMPLE, SAMPLE_PARTITIONS = 2_000, 8
#: Each rule is timed so often on the sample; the fastest run counts.
RUNS = 2

SPACES = r"[\x20\x09-\x0D]+"
INK = r"[^\x20\x09-\x0D]"
SYMBOLS = "[#*$%&|<>]"
#: A text with fewer words, or with this percentage of its words in repeated windows, fails the base.
MIN_WORDS, MAX_REPEATED = 50, 50


# ---- measures of one text ----


def words_of(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text that is not null, unchanged and in order."""
    return F.array_remove(F.split(text, SPACES), "")


def lines_of(text: Column) -> Column:
    """Lines that hold a word."""
    return F.filter(F.split(text, "\n"), lambda line: F.rlike(line, F.lit(INK)))


def letters_in(words: Column) -> Column:
    """Characters of all ``words`` together."""
    return F.length(F.array_join(words, ""))


def symbols(text: Column) -> Column:
    return F.regexp_count(text, F.lit(SYMBOLS))


def duplicates(lines: Column) -> Column:
    """How many of ``lines`` equal an earlier one."""
    return F.size(lines) - F.size(F.array_distinct(lines))


def repeated_words(words: Column) -> Column:
    """Words inside a window of three words that occurs at least twice in the text.

    Where all windows differ in their hashes, none occurs twice. Otherwise the windows are sorted,
    so that equal ones meet, and compared by their words.
    """
    n = F.greatest(F.size(words) - 2, F.lit(0))
    hashes = F.transform(
        F.slice(words, 1, n),
        lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)),
    )
    windows = F.arrays_zip(
        F.slice(words, 1, n).alias("a"),
        F.slice(words, 2, n).alias("b"),
        F.slice(words, 3, n).alias("c"),
        F.sequence(F.lit(1), n).alias("at"),
    )

    def covered(ordered: Column) -> Column:
        def beside(x: Column, i: Column) -> Column:
            y = F.get(ordered, i + 1)
            equal = (x["c"] == y["c"]) & (x["b"] == y["b"]) & (x["a"] == y["a"])
            places = (start["at"] + k for start in (x, y) for k in range(3))
            return F.when(equal, F.array(*places))

        places = F.flatten(F.array_compact(F.transform(ordered, beside)))
        return F.size(F.array_distinct(places))

    # a one-element array around the sorted windows, so that they are sorted once
    counted = F.get(F.transform(F.array(F.sort_array(windows)), covered), F.lit(0))
    return F.when(F.size(F.array_distinct(hashes)) < n, counted).otherwise(0)


# ---- rules ----


@dataclass(frozen=True)
class Rule:
    """``rejects(text, words, lines)`` is true for texts to drop; null counts as not rejected."""

    name: str
    rejects: Callable[[Column, Column, Column], Column]


def _number(parts: Column, pattern: str) -> Column:
    """How many of ``parts`` match ``pattern`` somewhere."""
    return F.size(F.filter(parts, lambda part: F.rlike(part, F.lit(pattern))))


RULES = (
    # more than one symbol for ten words
    Rule("symbols", lambda text, words, lines: 10 * symbols(text) > F.size(words)),
    # more than half of the words start with two capitals
    Rule(
        "capitals",
        lambda text, words, lines: 2 * _number(words, r"^\p{Lu}{2}") > F.size(words),
    ),
    # under three fifths of the words hold a letter
    Rule(
        "letterless",
        lambda text, words, lines: 5 * _number(words, r"\p{L}") < 3 * F.size(words),
    ),
    # words under two or above fifteen characters on average
    Rule(
        "word_length",
        lambda text, words, lines: ~letters_in(words).between(
            2 * F.size(words), 15 * F.size(words)
        ),
    ),
    # more than one run of !! or ?? for ten words
    Rule(
        "exclaiming",
        lambda text, words, lines: 10 * F.regexp_count(text, F.lit("[!?]{2,}")) > F.size(words),
    ),
    # more than three of ten lines are repeated ones
    Rule(
        "repeated_lines",
        lambda text, words, lines: 10 * duplicates(lines) > 3 * F.size(lines),
    ),
    # more than nine of ten lines, of five at least, are items of a list
    Rule(
        "listing",
        lambda text, words, lines: (F.size(lines) >= 5)
        & (10 * _number(lines, r"^[ \t]*([-*|•]|[0-9]+[.)])") > 9 * F.size(lines)),
    ),
    # more than three of ten lines break off in dots
    Rule(
        "broken_off",
        lambda text, words, lines: 10 * _number(lines, r"(\.\.\.|…)[\x20\x09-\x0D]*\z")
        > 3 * F.size(lines),
    ),
    # more than a tenth of the characters stand in words of over 100 characters
    Rule(
        "unbroken",
        lambda text, words, lines: 10 * letters_in(F.filter(words, lambda w: F.length(w) > 100))
        > letters_in(words),
    ),
)


@dataclass(frozen=True)
class Measured:
    rule: Rule
    seconds: float
    rejected: float

    @property
    def worth(self) -> float:
        return self.rejected / max(self.seconds, 1e-4)


def _rejects(rule: Rule, *parts: Column) -> Column:
    return F.coalesce(rule.rejects(*parts), F.lit(False))


def _split(docs: DataFrame, text: str, names: Sequence[str]) -> DataFrame:
    """``docs`` with the whole text (null: empty), its words and its lines as columns ``names``."""
    whole, words, lines = names
    split = docs.withColumn(whole, F.coalesce(F.col(f"`{text}`"), F.lit("")))
    return split.withColumns({words: words_of(F.col(whole)), lines: lines_of(F.col(whole))})


def measure(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> list[Measured]:
    """Seconds and rejected share of every rule, each alone, on a sample of ``docs``.

    Every row is drawn with the same chance, so that ``SAMPLE`` rows are expected whatever the size
    of ``docs``. A sample without rows rejects nothing, which leaves the rules in the order given.
    """
    names = ("text", "words", "lines")
    share = min(1.0, SAMPLE / max(docs.count(), 1))
    drawn = docs.select(F.col(f"`{text}`").alias("text")).sample(share, seed=7)
    rows = _split(drawn.repartition(SAMPLE_PARTITIONS), "text", names)
    rows = hand_off(rows, "quality-sample")

    def timed(*measures: Column) -> tuple[float, tuple]:
        best = float("inf")
        for _ in range(RUNS):
            start = time.perf_counter()
            found = rows.agg(*measures).first()
            best = min(best, time.perf_counter() - start)
        return best, tuple(found)

    read = F.count(F.lit(1)), F.max(F.length("text")), F.max(F.size("words") + F.size("lines"))
    idle, (n, _, _) = timed(*read)
    out = []
    for rule in rules:
        wanted = F.count_if(_rejects(rule, *map(F.col, names)))
        spent, found = timed(*read, wanted)
        out.append(Measured(rule, max(spent - idle, 0.0), found[-1] / n if n else 0.0))
    return out


def order(measured: Sequence[Measured]) -> list[Rule]:
    """Most rejections per second first; rules of equal worth stay in the order given."""
    return [m.rule for m in sorted(measured, key=lambda m: -m.worth)]


def cascade(rules: Sequence[Rule], text: Column, words: Column, lines: Column) -> Column:
    """Name of the first rule that rejects, else null; later rules are not evaluated then."""
    arms = [(_rejects(rule, text, words, lines), F.lit(rule.name)) for rule in rules]
    if not arms:
        return F.lit(None).cast("string")
    return reduce(lambda chain, arm: chain.when(*arm), arms[1:], F.when(*arms[0]))


def judge(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """``docs`` with a column ``verdict``: the rule that rejects a text, null for texts to keep.

    Which of several rules that reject one text is named depends on the measured order; whether the
    verdict is null does not. A null text is an empty one. Empty texts break no rule of ``RULES``
    (the base of ``query`` fails them). Texts are judged whole, at any length, one by one: repeated
    rows and ids get the same verdict each, other columns pass unchanged, and where ``docs`` has a
    column ``verdict`` the new one is ``verdict_``. An empty table stays empty.
    """
    verdict, *names = common.fresh(docs, "verdict", "_whole", "_words", "_lines")
    chosen = order(measure(docs, rules, text))
    parts = [F.col(f"`{n}`") for n in names]
    return _split(docs, text, names).withColumn(verdict, cascade(chosen, *parts)).drop(*names)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures, base and verdict of every document; texts that fail the base skip the cascade."""
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    chosen = order(measure(docs))
    text, words, lines = map(F.col, ("_whole", "_words", "_lines"))
    measured = _split(docs, "text", ("_whole", "_words", "_lines")).select(
        "*",
        F.size(words).cast("long").alias("n_words"),
        letters_in(words).cast("long").alias("word_chars"),
        symbols(text).cast("long").alias("n_symbols"),
        duplicates(lines).cast("long").alias("n_dup_lines"),
        repeated_words(words).cast("long").alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words")
    )
    kept = F.when(F.col("base_failed"), F.lit(False)).otherwise(
        cascade(chosen, text, words, lines).isNull()
    )
    return measured.withColumn("base_failed", failed).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        kept.alias("kept"),
    )


SQL = r"""
WITH texts AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
),
split AS (
    SELECT r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))
            AS lines
    FROM texts
),
windows AS (
    SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w
    FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM split)
),
repeated AS (
    SELECT r, count(DISTINCT p) AS n_repeat_words
    FROM (
        SELECT r, unnest([i, i + 1, i + 2]) AS p
        FROM (SELECT *, count(*) OVER (PARTITION BY r, w) AS times FROM windows) WHERE times > 1)
    GROUP BY r
),
measured AS (
    SELECT s.*, len(words) AS n_words, len(lines) AS n_lines,
        length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
        length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
        len(lines) - len(list_distinct(lines)) AS n_dup_lines,
        coalesce(n_repeat_words, 0) AS n_repeat_words,
        len(list_filter(words, lambda x: regexp_matches(x, '^\p{Lu}{2}'))) AS capitals,
        length(text) - length(regexp_replace(text, '[^\x20\x09-\x0D]{101,}', '', 'g')) AS unbroken
    FROM split s LEFT JOIN repeated USING (r)
),
based AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars,
    n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
    n_repeat_words::BIGINT AS n_repeat_words, base_failed,
    NOT (base_failed
        OR 10 * n_symbols > n_words
        OR 2 * capitals > n_words
        OR 5 * len(list_filter(words, lambda x: regexp_matches(x, '\p{L}'))) < 3 * n_words
        OR word_chars NOT BETWEEN 2 * n_words AND 15 * n_words
        OR 10 * len(regexp_extract_all(text, '[!?]{2,}')) > n_words
        OR 10 * n_dup_lines > 3 * n_lines
        OR (n_lines >= 5 AND 10 * len(list_filter(lines,
            lambda x: regexp_matches(x, '^[ \t]*([-*|•]|[0-9]+[.)])'))) > 9 * n_lines)
        OR 10 * len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*\z'))) > 3 * n_lines
        OR 10 * unbroken > word_chars) AS kept
FROM based
"""
