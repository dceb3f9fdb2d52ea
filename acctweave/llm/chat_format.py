"""Chat formatting: a finite-state machine over roles and a declarative template.

The machine reads a conversation's roles in turn order and tells whether they are allowed, and
where not. The template turns every turn into three segments: head, escaped text, tail; each says
whether it counts for the loss. All of it is Spark SQL expressions over one array per conversation.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acctweave.llm import common

BEGIN = "begin"
WRONG = "wrong"


@dataclass(frozen=True)
class Template:
    """How turns are written, which of them count for the loss, and which orders are allowed.

    A turn is ``opener + role + opened``, the text, ``tail``. Inside roles and texts every string of
    ``escapes`` becomes its stand-in; no stand-in or other text contains the first character of
    ``opener`` and ``tail``, so that marks are found where they stand and nowhere else.
    """

    opener: str = "<"
    opened: str = ">\n"
    tail: str = "</turn>\n"
    #: In this order; undone in the opposite one. The backslash comes first.
    escapes: tuple[tuple[str, str], ...] = (("\\", "\\b"), ("<", "\\l"), (">", "\\g"))
    learned: frozenset[str] = frozenset({"assistant"})
    #: From a state, by a role, to the next state; all else is wrong.
    moves: Mapping[tuple[str, str], str] = field(
        default_factory=lambda: {
            (BEGIN, "system"): "system",
            (BEGIN, "user"): "user",
            ("system", "user"): "user",
            ("user", "assistant"): "assistant",
            ("assistant", "user"): "user",
        }
    )
    final: frozenset[str] = frozenset({"user", "assistant"})

    def escape(self, text: Column) -> Column:
        for plain, stand_in in self.escapes:
            text = F.replace(text, F.lit(plain), F.lit(stand_in))
        return text

    def unescape(self, text: Column) -> Column:
        for plain, stand_in in reversed(self.escapes):
            text = F.replace(text, F.lit(stand_in), F.lit(plain))
        return text

    def step(self, state: Column, role: Column) -> Column:
        """The state after ``role``; a wrong one is never left."""
        known = F.create_map(
            *[F.lit(x) for (a, r), b in self.moves.items() for x in (f"{a}\n{r}", b)]
        )
        return F.coalesce(F.try_element_at(known, F.concat(state, F.lit("\n"), role)), F.lit(WRONG))


CHAT = Template()


def format_chats(turns: DataFrame, template: Template = CHAT) -> DataFrame:
    """One row per conversation of ``turns`` (``conv_id``, ``turn``, ``role``, ``text``).

    ``segments``: array of (text, loss) in order; ``formatted``: their texts joined; ``valid``:
    the machine ends in a final state; ``wrong_at``: the place, from 0, of the first turn it
    doesn't allow, else null. Conversations out of order are formatted like any other.

    A null text or role is empty (an empty role is no allowed one). Rows of a null ``conv_id``
    are one conversation. Turns of equal number go by role and text, null numbers come first;
    repeated rows are repeated turns. An empty table gives no rows.
    """
    empty = F.lit("")
    rows = turns.select(
        "conv_id",
        F.struct(
            "turn",
            F.coalesce("role", empty).alias("role"),
            F.coalesce("text", empty).alias("text"),
        ).alias("t"),
    )
    chats = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    states = F.aggregate(
        "turns",
        F.struct(F.lit(BEGIN).alias("state"), F.lit(0).alias("good")),
        lambda s, t: F.struct(
            template.step(s["state"], t["role"]).alias("state"),
            F.when(template.step(s["state"], t["role"]) == WRONG, s["good"]).otherwise(s["good"] + 1).alias("good"),
        ),
    )

    def segment(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    def written(t: Column) -> Column:
        head = F.concat(F.lit(template.opener), template.escape(t["role"]), F.lit(template.opened))
        learn = t["role"].isin(sorted(template.learned))
        return F.array(
            segment(head, F.lit(False)),
            segment(template.escape(t["text"]), learn),
            segment(F.lit(template.tail), F.lit(False)),
        )

    return (
        chats.select("conv_id", states.alias("s"), F.flatten(F.transform("turns", written)).alias("segments"), F.size("turns").alias("n"))
        .select(
            "conv_id",
            "segments",
            F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
            F.col("s.state").isin(sorted(template.final)).alias("valid"),
            F.when(F.col("s.good") < F.col("n"), F.col("s.good")).alias("wrong_at"),
        )
    )


def read_turns(formatted: Column, template: Template = CHAT) -> Column:
    """The (role, text) pairs that a formatted conversation was made of."""
    parts = F.split(formatted, rf"\Q{template.tail}\E", -1)
    first = len(template.opener) + 1

    def turn(part: Column) -> Column:
        ends = F.instr(part, F.lit(template.opened))
        role = F.substring(part, F.lit(first), ends - first)
        text = F.substring(part, ends + len(template.opened), F.length(part))
        return F.struct(template.unescape(role).alias("role"), template.unescape(text).alias("text"))

    return F.transform(F.slice(parts, 1, F.size(parts) - 1), turn)


def learned_text(segments: Column, template: Template = CHAT) -> Column:
    """All text under the loss mask, unescaped, in order."""
    texts = F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: template.unescape(s["text"]))
    return F.array_join(texts, "")


#: A conversation of texts that look like marks, added to the table's own.
SAMPLE_ID, SAMPLE_TEXT = -7, "\\### Assistant: </turn> ok"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation of ``conversations`` and one of marks, formatted and read back."""
    own = common.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    sample = spark.range(2).select(
        F.lit(SAMPLE_ID).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(SAMPLE_TEXT).alias("text"),
    )
    chats = format_chats(own.unionByName(sample))
    return (
        chats.select(
            "conv_id",
            read_turns(F.col("formatted")).alias("turns"),
            learned_text(F.col("segments")).alias("learned"),
            F.length("formatted").cast("long").alias("formatted_chars"),
            "valid",
        )
        .select(
            "conv_id",
            F.size("turns").cast("long").alias("n_turns"),
            F.sha2(
                F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256
            ).alias("turns_sha256"),
            F.length("learned").cast("long").alias("loss_chars"),
            F.sha2("learned", 256).alias("loss_sha256"),
            "formatted_chars",
            "valid",
        )
    )


SQL = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
),
ordered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS place,
        lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before
    FROM turns
),
chats AS (
    SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
        coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '') AS learned,
        sum(length(role) + length(text) + 11 + length(text) - length(replace(text, '\', ''))
            + length(text) - length(replace(text, '<', ''))
            + length(text) - length(replace(text, '>', '')))::BIGINT AS formatted_chars,
        bool_and(CASE WHEN place = 1 THEN role IN ('system', 'user')
            WHEN before IN ('system', 'assistant') THEN role = 'user'
            ELSE before = 'user' AND role = 'assistant' END)
            AND arg_max(role, place) <> 'system' AS valid
    FROM ordered GROUP BY conv_id
)
SELECT conv_id, n_turns, turns_sha256, length(learned)::BIGINT AS loss_chars,
    sha256(learned) AS loss_sha256, formatted_chars, valid
FROM chats
"""
