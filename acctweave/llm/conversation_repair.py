"""Conversation structure repair: cheapest edits by depth-first branch and bound.

A conversation should read ``(s?(ua)+)?`` by the initials of its roles. Rows are kept, deleted or
given another role, and empty turns are inserted; the search proves that no other edits are cheaper,
and that of equally cheap ones none has a smaller audit.

Conversations are streamed: each is dealt to one task, sorted, and sent there twice, first as short
codes, from which the edits are found, and then as texts, which pass through one by one. A task
holds a few bytes a turn, as the audit itself does, and never the texts of a conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acctweave.llm import common

SPACES = " \t\n\x0b\x0c\r"
ENDS = ".!?"
NONE, BLANK, DUPLICATE, TRUNCATED = range(4)
FAULTS = (None, "blank", "duplicate", "truncated")

# ---- the search ----

#: States after a prefix: nothing, a system turn, a user turn, an answer.
BEGUN, SYSTEM, ASKED, ANSWERED = range(4)
COMPLETE = (BEGUN, ANSWERED)
KEEP = {
    (BEGUN, "s"): SYSTEM,
    (BEGUN, "u"): ASKED,
    (SYSTEM, "u"): ASKED,
    (ASKED, "a"): ANSWERED,
    (ANSWERED, "u"): ASKED,
}
#: Where an inserted turn, or a row given its role, leads; and which role that is.
PUT = (ASKED, ASKED, ANSWERED, ASKED)
ROLE = {ASKED: "user", ANSWERED: "assistant"}
DELETE_COST, INSERT_COST, REROLE_COST, TRUNCATED_COST = 4, 3, 3, 3
FAR = float("inf")


def _edits(initial: str | None, fault: int, state: int) -> list[tuple[str, int, int, int]]:
    """(letter, cost, rows used, next state) of the edits at a row, least letter first.

    Without a row (``initial`` None) a turn can only be inserted.
    """
    put = PUT[state]
    insert = ("I", INSERT_COST, 0, put)
    if initial is None:
        return [insert]
    edits = [("D", DELETE_COST, 1, state), insert]
    if fault in (BLANK, DUPLICATE):
        return edits
    more = TRUNCATED_COST if fault == TRUNCATED else 0
    if (state, initial) in KEEP:
        edits.append(("K", more, 1, KEEP[state, initial]))
    edits.append(("R", REROLE_COST + more, 1, put))
    return edits


def suffix_bounds(initials: Sequence[str], faults: Sequence[int]) -> list[tuple[int, ...]]:
    """For every row and state, a bound that no edits of the rows from there on can undercut.

    Costs alone, taken backwards; the audits, and so the choice among equals, are left to the search.
    """

    def inserted(base: Sequence[float]) -> tuple[int, ...]:
        once = [min(base[s], INSERT_COST + base[PUT[s]]) for s in range(4)]
        return tuple(min(once[s], INSERT_COST + once[PUT[s]]) for s in range(4))

    bounds = [inserted([0 if s in COMPLETE else FAR for s in range(4)])]
    for initial, fault in zip(reversed(initials), reversed(faults), strict=True):
        after = bounds[-1]
        bounds.append(
            inserted(
                [
                    min(c + after[to] for _, c, used, to in _edits(initial, fault, s) if used)
                    for s in range(4)
                ]
            )
        )
    bounds.reverse()
    return bounds


def cheapest(initials: Sequence[str], faults: Sequence[int]) -> tuple[int, str]:
    """Cost and audit of the cheapest edits, the ASCII-least audit among them.

    Depth first with a stack of its own, least letter first, so prefixes come in the order of their
    audits. A greedy dive along the bounds gives the first incumbent. A prefix is dropped when its
    cost and bound can't beat the incumbent, or when the table of its node (row, state) holds an
    earlier prefix, whose audit is smaller, at no higher cost. Each node is taken up once more only
    for a lower cost, so the steps stay in proportion to the rows.
    """
    n = len(initials)
    bounds = suffix_bounds(initials, faults)

    def edits(row: int, state: int) -> list[tuple[str, int, int, int]]:
        return _edits(*((initials[row], faults[row]) if row < n else (None, NONE)), state)

    row, state, limit = 0, BEGUN, 0
    while row < n or state not in COMPLETE:
        _, cost, used, to = min(edits(row, state), key=lambda e: e[1] + bounds[row + e[2]][e[3]])
        row, state, limit = row + used, to, limit + cost
    limit += 1  # equal costs may still have a smaller audit than the dive's
    found = None
    least: dict[tuple[int, int], int] = {}
    trail: list[tuple[int, str]] = []
    stack = [(0, 0, BEGUN, -1, "")]
    while stack:
        cost, row, state, before, letter = stack.pop()
        if cost + bounds[row][state] >= limit or least.get((row, state), FAR) <= cost:
            continue
        least[row, state] = cost
        trail.append((before, letter))
        here = len(trail) - 1
        if row == n and state in COMPLETE:
            limit, found = cost, here
            continue
        for letter, more, used, to in reversed(edits(row, state)):
            stack.append((cost + more, row + used, to, here, letter))
    letters = []
    while found is not None and found >= 0:
        found, letter = trail[found]
        letters.append(letter)
    return limit, "".join(reversed(letters))


# ---- the stream ----

CODED = ("conv_id", "phase", "turn", "role", "text", "digest", "kind")
REPAIRED = (
    "place bigint, edit string, fault string, turn {turn}, was string, role string, text string"
)
#: Rows, and characters of text, of one batch of output.
BATCH_ROWS, BATCH_CHARS = 4_096, 4_000_000


def _rows(batches: Iterator[pa.RecordBatch], names: Sequence[str]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in names), strict=True)


class _Conversation:
    """What a task holds of the conversation it is reading."""

    def __init__(self, conv_id):
        self.conv_id, self.initials, self.faults = conv_id, [], bytearray()
        self.seen: set[bytes] = set()
        self.audit: str | None = None
        self.place, self.row, self.state = 0, 0, BEGUN

    def note(self, role: str, digest: bytes, kind: int) -> None:
        fault = kind if kind == BLANK else DUPLICATE if digest in self.seen else kind
        self.seen.add(digest)
        self.initials.append(role[:1])
        self.faults.append(fault)

    def inserts(self) -> Iterator[tuple]:
        """The turns to insert before the next row, or at the end."""
        if self.audit is None:
            self.audit = cheapest(self.initials, self.faults)[1]
            self.seen.clear()
        while self.audit[self.place : self.place + 1] == "I":
            self.state = PUT[self.state]
            yield (self.conv_id, self.place, "I", None, None, None, ROLE[self.state], "")
            self.place += 1

    def edit(self, turn, role: str, text: str) -> tuple:
        letter, fault = self.audit[self.place], FAULTS[self.faults[self.row]]
        after = (None, None)
        if letter == "K":
            self.state = KEEP[self.state, self.initials[self.row]]
            after = (role, text)
        elif letter == "R":
            self.state = PUT[self.state]
            after = (ROLE[self.state], text)
        found = (self.conv_id, self.place, letter, fault, turn, role, *after)
        self.place, self.row = self.place + 1, self.row + 1
        return found


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    current = None
    for conv_id, phase, turn, role, text, digest, kind in _rows(batches, CODED):
        if current is None or conv_id != current.conv_id:
            if current is not None:
                yield from current.inserts()
            current = _Conversation(conv_id)
        if phase == 0:
            current.note(role, digest, kind)
        else:
            yield from current.inserts()
            yield current.edit(turn, role, text)
    if current is not None:
        yield from current.inserts()


def repair(turns: DataFrame) -> DataFrame:
    """One row per edit of the conversations in ``turns`` (``conv_id``, ``turn``, ``role``, ``text``).

    ``place`` counts the edits of a conversation from 0; ``edit`` is K, R, D or I; ``fault`` is the
    first that holds of blank, duplicate and truncated, else null; ``turn`` and ``was`` are those of
    the row (null: inserted), ``role`` and ``text`` those after the repair (null: deleted). Every
    partition holds whole conversations, one after the other, in order of ``place``.

    A null role or text is one space, and a role with another initial than s, u and a (an empty one,
    too) can't be kept. Rows go by turn, nulls first; rows of equal turn by role and the digest of
    their text, so equal ones stand side by side and all but the first are duplicates. Rows of a null
    ``conv_id`` are one conversation. Texts are passed on whole, at any length. Other columns are
    left out; an empty table gives no rows.
    """
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    trimmed = F.rtrim(F.col("text"), F.lit(SPACES))
    kind = (
        F.when(trimmed == "", BLANK)
        .when(F.substring(trimmed, -1, 1).isin(*ENDS), NONE)
        .otherwise(TRUNCATED)
    )
    same = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    coded = (
        turns.select("conv_id", "turn", role.alias("role"), text.alias("text"))
        .withColumns({"digest": F.unhex(F.md5(same.cast("binary"))), "kind": kind})
        .select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("phase"))
        .withColumn("text", F.when(F.col("phase") == 1, F.col("text")))
    )
    ordered = (
        coded.select(*CODED)
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "phase", F.asc_nulls_first("turn"), "role", "digest")
    )
    kinds = {f.name: f.dataType.simpleString() for f in turns.select("conv_id", "turn").schema}
    schema = f"conv_id {kinds['conv_id']}, {REPAIRED.format(turn=kinds['turn'])}"
    return ordered.mapInArrow(_writer(_edited, ordered.sparkSession, schema), schema)


def _writer(rows, spark: SparkSession, schema: str):
    """``rows`` (batches to tuples) as a function of batches that puts the tuples in batches."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    fields = to_arrow_schema(StructType.fromDDL(schema))
    texts = [i for i, name in enumerate(fields.names) if name == "text"]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, chars = [], 0
        for row in rows(batches):
            held.append(row)
            chars += sum(len(row[i] or "") for i in texts)
            if len(held) >= BATCH_ROWS or chars >= BATCH_CHARS:
                yield _batch(held, fields)
                held, chars = [], 0
        if held:
            yield _batch(held, fields)

    return write


def _batch(rows: list[tuple], fields: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    arrays = [pa.array(c, type=f.type) for c, f in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=fields)


# ---- one row per conversation ----

SUMMED = ("conv_id", "edit", "fault", "turn", "was", "role", "text")
COSTS = {"K": 0, "R": REROLE_COST, "D": DELETE_COST, "I": INSERT_COST}
LEGAL = ("su", "ua", "au")


class _Summary:
    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.audit, self.cost, self.illegal = [], 0, 0
        self.faults = dict.fromkeys(FAULTS[1:], 0)
        self.first = self.last = None
        self.turns, self.before = 0, None
        self.digest, self.started = hashlib.sha256(), False

    def add(self, edit, fault, turn, was, role, text) -> None:
        self.audit.append(edit)
        self.cost += COSTS[edit]
        if edit != "I":
            if fault:
                self.faults[fault] += 1
                self.cost += TRUNCATED_COST * (fault == "truncated" and edit != "D")
            if self.before is not None:
                self.illegal += self.before + was[:1] not in LEGAL
            self.before = was[:1]
            if turn is not None and turn != self.last:  # turns come in order
                self.first = turn if self.first is None else self.first
                self.last, self.turns = turn, self.turns + 1
        if edit != "D":
            if self.started:
                self.digest.update(b"\n")
            self.started = True
            self.digest.update(f"{role}:{text}".encode())

    def row(self) -> tuple:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return (
            self.conv_id,
            gaps,
            *self.faults.values(),
            self.illegal,
            self.cost,
            "".join(self.audit),
            self.digest.hexdigest(),
        )


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    current = None
    for conv_id, *edit in _rows(batches, SUMMED):
        if current is None or conv_id != current.conv_id:
            if current is not None:
                yield current.row()
            current = _Summary(conv_id)
        current.add(*edit)
    if current is not None:
        yield current.row()


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def summarize(repaired: DataFrame) -> DataFrame:
    """One row per conversation of ``repair``'s own result, as it returns it: no rows moved between.

    Faults and illegal neighbours are those before the repair; ``repaired_sha256`` is the digest of
    the ``role:text`` lines after it. ``gaps`` is 0 for conversations without turn numbers.
    """
    kind = repaired.schema["conv_id"].dataType.simpleString()
    counts = ", ".join(f"{c} bigint" for c in COUNTS)
    schema = f"conv_id {kind}, {counts}, audit string, repaired_sha256 string"
    return repaired.mapInArrow(_writer(_summed, repaired.sparkSession, schema), schema)


def damage(turns: DataFrame) -> DataFrame:
    """``turns`` with rows dropped, emptied, cut, repeated or given the role user by a checksum."""
    space = F.lit(" ")
    ids = [F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")]
    fate = F.pmod(F.crc32(F.concat_ws(":", *ids).cast("binary")), F.lit(20))
    role, text = (F.coalesce(F.col(c), space) for c in ("role", "text"))
    return (
        turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), fate.alias("fate"))
        .select(
            "conv_id",
            "turn",
            F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(F.col("fate") == 1, "")
            .when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", ""))
            .otherwise(F.col("text"))
            .alias("text"),
            F.explode(
                F.array_repeat(F.lit(0), F.when(F.col("fate") == 0, 0).when(F.col("fate") == 3, 2).otherwise(1))
            ).alias("copy"),
        )
        .drop("copy")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation of ``conversations``, damaged and repaired."""
    turns = common.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    found = summarize(repair(damage(turns)))
    named = turns.select(F.col("conv_id").alias("own")).distinct()
    whole = named.join(found, F.col("own").eqNullSafe(F.col("conv_id")), "left")
    return whole.select(
        F.col("own").alias("conv_id"),
        *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in COUNTS),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def _best(*choices: str) -> str:
    return f"list_min([{', '.join(choices)}])"


def _value(cost: str, letters: str, lines: str, rest: str) -> str:
    """A suffix value: ``cost`` and ``letters`` in front of the value ``rest``."""
    return (
        f"{{'c': ({cost}) + {rest}.c, 'a': '{letters}' || {rest}.a, 'r': list_concat({lines}, {rest}.r)}}"
    )


def _row_values(state: int) -> str:
    """Best value of the rows from this one on, none inserted in front of it."""
    put = PUT[state]
    role = ROLE[put]
    choices = [_value("4", "D", "[]::VARCHAR[]", f"v{state}")]
    for (at, initial), to in KEEP.items():
        if at == state:
            kept = _value("extra", "K", "[role || ':' || text]", f"v{to}")
            choices.append(f"CASE WHEN usable AND initial = '{initial}' THEN {kept} END")
    given = _value("3 + extra", "R", f"['{role}:' || text]", f"v{put}")
    choices.append(f"CASE WHEN usable THEN {given} END")
    return _best(*choices)


def _inserted(state: int) -> str:
    once, twice = PUT[state], PUT[PUT[state]]
    first, second = ROLE[once], ROLE[twice]
    return _best(
        f"b{state}",
        _value("3", "I", f"['{first}:']", f"b{once}"),
        _value("6", "II", f"['{first}:', '{second}:']", f"b{twice}"),
    )


def _end(*roles: str) -> str:
    lines = ", ".join(f"'{r}:'" for r in roles)
    return f"{{'c': {3 * len(roles)}::BIGINT, 'a': '{'I' * len(roles)}', 'r': [{lines}]::VARCHAR[]}}"


SQL = f"""
WITH RECURSIVE crc AS (
    SELECT list_transform(range(256), lambda n: list_reduce(
        [n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k:
        CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t
),
fated AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        xor(4294967295, list_reduce(
            list_concat([4294967295], list_transform(
                range(1, length(key) + 1), lambda i: ascii(substr(key, i, 1))::BIGINT)),
            lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 20 AS fate
    FROM (SELECT *, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key
        FROM conversations), crc
),
damaged AS (
    SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
        CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END
            AS text,
        unnest(range(CASE fate WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
    FROM fated
),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i,
        rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS trimmed
    FROM damaged
),
judged AS MATERIALIZED (
    SELECT *, left(role, 1) AS initial,
        CASE WHEN trimmed = '' THEN 'blank'
            WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
            WHEN right(trimmed, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
        lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair
    FROM placed
),
counted AS (
    SELECT c.conv_id, count(i) AS n,
        coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (fault = 'blank') AS blank,
        count(*) FILTER (fault = 'duplicate') AS duplicate,
        count(*) FILTER (fault = 'truncated') AS truncated,
        count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM (SELECT DISTINCT conv_id FROM conversations) c
    LEFT JOIN judged j ON j.conv_id IS NOT DISTINCT FROM c.conv_id
    GROUP BY c.conv_id
),
walk AS (
    SELECT conv_id, n + 1 AS i, {_end()} AS v0, {_end('user', 'assistant')} AS v1,
        {_end('assistant')} AS v2, {_end()} AS v3
    FROM counted
    UNION ALL
    SELECT conv_id, i, {', '.join(_inserted(s) for s in range(4))}
    FROM (
        SELECT conv_id, i, {', '.join(f'{_row_values(s)} AS b{s}' for s in range(4))}
        FROM (
            SELECT w.conv_id, j.i, v0, v1, v2, v3, role, text, initial,
                coalesce(fault NOT IN ('blank', 'duplicate'), true) AS usable,
                CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS extra
            FROM walk w JOIN judged j
                ON j.conv_id IS NOT DISTINCT FROM w.conv_id AND j.i = w.i - 1))
)
SELECT conv_id, gaps::BIGINT AS gaps, blank, duplicate, truncated, illegal, v0.c AS cost, v0.a AS audit,
    sha256(array_to_string(v0.r, chr(10))) AS repaired_sha256
FROM walk JOIN counted c USING (conv_id) WHERE walk.i = 1
"""
