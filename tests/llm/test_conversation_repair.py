"""Conversation repair: the search against exhaustive edits, and the stream on awkward tables."""

import hashlib
import random

from acctweave.llm import conversation_repair as cr

TURNS = "conv_id bigint, turn bigint, role string, text string, place string, audit int"


def exhaustive(initials, faults):
    """Least (cost, audit) over all edits with at most two inserts in a row."""
    n, best = len(initials), [(10**9, "")]

    def go(row, state, cost, audit, run):
        if cost > best[0][0]:
            return
        if row == n and state in cr.COMPLETE:
            best[0] = min(best[0], (cost, audit))
        put = cr.PUT[state]
        if run < 2:
            go(row, put, cost + 3, audit + "I", run + 1)
        if row == n:
            return
        go(row + 1, state, cost + 4, audit + "D", 0)
        if faults[row] in (cr.BLANK, cr.DUPLICATE):
            return
        more = 3 * (faults[row] == cr.TRUNCATED)
        go(row + 1, put, cost + 3 + more, audit + "R", 0)
        if (state, initials[row]) in cr.KEEP:
            go(row + 1, cr.KEEP[state, initials[row]], cost + more, audit + "K", 0)

    go(0, cr.BEGUN, 0, "", 0)
    return best[0]


def test_search_finds_the_cheapest_and_least_audit():
    rng = random.Random(3)
    for _ in range(400):
        n = rng.randrange(6)
        initials = [rng.choice(["u", "a", "s", "x", ""]) for _ in range(n)]
        faults = [rng.choice([0, 0, 0, 1, 2, 3]) for _ in range(n)]
        assert cr.cheapest(initials, faults) == exhaustive(initials, faults)


def test_search_is_linear_in_long_conversations():
    rng = random.Random(4)
    initials = [rng.choice("uasx") for _ in range(30_000)]
    cost, audit = cr.cheapest(initials, [rng.randrange(4) for _ in initials])
    assert len(audit) - audit.count("I") == len(initials) and cost > 0


def test_repair_of_awkward_conversations(spark):
    long = "long " * 50_000 + "end."
    rows = [
        (1, 0, "user", "Hi.", "p", 1),
        (1, 1, "assistant", long, "p", 1),
        (2, None, "user", "a.", "p", 1),  # null turns come first
        (2, 5, "assistant", "b", "p", 1),  # truncated
        (2, 5, "assistant", "b", "p", 1),  # a repeated row
        (3, 0, None, None, "p", 1),  # one space each: blank
        (None, 1, "system", "s.", "p", 1),
        (None, 3, "user", "u.", "p", 1),
        (4, 0, "", "no role.", "p", 1),
    ]
    df = spark.createDataFrame(rows, TURNS)
    repaired = cr.repair(df)
    found = {r.conv_id: r for r in cr.summarize(cr.repair(df)).collect()}
    assert set(found) == {1, 2, 3, 4, None}
    assert (found[1].cost, found[1].audit) == (0, "KK")
    want = hashlib.sha256(f"user:Hi.\nassistant:{long}".encode()).hexdigest()
    assert found[1].repaired_sha256 == want
    assert (found[2].duplicate, found[2].truncated, found[2].cost, found[2].audit) == (1, 1, 7, "KDK"[:1] + "KD")
    assert (found[3].blank, found[3].cost, found[3].audit) == (1, 4, "D")
    assert (found[None].gaps, found[None].illegal, found[None].audit) == (1, 0, "KKI")
    assert (found[4].illegal, found[4].cost, found[4].audit) == (0, 4, "D")
    texts = {(r.conv_id, r.place): (r.edit, r.role) for r in repaired.collect()}
    assert texts[None, 2] == ("I", "assistant")


def test_no_rows(spark):
    empty = spark.createDataFrame([], TURNS)
    assert cr.summarize(cr.repair(empty)).count() == 0
    assert cr.repair(cr.damage(empty)).count() == 0


def test_damage_follows_the_checksum(spark):
    import zlib

    rows = [(c, t, "assistant", "One. Two!", "p", 1) for c in range(40) for t in range(3)]
    found = {}
    for r in cr.damage(spark.createDataFrame(rows, TURNS)).collect():
        found.setdefault((r.conv_id, r.turn), []).append((r.role, r.text))
    for c, t, role, text, *_ in rows:
        fate = zlib.crc32(f"{c}:{t}".encode()) % 20
        want = {
            0: None,
            1: [(role, "")],
            2: [(role, "One Two")],
            3: [(role, text)] * 2,
            4: [("user", text)],
        }.get(fate, [(role, text)])
        assert found.get((c, t)) == want
