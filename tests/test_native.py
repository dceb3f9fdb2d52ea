import random
from collections import defaultdict

import pytest
from conftest import rows
from pyspark.sql import functions as F

from acctweave import layouts
from acctweave import operators as op
from acctweave.functions import edits_up_to
from acctweave.operators import native

ACCOUNT = (
    "BU_REC_ID string, STD_ORG_NAME string, STD_ORG_ADDRESS_LINE_1 string, "
    "STD_ORG_ZIP_CODE string, STD_ORG_AREACD string, STD_ORG_PHONE_NUMBER string"
)
MASTER = (
    "ORG_ID string, MEMBER_ID string, name string, line1 string, zip5 string, areacode string, "
    "phone string"
)


def distance(a, b):
    ahead = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        here = [i]
        for j, y in enumerate(b, 1):
            here.append(min(ahead[j] + 1, here[-1] + 1, ahead[j - 1] + (x != y)))
        ahead = here
    return ahead[-1]


def similarity(a, b):
    longer = max(len(a), len(b))
    return 1 - distance(a, b) / longer if longer else 0.0


def keys(name, zip5, areacode, phone):
    found = set()
    if name.split() and zip5:
        found.add(("word", name.split()[0], zip5))
    if areacode and phone:
        found.add(("phone", areacode, phone))
    if name.replace(" ", ""):
        found.add(("name", name.replace(" ", "")))
    return found


def brute_force(accounts, master, min_score=0.0):
    out = []
    for rec, name, line1, zip5, areacode, phone in accounts:
        name, line1 = (name or "").upper(), (line1 or "").upper()
        own = keys(name, zip5 or "", areacode or "", phone or "")
        scores = defaultdict(list)
        for org, _, m_name, m_line1, *rest in master:
            if own & keys(m_name.upper(), *rest):
                score = 0.6 * similarity(name, m_name.upper()) + 0.4 * similarity(line1, m_line1.upper())
                scores[org].append(score)
        means = {org: sum(s) / len(s) for org, s in scores.items()}
        kept = {org: m for org, m in means.items() if m >= min_score}
        out += [(rec, org, round(m, 9)) for org, m in kept.items()] or [(rec, None, None)]
    return sorted(out, key=repr)


def random_feed(seed, n, hot):
    """Accounts and members over a small vocabulary; a share ``hot`` has one name, ZIP and phone."""
    rng = random.Random(seed)

    def fields():
        if rng.random() < hot:
            return "Acme Nut", f"{rng.randrange(9)} A St", "07030", "201", "2010000000"
        name = rng.choice(["Acme Nut", "Acme  Nuts", "ACMENUT", "Bolt", "Bolt & Co", "", "Rivet"])
        phone = rng.choice(["2015550101", "2015550102", "3125550103", ""])
        return (
            name,
            rng.choice(["1 A St", "1 A Street", "22 B Rd", ""]),
            rng.choice(["07030", "10001", ""]),
            phone[:3],
            phone,
        )

    accounts = [(f"r{i}", *fields()) for i in range(n)]
    accounts.append(("nulls", None, None, None, None, None))
    master = [(f"C{rng.randrange(n // 4)}", f"m{i}", *fields()) for i in range(n)]
    return accounts, master


def matched(spark, accounts, master, **options):
    df = op.match_accounts(
        spark.createDataFrame(accounts, ACCOUNT), spark.createDataFrame(master, MASTER), **options
    )
    return sorted(
        (
            (r.BU_REC_ID, r.ORG_ID, None if r.ORG_ID is None else round(r.ORG_MATCH_CONFIDENCE, 9))
            for r in df.collect()
        ),
        key=repr,
    )


@pytest.mark.parametrize(("seed", "min_score"), [(1, 0.0), (2, 0.45), (2, 0.7), (5, 0.9), (6, 1.0)])
def test_matching_equals_brute_force(spark, seed, min_score):
    accounts, master = random_feed(seed, 60, hot=0.3)
    assert matched(spark, accounts, master, min_score=min_score) == brute_force(
        accounts, master, min_score
    )


def test_matching_with_split_blocks_equals_brute_force(spark, monkeypatch):
    accounts, master = random_feed(3, 80, hot=0.5)
    plain = native.skew_join

    def eager(*args, **options):
        return plain(*args, **options, cell_pairs=20, cell_rows=15)

    monkeypatch.setattr(native, "skew_join", eager)
    expected = brute_force(accounts, master)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions in ("3", "8"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            assert matched(spark, accounts, master) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_a_cluster_of_good_members_carries_a_poor_one(spark):
    """The poor member alone is far below the score; the average over all is above it."""
    accounts = [("r", "ACME NUT WORKS", "1 A ST", "07030", "201", "5550101")]
    good = ("Acme Nut Works", "1 A St", "07030", "201", "5550101")
    master = [("C", f"m{i}", *(v + " " * (i == 9) for v in good)) for i in range(10)]
    master += [("C", "poor", "Acme", "999 Other Road", "07030", "201", "5550101")]
    master += [("D", "poor", "Acme", "999 Other Road", "07030", "201", "5550101")]
    found = matched(spark, accounts, master, min_score=0.9)
    assert found == brute_force(accounts, master, 0.9) and [f[1] for f in found] == ["C"]


def test_lengths_are_compared_first(spark):
    pairs = spark.createDataFrame([("ab", "abcdefgh"), ("abcd", "abce")], "a string, b string")
    found = pairs.select(edits_up_to(F.col("a"), F.col("b"), 0.75).alias("e")).collect()
    assert [r.e for r in found] == [-6, 1]  # the first by its length alone


@pytest.mark.parametrize("least", [0.0, 0.3, 0.8, 1.0])
def test_bounded_edits_are_exact_or_bounds(spark, least):
    rng = random.Random(9)
    texts = ["".join(rng.choice("abc") for _ in range(rng.randrange(9))) for _ in range(120)]
    pairs = list(zip(texts, texts[1:], strict=False))
    df = spark.createDataFrame(pairs, "a string, b string")
    found = df.select("a", "b", edits_up_to(F.col("a"), F.col("b"), least).alias("e")).collect()
    for r in found:
        true = distance(r.a, r.b)
        reaches = true <= max(len(r.a), len(r.b)) * (1 - least) + 1e-9
        assert (r.e == true) if reaches else (r.e < 0 and -r.e <= true)


def test_copies_are_compared_once_and_all_come_back(spark):
    account = ("Acme", "1 A ST", "07030", "201", "2015550101")
    accounts = [(f"r{i}", *account) for i in range(50)]
    master = [("C1", f"m{i}", *account) for i in range(50)] + [
        ("C2", "m", "Other", "9 Z ST", "07030", "201", "2015550101")
    ]
    got = matched(spark, accounts, master)
    assert len(got) == 100 and {r[1] for r in got} == {"C1", "C2"}
    assert {r[2] for r in got if r[1] == "C1"} == {1.0}
    sides = spark.createDataFrame(accounts, ACCOUNT), spark.createDataFrame(master, MASTER)
    members = native._member_keys(sides[1])
    assert members.count() == 6  # equal members once under each of three keys


def test_every_member_counts_not_the_most_frequent_one(spark):
    account = ("Acme", "1 A ST", "07030", "201", "2015550101")
    master = [("C1", "m0", *account)] + [
        ("C1", f"m{i}", "Zzzz", "9 Q RD", "99999", "201", "2015550101") for i in (1, 2)
    ]
    got = matched(spark, [("r", *account)], master)
    assert got == brute_force([("r", *account)], master)
    assert got[0][2] < 0.5


def test_matching_plan_has_no_nested_loops(spark):
    accounts, master = random_feed(4, 20, hot=0.3)
    df = op.match_accounts(
        spark.createDataFrame(accounts, ACCOUNT), spark.createDataFrame(master, MASTER)
    )
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_native_standardization(spark):
    columns = ["ORG_NAME", "ORG_ADDRESS_LINE_1", "ORG_ZIP_CODE", "ORG_PHONE_NUMBER"]
    accounts = spark.createDataFrame(
        [
            (" acme   nut ", "1 main street.", "07030 ", "(201) 555-0123"),
            ("b", "1  MAIN  ST", "07030", "555"),
            ("c", "1 main st", "99999", None),
            (None, "", "07030", ""),
            ("d", None, None, None),
        ],
        ", ".join(f"{c} string" for c in columns),
    )
    fields = dict.fromkeys(layouts.ADDRESS_FIELDS) | {
        "ADDR1": "1 Main St", "ZIP": "07030", "CITY": "HOBOKEN"
    }
    ref = spark.createDataFrame(
        [tuple(fields.values())] * 3, ", ".join(f"{f} string" for f in fields)
    )
    out = op.standardize_accounts(accounts, ref)
    std = ("NAME", "ADDR1", "CITY", "STATE", "PHONE", "AREACD")
    assert rows(out.select(*(f"STD_ORG_{f}" for f in std))) == sorted(
        [
            ("ACME NUT", "1 Main St", "HOBOKEN", "", "2015550123", "201"),
            ("B", "1 Main St", "HOBOKEN", "", "555", ""),
            ("C", "", "", "", "", ""),
            ("", "", "", "", "", ""),
            ("D", "", "", "", "", ""),
        ],
        key=repr,
    )
    assert len(out.columns) == 4 + 29


def test_the_bound_stands_in_the_plan(spark, monkeypatch):
    """With a minimum score, the pairs of the join meet the bounded edit distance and no other."""
    accounts, master = random_feed(8, 30, hot=0.3)
    plans = []
    plain = native.hand_off

    def noted(df, name):
        plans.append((name, df._jdf.queryExecution().optimizedPlan().toString()))
        return plain(df, name)

    monkeypatch.setattr(native, "hand_off", noted)
    matched(spark, accounts, master, min_score=0.9)
    (reached,) = [text for name, text in plans if name == "reached"]
    assert "levenshtein(name" in reached and "abs((length(name" in reached
    bounded = reached.split("levenshtein(")[1:]
    assert all("FLOOR" in x.split("AS ")[0] for x in bounded)
