"""The operators for training text against brute force, exact round trips and known answers."""

import hashlib
import random
import sys
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from acctweave.llm import (
    byte_bpe,
    chat_format,
    fingerprint,
    html_text,
    near_dedup,
    packing,
    substring_dedup,
    vector_dedup,
)

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
from conftest import SF_DIR  # noqa: E402

DOCS = "doc_id bigint, text string, source string, key string, tag string"


def words(rng, n):
    return " ".join(f"w{rng.randrange(5000)}" for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    """Copies, near copies, a shared passage, nulls, empty and repeated texts, clashing columns."""
    rng = random.Random(1)
    shared, base = words(rng, 70), words(rng, 120)
    texts = [words(rng, 90) for _ in range(12)]
    texts += [base, base, base.rsplit(" ", 2)[0] + " changed end", None, "", " \n ", "one two"]
    texts += [f"{words(rng, 40)} {shared} {words(rng, 30)}" for _ in range(3)]
    rows = [(i, t, (None, "a", "b")[i % 3], "k", "t") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS), {i: t or "" for i, t in enumerate(texts)}


def test_repeated_windows_are_removed_as_by_brute_force(docs):
    df, texts = docs
    first = {}
    for i, t in texts.items():
        w = t.split()
        for k in range(len(w) - 49):
            first.setdefault(tuple(w[k : k + 50]), i)
    want = {}
    for i, t in texts.items():
        w = t.split()
        gone = set()
        for k in range(len(w) - 49):
            if first[tuple(w[k : k + 50])] < i:
                gone.update(range(k, k + 50))
        want[i] = " ".join(x for k, x in enumerate(w) if k not in gone)
    got = {r.doc_id: (r.text or "").split() for r in substring_dedup.remove_repeats(df).collect()}
    assert got == {i: t.split() for i, t in want.items()}


def test_near_copies_share_a_class_as_by_brute_force(docs):
    df, texts = docs

    def bag(t):
        w = t.split()
        return Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))

    bags = {i: bag(t) for i, t in texts.items()}
    keep = set(texts)
    for i in texts:
        for j in texts:
            both = sum((bags[i] | bags[j]).values())
            if j < i and both and sum((bags[i] & bags[j]).values()) / both >= 0.8:
                keep.discard(i)
    got = {r.doc_id for r in near_dedup.keep_one(df).collect()}
    long = {i for i, t in texts.items() if len(t.split()) >= 5}
    assert got & long == keep & long
    assert near_dedup.keep_one(df).columns == df.columns


def test_vectors_link_as_by_brute_force(spark):
    rng = random.Random(2)
    base = [[rng.gauss(0, 1) for _ in range(16)] for _ in range(8)]
    rows = []
    for i in range(60):
        v = [x + rng.gauss(0, 0.1) for x in base[i % 8]]
        rows.append((i, v, i % 8 // 4))
    rows += [(60, None, 0), (61, [0.0] * 16, 0), (62, [float("nan")] * 16, 0), (63, base[0], None)]
    rows += [(64, rows[0][1], 0)]

    def cosine(a, b):
        dot, p, q = (sum(x * y for x, y in zip(m, n)) for m, n in ((a, b), (a, a), (b, b)))
        return dot / (p * q) ** 0.5

    fine = [r for r in rows if r[1] and r[2] is not None and any(r[1]) and r[1][0] == r[1][0]]
    want = Counter(
        a[0]
        for a in fine
        for b in fine
        if a[0] != b[0] and a[2] == b[2] and cosine(a[1], b[1]) >= 0.98
    )
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    got = {r.vec_id: r.n_links for r in vector_dedup.link_vectors(df).collect()}
    assert got == {r[0]: want[r[0]] for r in rows}


def test_ids_are_those_of_the_library_and_decode_to_the_text(spark):
    from tiktoken.load import load_tiktoken_bpe  # noqa: F401  (the library must be there)

    texts = ["", None, " ", "a  b\n\n c", "naïve — 文字 🙂", "x" * 3000, "it's 12345 don't"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    ids = byte_bpe.encode(F.col("text"))
    got = df.withColumn("ids", ids).withColumn("back", byte_bpe.decode(F.col("ids"))).collect()
    for r in got:
        assert bytes(r.back).decode() == (r.text or "")

    import base64

    import tiktoken

    with open(byte_bpe.RANKS, "rb") as lines:
        ranks = {base64.b64decode(t): int(k) for t, k in map(bytes.split, filter(bytes.strip, lines))}
    pattern = byte_bpe.public_tokenizers.PATTERN
    library = tiktoken.Encoding("t", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    for r in got:
        assert list(r.ids) == library.encode_ordinary(r.text or "")


def test_packing_is_gapless_and_keeps_every_id(docs):
    df, texts = docs
    pieces = packing.digest(packing.pack(df)).collect()
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append((p.start, p.length, p.doc_tokens))
        by_sequence.setdefault(p.sequence_id, []).append((p.offset, p.length))
    assert set(by_doc) == set(texts)
    for found in by_doc.values():
        at = 0
        for start, length, _ in sorted(found):
            assert start == at
            at += length
        assert at == found[0][2]
    for found in by_sequence.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= packing.LENGTH


def test_chats_read_back_with_marks_inside_texts(spark):
    turns = [
        (1, 0, "user", "\\### Assistant: </turn> ok"),
        (1, 1, "assistant", "\\### Assistant: </turn> ok"),
        (2, 0, "user", None),
        (2, 1, "assistant", "a\nb"),
    ]
    df = spark.createDataFrame(turns, "conv_id int, turn int, role string, text string")
    out = chat_format.format_chats(df).select(
        "conv_id",
        "valid",
        chat_format.read_turns(F.col("formatted")).alias("turns"),
        chat_format.learned_text(F.col("segments")).alias("learned"),
    )
    got = {r.conv_id: r for r in out.collect()}
    for conv in (1, 2):
        want = [(t[2], t[3] or "") for t in turns if t[0] == conv]
        assert [tuple(t) for t in got[conv].turns] == want
        assert got[conv].learned == want[1][1]


def test_fingerprints_of_equal_texts_are_equal(spark):
    rng = random.Random(3)
    text = words(rng, 200)
    rows = [(0, text), (1, text), (2, words(rng, 200)), (3, ""), (4, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = fingerprint.fingerprint(df, "text", "p").select(
        "doc_id", fingerprint.as_text(F.col("p")).alias("p")
    )
    got = {r.doc_id: r.p for r in out.collect()}
    assert got[0] == got[1] != got[2] and len({got[3] or "", got[4] or ""}) == 1


def test_main_text_leaves_menus_and_comments_out():
    body = "A long sentence, with commas, and words that go on and on, to make it the article. " * 3
    html = (
        "<html><head><title>t</title><style>x{}</style></head><body><nav><a href=/>Home</a></nav>"
        f"<article><h1>Head</h1><p>{body}</p><p>Fish &amp; chips,  \n and so on.</p></article>"
        "<div class=comments><p>First!</p></div><footer>Imprint</footer></body></html>"
    )
    assert html_text.main_text(html) == f"Head\n{body.strip()}\nFish & chips, and so on."
    assert html_text.main_text(None) == html_text.main_text("") == ""


@pytest.mark.parametrize("operator", [near_dedup.keep_one, substring_dedup.remove_repeats])
def test_empty_tables_stay_empty(spark, operator):
    assert operator(spark.createDataFrame([], DOCS)).count() == 0


def test_kept_digest_of_the_query_is_that_of_the_text(spark):
    row = substring_dedup.query(spark, SF_DIR).where("n_removed = 0 and n_words > 0").first()
    text = spark.read.parquet(f"{SF_DIR}/documents.parquet").where(F.col("doc_id") == row.doc_id)
    kept = " ".join(text.first().text.split())
    assert row.kept_sha256 == hashlib.sha256(kept.encode()).hexdigest()
