"""Repeated and missing ids, hostile pages, held-out accuracy and planted links."""

import random
import time
import zlib

import numpy as np
import pytest
from conftest import SF_DIR

from acctweave.llm import html_text, language_id, near_dedup, toxicity, vector_dedup

SMALL = SF_DIR.replace("0.001", "0.01")


def words(rng, n):
    return " ".join(f"w{rng.randrange(5000)}" for _ in range(n))


def test_unlike_texts_that_share_or_lack_an_id_all_stay(spark):
    rng = random.Random(2)
    texts = [words(rng, 80) for _ in range(5)]
    rows = [(5, texts[0]), (5, texts[1]), (6, texts[2]), (None, texts[3]), (None, texts[4])]
    near = texts[4] + " more"
    rows += [(None, texts[4]), (9, near), (None, None), (None, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = sorted(((r.doc_id, r.text) for r in near_dedup.keep_one(df).collect()), key=repr)
    want = [*rows[:4], (9, near), (None, None), (None, "")]
    assert kept == sorted(want, key=repr)


def test_classes_equal_brute_force_over_chains_and_large_groups(spark):
    """Copies with a few words changed, so that links form chains, and one large group."""
    rng = random.Random(5)
    texts = []
    for _ in range(6):
        base = words(rng, 120).split()
        for _ in range(8):
            texts.append(" ".join(base))
            base[rng.randrange(120)] = "changed"
    large = words(rng, 150).split()
    for i in range(60):
        own = list(large)
        own[i * 2] = f"own{i}"
        texts.append(" ".join(own))
    bags = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (t.split() for t in texts)]
    up = list(range(len(texts)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if len(bags[i] & bags[j]) >= 0.8 * len(bags[i] | bags[j]):
                a, b = sorted((top(i), top(j)))
                up[b] = a
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.key: r.class_key for r in near_dedup.classes(df).collect()}
    assert got == {i: top(i) for i in range(len(texts))}


@pytest.mark.parametrize("size", [near_dedup.SLICE, 4_000])
def test_near_copies_below_the_limit_make_no_table_of_their_pairs(spark, monkeypatch, size):
    """160 copies that nearly all meet, of which few pairs are alike; also with buckets in slices."""
    rng = random.Random(9)
    large = words(rng, 150).split()
    texts = []
    for i in range(160):
        own = list(large)
        for k in rng.sample(range(150), 2):
            own[k] = f"own{i}"
        texts.append(" ".join(own))
    bags = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (t.split() for t in texts)]
    least = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if least[i] != least[j] and len(bags[i] & bags[j]) >= 0.8 * len(bags[i] | bags[j]):
                a, b = sorted((least[i], least[j]))
                least = [a if x == b else x for x in least]
    written, hand_off = [], near_dedup.hand_off

    def counted(df, name):
        out = hand_off(df, name)
        written.append((out.count(), name))
        return out

    monkeypatch.setattr(near_dedup, "hand_off", counted)
    monkeypatch.setattr(near_dedup, "SLICE", size)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.key: r.class_key for r in near_dedup.classes(df).collect()}
    assert got == dict(enumerate(least))
    assert sum(n for n, name in written if name == "agreeing") <= len(texts)  # pairs handed on, over all rounds
    if size > 4_000:  # slices are copied
        assert max(written)[0] <= near_dedup.BANDS * len(texts), max(written)


HOSTILE = {
    "quotes": "<b " + '"x' * 100_000,
    "tags": "<a " * 100_000,
    "scripts": "<script " * 50_000,
    "nested": "<div>" * 20_000 + "deep, but text " * 9 + "</div>" * 20_000,
    "apostrophes": "<b '" * 50_000,
}
ARTICLE = "<article><p>A paragraph, long enough to be a part of the article.</p></article>"


@pytest.mark.parametrize("name", HOSTILE)
def test_hostile_pages_take_their_length(name):
    start = time.perf_counter()
    html_text.main_text(ARTICLE + HOSTILE[name])
    assert time.perf_counter() - start < 5


def test_a_paragraph_stays_whatever_it_is_called():
    page = ARTICLE.replace("</article>", '<p class="top">Another one, called the top of it, stays.</p></article>')
    assert "called the top" in html_text.main_text(page)


def held_out(spark, name, predicted):
    table = spark.read.parquet(f"{SMALL}/{name}.parquet")
    return predicted.where("held_out").join(table, "doc_id").toPandas()


def test_toxicity_of_held_out_documents(spark):
    found = held_out(spark, "labels", toxicity.query(spark, SMALL)).dropna(subset=["toxic"])
    toxic, flagged = found.toxic == 1, found.predicted == 1
    assert (flagged & toxic).sum() >= 0.8 * toxic.sum()
    assert (~flagged & ~toxic).sum() >= 0.97 * (~toxic).sum()


def test_few_labels_flag_few_documents(spark):
    found = toxicity.query(spark, SF_DIR).toPandas()
    assert found.predicted.sum() < 0.15 * len(found)


def test_toxicity_without_evidence_flags_nothing():
    rng = random.Random(1)
    texts = [words(rng, 30) for _ in range(60)]
    model = toxicity.fit(texts, [i % 9 == 0 for i in range(60)])
    scored = [toxicity._score(toxicity.features(toxicity.pa.array([t])), model, 1)[0] for t in texts]
    assert sum(s >= model.cut for s in scored) <= 10
    assert toxicity.fit(texts, [0] * 60).cut == 0.0 and toxicity.fit([], []).bias == -8.0


def test_languages_of_held_out_documents(spark):
    found = held_out(spark, "documents", language_id.query(spark, SMALL)).dropna(subset=["lang"])
    assert (found.lang == found.lang_pred).mean() >= 0.98
    assert all(zlib.crc32(str(i).encode()) % 3 == 1 for i in found.doc_id)


def test_planted_links_are_found_also_where_ids_repeat(spark):
    rng, rows = np.random.default_rng(0), []
    for k in range(150):
        b = rng.normal(size=64)
        b /= np.linalg.norm(b)
        e = rng.normal(size=64)
        e -= (e @ b) * b
        c = 0.9801 + 0.002 * rng.random()
        near = c * b + np.sqrt(1 - c * c) * e / np.linalg.norm(e)
        rows += [(2 * k, b.tolist(), k % 3), (2 * k + 1, near.tolist(), k % 3)]
    rows += [(0, rng.normal(size=64).tolist(), 0), (1, None, 1), (7, [0.0] * 64, 1)]
    x = np.array([r[1] or [0.0] * 64 for r in rows])
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
    label = np.array([r[2] for r in rows])
    linked = (x @ x.T >= 0.98) & (label[:, None] == label)
    np.fill_diagonal(linked, False)
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    found = sorted((r.vec_id, r.n_links) for r in vector_dedup.link_vectors(df).collect())
    want = sorted(zip((r[0] for r in rows), linked.sum(axis=1).tolist(), strict=True))
    assert found == want
