"""Toxicity by multiple-instance learning: only documents have labels, sentences get scores.

A sentence's logit is a bias plus the weights of its words and of the words' first bytes (hashed
to ``BUCKETS``). A document's probability is the noisy-or of its sentences, 1 - prod(1 - p), so
one offending sentence suffices and many harmless ones are needed to be harmless. Trained by
stochastic gradient descent in numpy on a bounded sample of labelled documents; afterwards the
sentence scores show where a document offends (``locate``).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acctweave.llm import common, rolling
from acctweave.operators.handoff import hand_off

BITS = 18
BUCKETS = 1 << BITS
PREFIXES = (3, 4, 5)  # bytes of a word's beginning that are features too
MIN_DOCS = 2  # a feature of fewer documents of the sample gets no weight,
MIN_Z = 2.0  # nor one whose share of toxic documents lies within so many standard deviations
FOLDS = 3  # each labelled text gets a log-odds from a model that has not seen it
SAMPLE = 1_500  # documents to learn from for each label,
SAMPLE_BYTES = 6_000_000  # and bytes of their texts: the bound of what the driver gets
DECIDE = 0.7  # score from which a document counts as toxic

_WORD = np.full(256, 0, np.uint8)  # lower-cased bytes of words, 0 for all others
_WORD[128:] = np.arange(128, 256)
for _b in [*range(48, 58), *range(97, 123)]:
    _WORD[_b] = _b
for _b in range(65, 91):
    _WORD[_b] = _b + 32
_STOP = np.zeros(256, bool)  # . ! ? and line ends close a sentence
_STOP[[10, 13, 33, 46, 63]] = True


@dataclass(frozen=True)
class ToxicityModel:
    weights: np.ndarray
    bias: float
    cut: float  # the raw log-odds that become DECIDE


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Buckets (word x feature), each word's sentence, each sentence's text and first byte.

    Sentences without words don't appear. Bytes count from the beginning of the text.
    """
    data, offsets = rolling.flat(texts)
    low = _WORD[data]
    starts, ends, text = rolling.runs(low != 0, offsets)
    size = ends - starts
    buckets = np.empty((len(starts), 1 + len(PREFIXES)), np.int64)
    shift = np.uint64(64 - BITS)
    whole = rolling.run_hashes(low, starts, ends) ^ size.astype(np.uint64)
    buckets[:, 0] = rolling.mix(whole) >> shift
    for k, n in enumerate(PREFIXES, 1):
        part = rolling.run_hashes(low, starts, np.minimum(ends, starts + n))
        part = rolling.mix(part ^ np.uint64(1_000 + n)) >> shift
        buckets[:, k] = np.where(size > n, part.astype(np.int64), buckets[:, 0])
    part_of = np.cumsum(_STOP[data])[starts] + text if len(data) else starts
    new = np.ones(len(starts), bool)
    new[1:] = part_of[1:] != part_of[:-1]
    first = np.flatnonzero(new)
    return buckets, np.cumsum(new) - 1, text[first], starts[first] - offsets[text[first]]


def _logits(buckets, sentence, n_sentences, weights, bias):
    return bias + np.bincount(sentence, weights[buckets].sum(axis=1), n_sentences)


def _document_logit(z: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """Log-odds of the noisy-or: log(exp(s) - 1) for s = sum of softplus(z); without any -30."""
    s = np.bincount(text, np.logaddexp(0, z), n)
    s = np.maximum(s, 1e-13)
    return np.where(s > 30, s, np.log(np.expm1(np.minimum(s, 30))))


def fit(texts: list[str], toxic: list[int], epochs: int = 8, seed: int = 3) -> ToxicityModel:
    """Train on texts and their labels; the cut is placed by log-odds from cross-fitting.

    Each text gets its log-odds from a model fitted to the other folds, so that no text's own label
    speaks for it and all labels count, however few there are. The model itself is fitted to all.
    """
    y = np.array(toxic, float)
    if not len(y) or y.min() == y.max():  # one kind only: no evidence for either decision
        return ToxicityModel(np.zeros(BUCKETS, np.float32), -8.0, 0.0)
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    held = []
    for t in texts:
        buckets, sentence, text, _ = features(pa.array([t], pa.string()))
        held.append((buckets.astype(np.int32), sentence.astype(np.int32), text, None))
    d = np.zeros(len(y))
    for fold in range(FOLDS):
        aside = order[fold::FOLDS]
        model = _learn(held, y, np.setdiff1d(order, aside), epochs, rng)
        d[aside] = [_score(held[i], model, 1)[0] for i in aside]
    model = _learn(held, y, order, epochs, rng)
    return ToxicityModel(model.weights, model.bias, _cut(d, y))


def _learn(held: list, y: np.ndarray, learn: np.ndarray, epochs: int, rng) -> ToxicityModel:
    """Stochastic gradient descent over the texts ``learn``; features without evidence stay at 0."""
    learn = learn.copy()
    seen = np.zeros((2, BUCKETS))
    for i in learn:
        seen[int(y[i]), np.unique(held[i][0])] += 1
    share, docs = y[learn].mean() if len(learn) else 0.0, seen.sum(axis=0)
    odd = seen[1] - docs * share
    sd = np.sqrt(docs * max(share * (1 - share), 1e-9))
    usable = (docs >= MIN_DOCS) & (np.abs(odd) >= MIN_Z * np.maximum(sd, 1e-9))
    weights, bias = np.zeros(BUCKETS), -6.0
    past = np.full(BUCKETS, 1e-2)  # sums of squared gradients: steps shrink feature by feature
    for epoch in range(epochs):
        rng.shuffle(learn)
        for k in range(0, len(learn), 16):
            rows = learn[k : k + 16]
            index, push = [], []
            for i in rows:
                buckets, sentence, text, _ = held[i]
                if not len(text):
                    continue
                z = _logits(buckets, sentence, len(text), weights, bias)
                d = _document_logit(z, text, 1)[0]
                g = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
                if y[i]:
                    g = -g * np.exp(-np.logaddexp(0, d)) / max(1e-12, 1 - np.exp(-np.logaddexp(0, d)))
                bias -= 0.02 / (1 + epoch) * np.clip(g.sum(), -1, 1)
                index.append(buckets.ravel())
                push.append(np.repeat(np.clip(g, -1, 1)[sentence], buckets.shape[1]))
            if index:
                at, inverse = np.unique(np.concatenate(index), return_inverse=True)
                g = np.bincount(inverse, np.concatenate(push)) + 1e-4 * weights[at]
                g[~usable[at]] = 0
                past[at] += g * g
                weights[at] -= 0.5 * g / np.sqrt(past[at])
    return ToxicityModel(weights.astype(np.float32), float(bias), 0.0)


def _cut(d: np.ndarray, y: np.ndarray) -> float:
    """The log-odds that part the labels best by F1 when the kinds weigh alike; the widest gap's middle.

    Only cuts above which most texts are toxic count: without one there is no evidence to go by, and
    the cut lies above all texts.
    """
    steps = np.unique(d)
    middles = (steps[1:] + steps[:-1]) / 2 if len(steps) > 1 else steps
    pos, neg = max(1, (y == 1).sum()), max(1, (y == 0).sum())
    hit = np.array([((d >= c) & (y == 1)).sum() / pos for c in middles])
    miss = np.array([((d >= c) & (y == 0)).sum() / neg for c in middles])
    good = 2 * hit / (hit + 6 * miss + 1)  # a clean document flagged costs six missed ones
    sound = hit * pos > miss * neg
    if not sound.any():
        return float(steps[-1]) + 1.0
    good = np.where(sound, good, -1.0)
    best = np.flatnonzero(good >= good.max() - 1e-9)
    gaps = np.diff(steps)[best] if len(steps) > 1 else np.zeros(1)
    return float(middles[best[int(gaps.argmax())]])


def _score(found, model: ToxicityModel, n: int) -> np.ndarray:
    buckets, sentence, text, _ = found
    return _document_logit(_logits(buckets, sentence, len(text), model.weights, model.bias), text, n)


def train(
    docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES
) -> ToxicityModel:
    """Learn from ``text`` of the documents that are not held out, and their ``toxic`` labels.

    At most about ``sample`` documents of each label are drawn, by a hash of the id, at rates from
    counts over all labelled documents; of these, as many in the order of the hash as hold
    ``sample_bytes`` a label, whole texts only. A document with several labels is toxic if any says
    so, and of rows that repeat an id one text is used; rows without id, text or label are not. A
    table without labels of both kinds gives a model that flags nothing.
    """
    marks = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
        .groupBy("doc_id")
        .agg(F.max((F.col("toxic") == 1).cast("int")).alias("_toxic"))
        .where(~common.held_out(F.col("doc_id")))
    )
    counts = {r._toxic: r.n for r in marks.groupBy("_toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    rates = F.lit(0.0)
    for kind, n in sorted(counts.items()):
        rates = F.when(F.col("_toxic") == kind, min(1.0, sample / n)).otherwise(rates)
    drawn = marks.where(common.share(F.col("doc_id"), rates))
    stored = hand_off(
        docs.select("doc_id", "text")
        .where(F.col("text").isNotNull())
        .join(F.broadcast(drawn), "doc_id")  # at most about two samples of ids
        .groupBy("doc_id", "_toxic")
        .agg(F.min("text").alias("text")),
        "labelled",
    ).withColumn("_place", F.xxhash64("doc_id"))
    sizes = stored.select("_toxic", "_place", F.octet_length("text").alias("size")).collect()
    ends = {}  # of each label, the first hash that is not used any more
    for kind in sorted(counts):
        total = 0
        for r in sorted((r for r in sizes if r._toxic == kind), key=lambda r: r._place):
            total += r.size
            if total > sample_bytes:
                ends[kind] = r._place
                break
    within = F.lit(True)
    for kind, end in ends.items():
        within = within & ((F.col("_toxic") != kind) | (F.col("_place") < end))
    rows = stored.where(within).orderBy("_place").select("text", "_toxic").toPandas()
    return fit(list(rows.text), list(rows._toxic))


def score(text: Column, model: ToxicityModel) -> Column:
    """The score of a whole text, 0 to 1, ``DECIDE`` at the cut; null and empty texts score 0."""
    shift = float(np.log(DECIDE / (1 - DECIDE))) - model.cut

    def scores(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            out = np.zeros(len(texts))
            for start, stop in rolling.chunks(texts):
                part = texts.slice(start, stop - start)
                found = features(part)
                d = _score(found, model, len(part)) + shift
                p = 1 / (1 + np.exp(-np.clip(d, -500, 500)))
                any_word = np.bincount(found[2], minlength=len(part)) > 0
                out[start:stop] = np.where(any_word, p, 0.0)
            yield pa.array(out, pa.float64())

    return F.arrow_udf(scores, "double")(text)


def locate(text: Column, model: ToxicityModel, at_least: float = 0.5) -> Column:
    """The offending sentences: an array of (first byte, score), in order; empty if none."""

    def sentences(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("first_byte", pa.int64()), ("score", pa.float64())]))
        for texts in batches:
            rows = []
            for one in range(len(texts)):
                buckets, sentence, text, first = features(texts.slice(one, 1))
                z = _logits(buckets, sentence, len(text), model.weights, model.bias) - model.cut
                p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
                rows.append([{"first_byte": int(first[i]), "score": float(p[i])} for i in np.flatnonzero(p >= at_least)])
            yield pa.array(rows, kind)

    return F.arrow_udf(sentences, "array<struct<first_byte:bigint,score:double>>")(text)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document of ``documents`` with its toxicity."""
    docs = common.table(spark, sf_dir, "documents")
    model = train(docs, common.table(spark, sf_dir, "labels"))
    return docs.select(
        "doc_id",
        common.held_out(F.col("doc_id")).alias("held_out"),
        score(F.col("text"), model).alias("score"),
    ).withColumn("predicted", (F.col("score") >= DECIDE).cast("int"))
