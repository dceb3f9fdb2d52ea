"""Language identification: averaged hashed subword embeddings and a linear softmax.

A text is the bag of its byte n-grams (1 to 4 bytes, letters only, word limits marked), hashed to
``BUCKETS``. Its vector is the average of the buckets' embeddings, and a linear layer with softmax
gives the languages. Both layers are trained by stochastic gradient descent in numpy on a bounded
sample; a temperature fitted on the part of the sample set aside makes the scores probabilities,
and the least sure thousandth of that part sets the score below which a text is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acctweave.llm import common, rolling

BUCKETS = 4_096
DIM = 16
SAMPLE = 600  # documents to learn from for each language; the bound of what the driver gets
UNKNOWN = "und"
RESULT = "lang_pred string, score double, rejected boolean"

#: Bytes as the n-grams see them: letters in lower case, all else one mark for a word's limit.
_LETTERS = np.full(256, 32, np.uint8)
_LETTERS[128:] = np.arange(128, 256)
for _b in range(97, 123):
    _LETTERS[_b] = _LETTERS[_b - 32] = _b


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    logits: np.ndarray  # bucket x language: embeddings times the linear layer
    bias: np.ndarray
    temperature: float
    reject_below: float


def bag(data: np.ndarray) -> np.ndarray:
    """How often each bucket occurs among the n-grams of one text."""
    b = np.empty(len(data) + 2, np.uint32)
    b[0] = b[-1] = 32
    b[1:-1] = _LETTERS[data]
    letter = b != 32
    counts = np.zeros(BUCKETS, np.int64)
    gram, inner = b, None
    for n in range(1, 5):
        if n > 1:
            if len(b) < n:
                break
            gram = (gram[:-1] << np.uint32(8)) | b[n - 1 :]
        if n == 1:
            keep = letter
        elif n == 2:
            keep = letter[:-1] | letter[1:]
        else:  # the bytes between the first and the last lie in one word
            inner = letter[1:-1] if n == 3 else inner[:-1] & letter[2:-1]
            keep = inner
        hashed = (gram[keep] + np.uint32(n * 0x3C6EF372)) * np.uint32(0x9E3779B1)
        counts += np.bincount(hashed >> np.uint32(20), minlength=BUCKETS)
    return counts


def _bags(texts: pa.Array) -> Iterator[np.ndarray]:
    data, offsets = rolling.flat(texts)
    for start, stop in zip(offsets[:-1], offsets[1:], strict=True):
        yield bag(data[start:stop])


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(texts: list[str], langs: list[str], epochs: int = 12, seed: int = 7) -> LanguageModel:
    """Train on texts and their languages; every tenth text is set aside for calibration."""
    languages = tuple(sorted(set(langs)))
    if not languages:
        return LanguageModel((), np.zeros((BUCKETS, 0)), np.zeros(0), 1.0, 0.0)
    x = np.zeros((len(texts), BUCKETS), np.float32)
    for i, counts in enumerate(_bags(pa.array(texts, pa.string()))):
        x[i] = counts / max(1, counts.sum())
    y = np.searchsorted(np.array(languages), np.array(langs))
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(texts))
    aside = order[::10] if len(order) >= 50 else order
    learn = np.setdiff1d(order, aside) if len(order) >= 50 else order
    emb = rng.normal(0, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    lin = rng.normal(0, 0.1, (DIM, len(languages))).astype(np.float32)
    bias = np.zeros(len(languages), np.float32)
    steps, step = epochs * (len(learn) // 32 + 1), 0
    for _ in range(epochs):
        rng.shuffle(learn)
        for k in range(0, len(learn), 32):
            rows = learn[k : k + 32]
            rate = 1 - step / steps
            step += 1
            h = x[rows] @ emb
            g = _softmax(h @ lin + bias)
            g[np.arange(len(rows)), y[rows]] -= 1
            g /= len(rows)
            back = g @ lin.T
            lin -= rate * 2 * (h.T @ g)
            bias -= rate * 0.1 * g.sum(axis=0)
            emb -= rate * 200 * (x[rows].T @ back)
    z, true = x[aside] @ emb @ lin + bias, y[aside]
    loss = {
        t: -np.log(_softmax(z / t)[np.arange(len(true)), true] + 1e-12).mean()
        for t in np.geomspace(0.1, 10, 41)
    }
    temperature = float(min(loss, key=loss.get))
    sure = _softmax(z / temperature)
    right = sure.max(axis=1)[sure.argmax(axis=1) == true]
    floor = float(np.quantile(right, 0.001)) if len(right) else 0.0
    chance = 1.05 / len(languages)
    return LanguageModel(languages, emb @ lin, bias, temperature, max(chance, min(0.5, floor)))


def train(docs: DataFrame, sample: int = SAMPLE) -> LanguageModel:
    """Learn from ``text`` and ``lang`` of the documents that are not held out.

    At most about ``sample`` documents of each language are drawn, by a hash of the id, from
    counts over all documents; rows without a language or a text are not used.
    """
    known = docs.select("doc_id", "text", "lang").where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~common.held_out(F.col("doc_id"))
    )
    rates = F.lit(0.0)
    for lang, n in sorted((r.lang, r.n) for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()):
        rates = F.when(F.col("lang") == lang, min(1.0, sample / n)).otherwise(rates)
    rows = known.where(common.share(F.col("doc_id"), rates)).select("text", "lang").toPandas()
    return fit(list(rows.text), list(rows.lang))


def predict(text: Column, model: LanguageModel) -> Column:
    """A struct of ``lang_pred``, ``score`` (probability of that language) and ``rejected``.

    Null texts and texts without a letter are ``und`` with score 0, and rejected, as are all
    texts when the model knows no language. Other texts get the likeliest language, also if
    rejected. Ties go to the first language of the alphabet.
    """

    def languages(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            names, scores = [], []
            for counts in _bags(texts):
                z = (counts @ model.logits / max(1, counts.sum()) + model.bias) / model.temperature
                e = np.exp(z - z.max())
                best = int(e.argmax())
                names.append(model.languages[best])
                scores.append(float(e[best] / e.sum()))
            low = [s < model.reject_below for s in scores]
            yield pa.StructArray.from_arrays(
                [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(low)],
                ["lang_pred", "score", "rejected"],
            )

    nothing = F.struct(
        F.lit(UNKNOWN).alias("lang_pred"),
        F.lit(0.0).alias("score"),
        F.lit(True).alias("rejected"),
    )
    if not model.languages:
        return nothing
    found = F.arrow_udf(languages, RESULT)(text)
    return F.when(F.coalesce(text.rlike(r"\p{L}"), F.lit(False)), found).otherwise(nothing)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document of ``documents`` with its predicted language."""
    docs = common.table(spark, sf_dir, "documents")
    model = train(docs)
    return docs.select(
        "doc_id",
        common.held_out(F.col("doc_id")).alias("held_out"),
        predict(F.col("text"), model).alias("_p"),
    ).select("doc_id", "held_out", "_p.*")
