"""Near-duplicate documents: BagMinHash signatures, banded, and multiset overlap verified.

A text is the multiset of its runs of ``SHINGLE`` words. BagMinHash gives each shingle of weight c
Poisson processes over the weight range [0, c): dyadic blocks [0, 1), [1, 2), [2, 4), ... have
processes of the rate of their length, in which every point has a time, a slot of the signature
and a place in the block. Points placed beyond c are skipped, so heavier shingles meet all points
of lighter ones, and the earliest point of a slot agrees between two texts with the probability of
their weighted Jaccard similarity. Points are made in the order of time, and a process ends once
it is later than all slots of its text, so a text takes few points beyond its shingles.

Equal multisets are collapsed first. Each text is compared with the most central of the leaders of
its buckets, which takes in most large classes. What still lies in a bucket with texts of another
class is compared bucket by bucket: first by a byte of every slot, then, for those that agree with
a text of another class in enough slots, by their shingles. A task gets the texts of a bucket, or of
two slices of a large one, and returns only the links that join classes, so no table grows with the
number of pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from acctweave.llm import common, rolling
from acctweave.llm.components import components
from acctweave.operators.handoff import hand_off

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 30, 7  # a pair of similarity 0.8 meets in a band but for 9 in 10,000
SURE = 6.0  # standard deviations that a pair may agree in fewer slots than its similarity says
SPLIT = 256  # slices of the members of a leader
SLICE = 1_000_000  # shingles of a slice of a bucket, about; a task compares two slices


def shingles(words: np.ndarray, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of a text and how often each occurs; short texts have one of all."""
    if not len(words):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.unique(rolling.gram_hashes(words, min(n, len(words))), return_counts=True)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard: the sum of smaller counts over the sum of larger ones."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = np.minimum(a[1][i], b[1][j]).sum()
    total = a[1].sum() + b[1].sum() - both
    return float(both / total) if total else 0.0


def signatures(shingle: np.ndarray, weight: np.ndarray, text: np.ndarray, n: int, slots: int) -> np.ndarray:
    """n x slots: the bits of the earliest time in every slot; texts without shingles keep infinity.

    ``shingle``, ``weight`` (whole numbers from 1) and ``text`` have a row per distinct shingle of
    a text. Two texts agree in a slot exactly if the same point came first.
    """
    first = np.full(n * slots, np.inf)
    blocks = [(np.arange(len(shingle)), 0)]  # a block of length 1 or 2^(k-1) that begins in c
    top = int(weight.max(initial=0))
    k = 1
    while (1 << (k - 1)) < top:
        blocks.append((np.flatnonzero(weight > (1 << (k - 1))), k))
        k += 1
    unit = np.concatenate([b for b, _ in blocks])
    level = np.concatenate([np.full(len(b), k, np.uint64) for b, k in blocks])
    begin = np.where(level == 0, 0, 1 << np.maximum(level.astype(np.int64) - 1, 0))
    length = np.where(level == 0, 1, begin).astype(float)
    state = rolling.mix(shingle[unit] + level * np.uint64(0xA0761D6478BD642F))
    doc, limit, time = text[unit], weight[unit], np.zeros(len(unit))
    while len(state):
        state = rolling.mix(state + np.uint64(0x9E3779B97F4A7C15))
        u = ((state >> np.uint64(11)).astype(float) + 0.5) / (1 << 53)
        time = time - np.log(u) / length
        other = rolling.mix(state ^ np.uint64(0xE7037ED1A0B428DB))
        slot = (other >> np.uint64(32)) % np.uint64(slots)
        place = begin + (other & np.uint64(0xFFFFFFFF)).astype(float) / (1 << 32) * length
        counts = np.flatnonzero(place < limit)
        np.minimum.at(first, doc[counts] * slots + slot[counts].astype(np.int64), time[counts])
        last = first.reshape(n, slots).max(axis=1)
        on = time < last[doc]
        state, doc, limit, time = state[on], doc[on], limit[on], time[on]
        begin, length = begin[on], length[on]
    return first.reshape(n, slots).view(np.int64)


def _bands(shingle: int, bands: int, rows: int):
    def bands_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            keys, slots, sets = [], [], []
            for start, stop in rolling.chunks(texts):
                words, text = rolling.word_hashes(texts.slice(start, stop - start))
                limits = np.searchsorted(text, np.arange(stop - start + 1))
                bags = [shingles(words[a:b], shingle) for a, b in zip(limits[:-1], limits[1:], strict=True)]
                sizes = [len(h) for h, _ in bags]
                grams, weights = (np.concatenate(x) for x in zip(*bags, strict=True))
                owner = np.repeat(np.arange(len(bags)), sizes)
                bits = signatures(grams, weights, owner, len(bags), bands * rows).astype(np.uint64)
                band = np.zeros((len(bags), bands), np.uint64)
                for r in range(rows):
                    band = rolling.mix(band ^ bits[:, r::rows])
                keys.append(rolling.mix(band + np.arange(bands, dtype=np.uint64)).view(np.int64))
                slots.append((rolling.mix(bits) >> np.uint64(56)).astype(np.uint8))
                whole = rolling.mix(grams + rolling.mix(weights.astype(np.uint64)))
                digest = np.zeros((2, len(bags)), np.uint64)  # of the multiset, in any order
                np.add.at(digest[0], owner, whole)
                np.add.at(digest[1], owner, rolling.mix(whole))
                sets.append((digest.view(np.int64), np.array(sizes)))
            flat = np.concatenate(keys).ravel() if keys else np.zeros(0, np.int64)
            yield pa.StructArray.from_arrays(
                [
                    pa.array(np.concatenate([d[0] for d, _ in sets]) if sets else [], pa.int64()),
                    pa.array(np.concatenate([d[1] for d, _ in sets]) if sets else [], pa.int64()),
                    pa.array(np.concatenate([s for _, s in sets]) if sets else [], pa.int64()),
                    pa.FixedSizeListArray.from_arrays(pa.array(flat), bands).cast(pa.list_(pa.int64())),
                    pa.array([row.tobytes() for part in slots for row in part], pa.binary()),
                ],
                ["m1", "m2", "size", "bands", "slots"],
            )

    kind = "m1 bigint, m2 bigint, size bigint, bands array<bigint>, slots binary"
    return F.arrow_udf(bands_of, kind)


def _agreeing(n: int, least: float) -> int:
    """Slots of ``n`` that texts of similarity ``least`` agree in, but for ``SURE`` deviations."""
    return int(n * least - SURE * (n * least * (1 - least)) ** 0.5)


def _compared(pairs: DataFrame, held: DataFrame, read, alike) -> DataFrame:
    """Of the pairs (a, b), those that are ``alike(read(a's), read(b's))`` by what ``held`` holds.

    ``held`` has ``node`` and one column of what is compared. The b's of a are dealt over slices, in
    each of which a comes first, so each is read once and no task gets all pairs of a hot a.
    """
    (what,) = [c for c in held.columns if c != "node"]
    slices = pairs.select("a", "b", F.pmod(F.xxhash64("b"), F.lit(SPLIT)).alias("slice"))
    heads = slices.select("a", "slice").distinct().select("a", F.lit(-1).cast("long").alias("b"), "slice", F.col("a").alias("node"))
    rows = heads.unionByName(slices.withColumn("node", F.col("b"))).join(held, "node")
    dealt = rows.select("a", "slice", (F.col("b") >= 0).alias("member"), "b", what).repartition("a", "slice")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lead, first = None, None
        for batch in batches:
            a_col, b_col = batch.column(0).to_numpy(), batch.column(3).to_numpy()
            left, right = [], []
            for i in range(batch.num_rows):
                own = read(batch.column(4).slice(i, 1))
                if b_col[i] < 0:
                    lead, first = a_col[i], own
                elif a_col[i] == lead and alike(first, own):
                    left.append(a_col[i])
                    right.append(b_col[i])
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    return dealt.sortWithinPartitions("a", "slice", "member").mapInArrow(compare, "a bigint, b bigint")


def _alike(pairs: DataFrame, slots: DataFrame, texts: DataFrame, shingle: int, least: float, n: int) -> DataFrame:
    """Of the pairs (a, b), those of texts alike: by their slots, then by their shingles."""
    enough = _agreeing(n, least)

    def bytes_of(one: pa.Array) -> np.ndarray:
        return np.frombuffer(one[0].as_py(), np.uint8)

    def shingles_of(one: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        return shingles(rolling.word_hashes(one)[0], shingle)

    agreeing = _compared(pairs, slots, bytes_of, lambda x, y: (x == y).sum() >= enough)
    return _compared(hand_off(agreeing, "agreeing"), texts, shingles_of, lambda x, y: similarity(x, y) >= least)


def _cells(waiting: DataFrame, size: int) -> DataFrame:
    """``cell``, ``node`` and ``component``: a bucket, or each two slices of one of more than ``size`` shingles."""
    slices = waiting.groupBy("band", "bucket").agg(F.ceil(F.sum("size") / size).alias("k"))
    own = F.pmod(F.xxhash64("node"), F.col("k"))
    return (
        waiting.join(slices, ["band", "bucket"])
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("k") - 1)))
        .where((F.col("k") == 1) | (F.col("own") != F.col("other")))
        .select(
            F.xxhash64("band", "bucket", F.least("own", "other"), F.greatest("own", "other")).alias("cell"),
            "node",
            "component",
        )
    )


def _whole_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    """The cells that end in each batch, the rows of each as one batch; rows are in the order of cells."""
    held = None
    for batch in batches:
        if held is not None:
            batch = pa.concat_batches([held, batch])
        cell = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(cell)) + 1).tolist()]
        yield [batch.slice(a, b - a) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        held = batch.slice(cuts[-1])
    if held is not None and held.num_rows:
        yield [held]


def _outside(label: np.ndarray) -> np.ndarray:
    """The rows of all labels but the most frequent one: pairs of unlike labels have one of these."""
    return np.flatnonzero(label != np.bincount(label).argmax())


def _meeting(cells: DataFrame, slots: DataFrame, enough: int) -> DataFrame:
    """Of ``cells``, the rows that agree in enough slots with one of another component of their cell."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in _whole_cells(batches):
            met = []
            for rows in whole:
                raw = np.array([np.frombuffer(x, np.uint8) for x in rows.column(3).to_pylist()])
                _, label = np.unique(rows.column(2).to_numpy(), return_inverse=True)
                found = np.zeros(len(label), bool)
                for x in _outside(label):
                    near = ((raw == raw[x]).sum(axis=1) >= enough) & (label != label[x])
                    found |= near
                    found[x] |= near.any()
                if found.any():
                    met.append(rows.select([0, 1, 2]).filter(pa.array(found)))
            if met:
                yield pa.concat_batches(met)

    dealt = cells.join(slots, "node").select("cell", "node", "component", "slots").repartition("cell")
    return dealt.sortWithinPartitions("cell").mapInArrow(meet, "cell bigint, node bigint, component bigint")


def _joining(cells: DataFrame, texts: DataFrame, shingle: int, least: float) -> DataFrame:
    """Links (a, b) of similar texts that join all components of a cell that such links connect."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in _whole_cells(batches):
            left, right = [], []
            for rows in whole:
                node = rows.column(1).to_numpy()
                _, label = np.unique(rows.column(2).to_numpy(), return_inverse=True)
                bags = []
                for start, stop in rolling.chunks(rows.column(3)):
                    words, text = rolling.word_hashes(rows.column(3).slice(start, stop - start))
                    limits = np.searchsorted(text, np.arange(stop - start + 1))
                    bags += [shingles(words[a:b], shingle) for a, b in zip(limits[:-1], limits[1:], strict=True)]
                _, gram = np.unique(np.concatenate([h for h, _ in bags]), return_inverse=True)
                count = np.concatenate([c for _, c in bags])
                limits = np.cumsum([0, *(len(h) for h, _ in bags)])
                total = np.add.reduceat(count, limits[:-1])
                of = np.zeros(int(gram.max()) + 1, np.int64)  # counts in the text compared
                for x in _outside(label):
                    own = slice(limits[x], limits[x + 1])
                    of[gram[own]] = count[own]
                    both = np.add.reduceat(np.minimum(count, of[gram]), limits[:-1])
                    of[gram[own]] = 0
                    # as in ``similarity``
                    near = np.flatnonzero((both / (total + total[x] - both) >= least) & (label != label[x]))
                    if len(near):
                        joined, first = np.unique(label[near], return_index=True)
                        left += [node[x]] * len(first)
                        right += node[near[first]].tolist()
                        label[np.isin(label, joined)] = label[x]
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    dealt = cells.join(texts, "node").select("cell", "node", "component", "text").repartition("cell")
    return dealt.sortWithinPartitions("cell").mapInArrow(join, "a bigint, b bigint")


def classes(
    docs: DataFrame,
    shingle: int = SHINGLE,
    least: float = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """``key``, ``tag``, ``class_key`` and ``class_tag`` of the documents ``docs`` (``doc_id``, ``text``).

    A class holds the documents that links of similarity ``least`` or more connect, and is named
    by its least ``key`` and ``tag``; ``key`` is the id, ``tag`` a hash of the text, which tells apart
    rows that repeat an id or have none. Texts without words (also null) are alike to none: a class
    each. Texts of fewer than ``shingle`` words have one shingle, all their words. A null id counts
    as larger than all others.
    """
    last = (1 << 63) - 1
    keyed = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(last)).alias("key"),
        F.xxhash64("text").alias("tag"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    signed = hand_off(
        keyed.select("key", "tag", _bands(shingle, bands, rows)("text").alias("s")).select("key", "tag", "s.*"), "bands"
    )
    worded = signed.where(F.col("size") > 0).drop("bands", "slots")
    # equal multisets: the least (key, tag) stands for all; nodes are numbers of such groups
    groups = hand_off(
        signed.where(F.col("size") > 0)
        .groupBy("m1", "m2")
        .agg(F.min(F.struct("key", "tag", "size", "bands", "slots")).alias("f"))
        .select("m1", "m2", "f.*"),
        "groups",
    ).withColumn("node", F.shiftrightunsigned(F.xxhash64("m1", "m2"), 1))
    spread = groups.select("node", "size", F.posexplode("bands").alias("band", "bucket"))
    crowded = spread.groupBy("band", "bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = hand_off(spread.join(crowded, ["band", "bucket"]), "members")
    met = members.groupBy("node").agg(F.sum("n").alias("meets"))
    slots = hand_off(groups.join(met, "node").select("node", "slots"), "slots")
    texts = hand_off(
        keyed.join(groups.join(met, "node").select("key", "tag", "node"), ["key", "tag"])
        .select("node", "text")
        .dropDuplicates(["node"]),
        "texts",
    )

    # each node with the leader, of those of its buckets, that meets most others
    leaders = (
        members.join(met, "node").groupBy("band", "bucket").agg(F.max(F.struct("meets", "node")).alias("leader"))
    )
    pairs = (
        members.join(leaders, ["band", "bucket"])
        .groupBy(F.col("node").alias("b"))
        .agg(F.max("leader")["node"].alias("a"))
        .where("a != b")
    )
    links = hand_off(_alike(pairs, slots, texts, shingle, least, bands * rows), "alike")
    labels = _closer(met.select("node", F.col("node").alias("component")), links)
    cells = _cells(_open(members.select("band", "bucket", "node", "size"), labels), SLICE)
    meeting = hand_off(_meeting(cells, slots, _agreeing(bands * rows, least)), "meeting")
    links = links.unionByName(hand_off(_joining(meeting, texts, shingle, least), "joining"))
    named = groups.join(components(links), "node", "left").select(
        "m1", "m2", "key", "tag", F.coalesce("component", "node").alias("component")
    )
    names = named.groupBy("component").agg(F.min(F.struct("key", "tag")).alias("f"))
    named = named.join(names, "component").select(
        "m1", "m2", F.col("f.key").alias("class_key"), F.col("f.tag").alias("class_tag")
    )
    columns = ("key", "tag", "class_key", "class_tag")
    alone = signed.where(F.col("size") == 0).select(
        "key", "tag", F.col("key").alias("class_key"), F.col("tag").alias("class_tag")
    )
    return worded.join(named, ["m1", "m2"]).select(*columns).unionByName(alone)


def _closer(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Each node with the least label within two links of it.

    Nodes of one label are connected. Others may be, too; that costs comparisons, and the classes are
    found from all links in the end.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    for _ in range(2):
        near = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("near"))
        )
        labels = labels.join(near, "node", "left").select(
            "node", F.least("component", "near").alias("component")
        )
    return hand_off(labels, "labels")


def _open(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members with their labels, of the buckets that hold more than one label."""
    told = members.join(labels, "node")
    mixed = (
        told.groupBy("band", "bucket")
        .agg(F.min("component").alias("x"), F.max("component").alias("y"))
        .where("x != y")
        .select("band", "bucket")
    )
    return hand_off(told.join(mixed, ["band", "bucket"]), "open")


def keep_one(docs: DataFrame, **how) -> DataFrame:
    """The documents of ``docs`` that remain, all columns as they are: one of each class.

    It is the one of the least id, and of these of the least hash of the text. Texts without words
    all stay. Of rows equal in id and text one stays; unlike texts stay apart whatever their ids.
    """
    key, tag, place = common.fresh(docs, "_key", "_tag", "_place")
    first = (
        classes(docs, **how)
        .where((F.col("key") == F.col("class_key")) & (F.col("tag") == F.col("class_tag")))
        .select(F.col("key").alias(key), F.col("tag").alias(tag))
        .distinct()
    )
    keyed = docs.withColumns(
        {key: F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)), tag: F.xxhash64("text")}
    )
    worded = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    one = F.row_number().over(Window.partitionBy(key, tag).orderBy(key))
    once = keyed.where(worded).join(first, [key, tag], "left_semi").withColumn(place, one)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return once.where(F.col(place) == 1).select(*columns).unionByName(keyed.where(~worded).select(*columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document of ``documents`` with its class (least doc_id) and whether it is kept."""
    found = classes(common.table(spark, sf_dir, "documents"))
    last = (1 << 63) - 1
    return found.select(
        F.when(F.col("key") != last, F.col("key")).alias("doc_id"),
        F.when(F.col("class_key") != last, F.col("class_key")).alias("class_id"),
        ((F.col("key") == F.col("class_key")) & (F.col("tag") == F.col("class_tag"))).alias("kept"),
    )
