"""Document fingerprints by winnowing, in Spark SQL expressions only.

The hashes of every ``GRAM`` consecutive words are taken; of every ``WINDOW`` consecutive hashes
the least is kept, the rightmost of equal ones, with its position. Any run of
``GRAM + WINDOW - 1`` words that two texts share leaves a common hash in both fingerprints.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from acctweave.llm import common
from acctweave.operators.handoff import hand_off

GRAM = 5
WINDOW = 16
LAST = (1 << 63) - 1  # stands for a null id

_RIGHT = (1 << 32) - 1  # positions count down from here in the low half of a rank


def fingerprint(df: DataFrame, text: str, into: str, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """``df`` with ``into``: array of (hash, position), by position, of the whole text.

    Words are runs of other than ASCII white space; a position is that of the gram's first word,
    from 0. Texts of fewer than ``gram`` words have one gram, all their words; texts without words
    (also null) have an empty fingerprint. Columns of ``df`` stay as they are.
    """
    words, grams, ranks = common.fresh(df, "_words", "_grams", "_ranks")
    g, number = F.col(grams), F.size(words)
    # the upper half of a rank is the hash's; the lower one lets the rightmost of equals be least
    rank = F.transform(
        g,
        lambda h, i: F.shiftleft(F.shiftrightunsigned(h, 33), 32).bitwiseOR(F.lit(_RIGHT) - i.cast("long")),
    )

    def found(r: Column) -> Column:
        at = (F.lit(_RIGHT) - r.bitwiseAND(F.lit(_RIGHT))).cast("int")
        return F.struct(F.get(g, at).alias("hash"), at.alias("position"))

    none = F.expr("array_repeat(named_struct('hash', 0L, 'position', 0), 0)")
    split = F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+")
    out = df.withColumn(words, F.transform(F.filter(split, lambda x: x != ""), lambda x: F.xxhash64(x)))
    out, hashes = _blocks(out, words, gram, F.xxhash64)
    whole = F.slice(hashes, 1, F.greatest(number - gram + 1, F.lit(0)))
    out = out.withColumn(grams, F.when(number == 0, F.col(words)).when(number < gram, F.array(F.xxhash64(words))).otherwise(whole))
    out, least = _blocks(out.withColumn(ranks, rank), ranks, window, F.least)
    kept = F.array_distinct(F.slice(least, 1, F.greatest(F.size(ranks) - window + 1, F.lit(1))))
    out = out.withColumn(into, F.when(F.size(g) == 0, none).otherwise(F.transform(kept, found)))
    return out.select(*[F.col(f"`{c}`") for c in [*df.columns, into]])


def _blocks(df: DataFrame, values: str, length: int, join) -> tuple[DataFrame, str]:
    """A column of ``join`` over every ``length`` consecutive values; the last ones have fewer.

    Blocks double in length from column to column, so that each is computed once.
    """
    have, last = 1, values
    while have < length:
        step = min(have, length - have)  # the second half may overlap the first
        (name,) = common.fresh(df, "_block")
        df = df.withColumn(name, F.zip_with(last, F.slice(last, step + 1, 1 << 30), lambda a, b: join(a, b)))
        have, last = have + step, name
    return df, last


def likeness(a: Column, b: Column) -> Column:
    """Shared hashes over all hashes of two fingerprints; 1 if both are empty."""
    x, y = (F.transform(p, lambda e: e["hash"]) for p in (a, b))
    every = F.size(F.array_union(x, y))
    return F.when(every == 0, 1.0).otherwise(F.size(F.array_intersect(x, y)) / every)


def as_text(p: Column) -> Column:
    """A fingerprint as text: hash in hex @ position, joined by one space."""
    return F.array_join(
        F.transform(p, lambda e: F.concat(F.hex(e["hash"]), F.lit("@"), e["position"].cast("string"))), " "
    )


def following(docs: DataFrame) -> DataFrame:
    """``key``, ``tag`` and those of the next document, by descending key; after the last the first.

    Keys are sorted in ranges. Inside a range the next row is at hand; the range's last row is
    followed by the first of the next range, of which there is one row for each range.
    """
    ids = docs.groupBy("key", "tag").agg(F.max("take").alias("take"))
    ranged = hand_off(
        ids.repartitionByRange(F.desc("key"), F.desc("tag")).withColumn("part", F.spark_partition_id()), "order"
    )
    this = F.struct("key", "tag")
    inside = Window.partitionBy("part").orderBy(F.desc("key"), F.desc("tag"))
    heads = ranged.groupBy("part").agg(F.max(this).alias("head"))
    over = Window.orderBy("part")  # over as many rows as there are ranges
    heads = heads.select(
        "part",
        F.coalesce(F.lead("head").over(over), F.first("head").over(over)).alias("after"),
    )
    return (
        ranged.withColumn("next", F.lead(this).over(inside))
        .join(heads, "part")
        .select("key", "tag", "take", F.coalesce("next", "after").alias("next"))
    )


def compare_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of ``docs`` (``doc_id``, ``text``), of edited texts, and how near they are.

    A document's edited text has its last third replaced by the beginning of the next document.
    A null text is empty. A null id comes first in the descending order. Rows that repeat an id
    with another text follow each other by a hash of the text; rows equal in both are one in that
    order, and each is returned.
    """
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("key"),
        F.xxhash64("text").alias("tag"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    printed = fingerprint(rows, "text", "print")
    order = following(rows.select("key", "tag", F.floor(F.length("text") / 3).cast("int").alias("take")))
    # a document's beginning and fingerprint go to the one before it
    again = F.lag(F.lit(True)).over(Window.partitionBy("key", "tag").orderBy("key"))
    giving = order.select(
        F.col("key").alias("to_key"),
        F.col("tag").alias("to_tag"),
        "take",
        F.col("next.key").alias("key"),
        F.col("next.tag").alias("tag"),
    )
    given = (
        printed.withColumn("again", again)  # both readings of this exchange are one
        .where(F.col("again").isNull())
        .join(giving, ["key", "tag"])
        .select(
            F.col("to_key").alias("key"),
            F.col("to_tag").alias("tag"),
            "take",
            F.substring("text", F.lit(1), F.col("take")).alias("beginning"),
            F.transform("print", lambda e: F.struct(e["hash"].alias("hash"))).alias("next_print"),
        )
    )
    both = printed.join(given, ["key", "tag"])
    n = F.length("text")
    edited = both.withColumn(
        "edited", F.concat(F.substring("text", F.lit(1), n - F.col("take")), F.col("beginning"))
    )
    return fingerprint(edited, "edited", "edited_print").select(
        F.when(F.col("key") != LAST, F.col("key")).alias("doc_id"), "text", "edited", "print", "edited_print", "next_print"
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document of ``documents`` and its edited text, fingerprinted and compared."""
    found = compare_edits(common.table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("print")).alias("fingerprint"),
        as_text(F.col("edited_print")).alias("edited_fingerprint"),
        likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
        likeness(F.col("print"), F.col("next_print")).alias("near_next"),
    )
