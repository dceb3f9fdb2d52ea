"""Standardization and matching inside Spark, for feeds without service answers.

The rules here are ours and public; their results are not comparable with a remote service's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acctweave import layouts
from acctweave.functions import (
    compact,
    digits,
    edits_up_to,
    first_word,
    similarity,
    standard_line,
    standard_name,
    text_of,
)
from acctweave.operators.handoff import hand_off
from acctweave.operators.skew import skew_join

NAME_WEIGHT = 0.6
LINE_WEIGHT = 0.4


def _joined(*parts: Column) -> Column:
    """``parts`` as one key; null when any is blank, as a blank part identifies nothing."""
    filled = F.lit(True)
    for part in parts:
        filled = filled & (part != "")
    return F.when(filled, F.concat_ws("|", *parts))


# ---- standardization ----


def _address(line1: str, zip5: str) -> Column:
    return _joined(standard_line(text_of(F.col(line1))), F.trim(text_of(F.col(zip5))))


def standardize_accounts(accounts: DataFrame, addresses: DataFrame) -> DataFrame:
    """``accounts`` with the 29 ``STD_ORG_*`` columns, looked up in a reference address table.

    ``addresses`` has the 26 address fields (``ADDR1`` ... ``RESIDENT_DLVRY_IND``). An account meets
    the address with the same standard line 1 and ZIP; without one its address fields are ''. Many
    accounts may share one address, so the join splits hot addresses; accounts without an address
    are not shuffled for it.
    """
    fields = layouts.ADDRESS_FIELDS
    blanked = (f"coalesce(string({f}), '') AS {f}" for f in fields)
    attached = (f"coalesce(_ref.{f}, '') AS STD_ORG_{f}" for f in fields)
    keyed = accounts.withColumn("_address", _address("ORG_ADDRESS_LINE_1", "ORG_ZIP_CODE"))
    reference = (
        addresses.select(
            _address("ADDR1", "ZIP").alias("_address"),
            F.expr(f"struct({', '.join(blanked)}) AS _ref"),
        )
        .where(F.col("_address").isNotNull())
        .groupBy("_address")
        .agg(F.min("_ref").alias("_ref"))
    )
    phone = digits(text_of(F.col("ORG_PHONE_NUMBER")))
    return skew_join(keyed, reference, "_address", "left").select(
        *accounts.columns,
        standard_name(text_of(F.col("ORG_NAME"))).alias("STD_ORG_NAME"),
        *map(F.expr, attached),
        phone.alias("STD_ORG_PHONE"),
        F.when(F.length(phone) == 10, F.substring(phone, 1, 3))
        .otherwise("")
        .alias("STD_ORG_AREACD"),
    )


# ---- matching ----

MEMBER_COLUMNS = ("name", "line1", "zip5", "areacode", "phone")


def block_keys(name: Column, zip5: Column, areacode: Column, phone: Column) -> Column:
    """Array of the blocking keys of one account or member, without the blank ones.

    First word of the name with the ZIP; area code with the whole phone; the name without blanks.
    """
    keys = (
        F.concat(F.lit("word|"), _joined(first_word(name), zip5)),
        F.concat(F.lit("phone|"), _joined(areacode, phone)),
        F.concat(F.lit("name|"), _joined(compact(name))),
    )
    return F.array_compact(F.array(*keys))


def match_accounts(
    accounts: DataFrame,
    master: DataFrame,
    min_score: float = 0.0,
    name_weight: float = NAME_WEIGHT,
    line_weight: float = LINE_WEIGHT,
) -> DataFrame:
    """``accounts`` (standardized layout) fanned out to the clusters of ``master`` they match.

    ``master`` has ``ORG_ID``, ``MEMBER_ID`` and the text columns ``name``, ``line1``, ``zip5``,
    ``areacode``, ``phone``. An account and a cluster are compared when they share a blocking key.
    A pair of account and member scores ``name_weight`` x name similarity plus ``line_weight`` x
    line 1 similarity, and the confidence is the average over all members of the cluster that share
    a key with the account, each counted once. Every cluster at or above ``min_score`` is returned;
    an account without one gives a single null row. A high ``min_score`` saves most of the scoring
    (see ``_scored_from``) and changes no result.

    ``accounts`` is read more than once: hand over a stored table (see ``hand_off``).

    Copies are compared once: accounts collapse to distinct signatures, and the members of a cluster
    to distinct ones with their number. A pair that shares several keys counts under the first one,
    which either side's keys tell, and pairs are summed where they arise, before the shuffle.
    """
    columns = {
        "name": F.upper(text_of(F.col("STD_ORG_NAME"))),
        "line1": F.upper(text_of(F.col("STD_ORG_ADDRESS_LINE_1"))),
        "zip5": text_of(F.col("STD_ORG_ZIP_CODE")),
        "areacode": text_of(F.col("STD_ORG_AREACD")),
        "phone": text_of(F.col("STD_ORG_PHONE_NUMBER")),
    }
    told = F.struct(*(c.alias(n) for n, c in columns.items()))
    signature = F.coalesce(F.md5(F.to_json(told)), F.lit(""))  # never null, and known not to be
    keyed = accounts.withColumn("_signature", signature)
    # both sides are read twice, for their hot keys and for the join
    account_keys = hand_off(_account_keys(keyed, columns), "account-keys")
    members = hand_off(_member_keys(master), "member-keys")
    pairs = skew_join(account_keys, members, "_block", left_spread=["_signature"]).where(
        F.get(F.array_intersect("_keys", "p_keys"), F.lit(0)) == F.col("_block")
    )
    weights = {"name": name_weight, "line1": line_weight}
    if min_score > min(weights.values()):
        scored = _scored_from(pairs, account_keys, members, weights, min_score)
    else:  # either text may differ entirely, so nothing can be left out
        scored = _scored(pairs, weights)
    scored = scored.where(F.col("ORG_MATCH_CONFIDENCE") >= min_score)
    return skew_join(keyed, scored, "_signature", "left", left_spread=["BU_REC_ID"]).select(
        *accounts.columns, "ORG_ID", "ORG_MATCH_CONFIDENCE"
    )


def _scored(pairs: DataFrame, weights: dict[str, float]) -> DataFrame:
    """Average score of every signature and cluster over its pairs with spellings."""
    score = sum(w * similarity(F.col(c), F.col(f"p_{c}")) for c, w in weights.items())
    return (
        pairs.select("_signature", "ORG_ID", "n", score.alias("_score"))
        .groupBy("_signature", "ORG_ID")
        .agg((F.sum(F.col("n") * F.col("_score")) / F.sum("n")).alias("ORG_MATCH_CONFIDENCE"))
    )


def _scored_from(
    pairs: DataFrame,
    account_keys: DataFrame,
    members: DataFrame,
    weights: dict[str, float],
    min_score: float,
) -> DataFrame:
    """As ``_scored``, for clusters that reach ``min_score``; others may be missing.

    A pair below ``min_score`` needs no exact score unless better pairs make up for it. So each text
    is compared as far only as a pair of ``min_score`` allows (lengths first, then a bounded edit
    distance), and gets an upper bound beyond. Clusters whose bounds average below ``min_score`` are
    out. Most others have exact scores only; the few with a bound among them are scored in full.
    """
    total = sum(weights.values())
    edits, scores, exact = [], F.lit(0.0), F.lit(True)
    for c, weight in weights.items():
        least = (min_score - (total - weight)) / weight if weight else 0.0
        edits.append(edits_up_to(F.col(c), F.col(f"p_{c}"), max(least, 0.0)).alias(f"_{c}"))
        longer = F.greatest(F.length(c), F.length(f"p_{c}"))
        scores = scores + weight * F.when(longer == 0, F.lit(0.0)).otherwise(
            1 - F.abs(f"_{c}") / longer
        )
        exact = exact & (F.col(f"_{c}") >= 0)
    bounded = (
        pairs.select("*", *edits)
        .select("_signature", "ORG_ID", "n", scores.alias("_score"), exact.alias("_exact"))
        .groupBy("_signature", "ORG_ID")
        .agg(
            (F.sum(F.col("n") * F.col("_score")) / F.sum("n")).alias("ORG_MATCH_CONFIDENCE"),
            F.min("_exact").alias("_exact"),
        )
        .where(F.col("ORG_MATCH_CONFIDENCE") >= min_score - 1e-9)
    )
    reached = hand_off(bounded, "reached")  # exact ones go on, the others are scored

    def once(df: DataFrame, keys: str) -> DataFrame:
        """The first of the rows that a signature or spelling has, one for each of its keys."""
        return df.where(F.col("_block") == F.get(keys, F.lit(0))).drop("_block")

    doubtful = reached.where("NOT _exact").select("_signature", "ORG_ID")
    accounts = once(account_keys, "_keys").join(doubtful, "_signature")
    again = skew_join(accounts, once(members, "p_keys"), "ORG_ID", left_spread=["_signature"])
    full = _scored(again.where(F.arrays_overlap("_keys", "p_keys")), weights)
    return reached.where("_exact").drop("_exact").unionByName(full)


def _account_keys(keyed: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """One row per distinct account signature and blocking key."""
    distinct = keyed.select("_signature", *(c.alias(n) for n, c in columns.items())).distinct()
    return distinct.withColumn("_keys", _blocks()).select(
        "_signature", "name", "line1", "_keys", F.explode("_keys").alias("_block")
    )


def _member_keys(master: DataFrame) -> DataFrame:
    """One row per blocking key and distinct spelling of a cluster's members, with their number."""
    members = (
        master.select("ORG_ID", "MEMBER_ID", *(text_of(F.col(c)).alias(c) for c in MEMBER_COLUMNS))
        .withColumns({"name": F.upper("name"), "line1": F.upper("line1")})
        .distinct()
    )
    spellings = (
        members.withColumn("p_keys", _blocks())
        .groupBy("ORG_ID", "name", "line1", "p_keys")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return spellings.select(
        "ORG_ID",
        F.col("name").alias("p_name"),
        F.col("line1").alias("p_line1"),
        "p_keys",
        "n",
        F.explode("p_keys").alias("_block"),
    )


def _blocks() -> Column:
    return block_keys(F.col("name"), F.col("zip5"), F.col("areacode"), F.col("phone"))
