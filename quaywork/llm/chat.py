"""Logged conversations: collapse cumulative snapshots, then render the rest.

Everything here is DataFrame functions; no row passes through Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quaywork.functions.skew import numbered
from quaywork.llm.common import settle

SLICE = 512
#: Marks of the rendered form.  Fixed values.
OPEN, CLOSE, NO_ROLE = "<|im_start|>", "<|im_end|>", "unknown"


def ordered_turns(
    logs: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(name, id, place, role, text): turns counted from 1 in order of turn, role and text, null turns last."""
    turns = logs.select(
        F.coalesce(F.col(f"`{conversation}`").cast("string"), F.lit("")).alias("name"),
        F.col(f"`{conversation}`").alias("id"),
        F.coalesce(F.col(f"`{turn}`").cast("bigint"), F.lit(2**62)).alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    order = [F.col("turn"), F.col("role"), F.col("text")]
    placed = numbered(turns, ["name"], order, F.floor(F.col("turn") / SLICE), "place")
    return placed.select("name", "id", "place", "role", "text")


def _turn_hash(salt: int) -> Column:
    return F.xxhash64(F.lit(salt), "place", "role", "text").cast("decimal(20,0)")


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """Adds to each turn the hashes of itself (``h``) and of its conversation up to it (``p``).

    A turn's hash depends on its place, so the running sum over a conversation
    is a hash of the whole prefix, rolled forward by one addition.  Two sums of
    64-bit hashes make 128 bits.  A long conversation is summed in slices of
    ``SLICE`` turns whose totals carry over, so that no task has to hold it.
    """
    hashed = (
        turns.withColumn("slice", F.floor((F.col("place") - 1) / SLICE))
        .withColumn("h1", _turn_hash(1))
        .withColumn("h2", _turn_hash(2))
    )
    earlier = W.partitionBy("name").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    none = F.lit(0).cast("decimal(30,0)")
    carried = (
        hashed.groupBy("name", "slice")
        .agg(F.sum("h1").alias("s1"), F.sum("h2").alias("s2"))
        .select(
            "name",
            "slice",
            F.coalesce(F.sum("s1").over(earlier), none).alias("b1"),
            F.coalesce(F.sum("s2").over(earlier), none).alias("b2"),
        )
    )
    inside = W.partitionBy("name", "slice").orderBy("place").rowsBetween(W.unboundedPreceding, 0)
    return (
        hashed.withColumn("l1", F.sum("h1").over(inside))
        .withColumn("l2", F.sum("h2").over(inside))
        .join(carried, ["name", "slice"])
        .select(
            "name",
            "id",
            "place",
            F.struct("h1", "h2").alias("h"),
            F.struct(
                (F.col("l1") + F.col("b1")).cast("decimal(38,0)").alias("p1"),
                (F.col("l2") + F.col("b2")).cast("decimal(38,0)").alias("p2"),
            ).alias("p"),
        )
    )


def maximal(turns: DataFrame) -> DataFrame:
    """(name, id, turns) of the conversations that are no prefix of a longer one, one of each set of copies.

    Of equal conversations the one with the least id stays.  The prefix that
    ends before a turn is known from that turn alone (its own prefix less its
    hash), so all proper prefixes are one distinct projection, and what they
    equal is removed by an anti-join.  Both sides have distinct keys, so a first
    turn that everyone shares is one row.
    """
    hashes = settle(prefix_hashes(turns), "prefixes")
    ends = hashes.groupBy("name").agg(
        F.min("id").alias("id"), F.max(F.struct("place", "p")).alias("end")
    )
    whole = ends.groupBy(
        F.col("end.place").alias("turns"), F.col("end.p.p1").alias("p1"), F.col("end.p.p2").alias("p2")
    ).agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "name")).alias("first"))
    proper = (
        hashes.where("place > 1")
        .select(
            (F.col("place") - 1).alias("turns"),
            (F.col("p.p1") - F.col("h.h1")).cast("decimal(38,0)").alias("p1"),
            (F.col("p.p2") - F.col("h.h2")).cast("decimal(38,0)").alias("p2"),
        )
        .distinct()
    )
    kept = whole.join(proper, ["turns", "p1", "p2"], "left_anti")
    return kept.select("first.name", "first.id", "turns")


def _plain(text: Column) -> Column:
    """A text in which nothing reads as a mark."""
    return F.regexp_replace(text, r"<\|", "< |")


def format_chats(
    logs: DataFrame,
    turns_per_part: int = 256,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """The maximal conversations rendered: conversation id, part, n_turns, rendered.

    A conversation that is a prefix of a longer one, or equals one with a
    smaller id, is left out.  A conversation of more than ``turns_per_part``
    turns comes in several parts, counted from 0, whose texts follow on one
    another; so no row or task grows with it.

    Null turns come last; turns of equal number go by role, then text, and
    repeated rows are repeated turns.  A null text is an empty one, a null role
    is empty and rendered as unknown.  Rows without conversation id are one
    conversation.  Marks inside roles and texts are broken up.  Other columns
    are left out.  Empty input: no rows.
    """
    turns = settle(ordered_turns(logs, conversation, turn, role, text), "turns")
    kept = settle(maximal(turns).select("name"), "maximal")
    who = F.when(F.col("role") == "", NO_ROLE).otherwise(_plain(F.col("role")))
    piece = F.concat(F.lit(OPEN), who, F.lit("\n"), _plain(F.col("text")), F.lit(CLOSE + "\n"))
    rendered = (
        turns.join(kept, "name", "left_semi")
        .groupBy("name", F.floor((F.col("place") - 1) / turns_per_part).alias("part"))
        .agg(
            F.min("id").alias(conversation),
            F.count(F.lit(1)).alias("n_turns"),
            F.sort_array(F.collect_list(F.struct("place", piece.alias("piece")))).alias("pieces"),
        )
    )
    whole = F.array_join(F.transform("pieces", lambda x: x["piece"]), "")
    return rendered.select(conversation, "part", "n_turns", whole.alias("rendered"))
