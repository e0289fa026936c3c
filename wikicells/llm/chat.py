"""Multi-party chat formatting: a dialogue rendered from the view of each participant."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Turn numbers that make one part of a long conversation.
TURNS = 512


def turn_parts(turns: DataFrame, span: int = TURNS) -> DataFrame:
    """The turns of each conversation, in order, in parts of bounded size: (conv_id, part, turns).

    A part holds the rows of `span` turn numbers. Should rows repeat turn numbers so much that such
    a part has over 2 * span rows, each of its turn numbers becomes a part, and rows of one number
    are spread by a hash over up to 4096 parts. So no conversation, however long, meets in one task.
    """
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    first = F.lit(-(2**63)).cast("long")
    rows = rows.select(
        "*", F.coalesce(F.floor(F.col("turn") / span), F.lit(0)).alias("block_"),
        F.coalesce("turn", first).alias("turn_"), F.md5(F.concat_ws(":", F.coalesce("role", F.lit("")), "text")).alias("hash_"),
    )
    crowded = rows.groupBy("conv_id", "block_").agg((F.count("*") > 2 * span).alias("crowded_"))
    same = [F.col("r.conv_id").eqNullSafe(F.col("c.conv_id")), F.col("r.block_") == F.col("c.block_")]
    rows = rows.alias("r").join(crowded.alias("c"), same).select("r.*", "crowded_")
    rows = rows.withColumn("at_", F.when(F.col("crowded_"), F.col("turn_")).otherwise(first)).withColumn(
        "spread_", F.when(F.col("crowded_"), F.substring("hash_", 1, 3)).otherwise("")
    )
    parts = rows.groupBy("conv_id", "block_", "at_", "spread_").agg(
        F.sort_array(F.collect_list(F.struct("turn_", "hash_", "role", "text"))).alias("turns")
    )
    order = Window.partitionBy("conv_id").orderBy("block_", "at_", "spread_")
    return parts.select("conv_id", (F.row_number().over(order) - 1).alias("part"), "turns")


def rotate(turns: DataFrame, not_speakers: Sequence[str] = ("system",), span: int = TURNS) -> DataFrame:
    """Every conversation rendered once for each participant, that one as the assistant.

    The view's own turns start with `<|assistant|>`, those of others with `<|user name=...|>`; turns
    of `not_speakers` keep their role (`<|system|>`) and get no view. Each turn is header, line feed,
    text, `<|end|>`, line feed. Masks mark what a model is trained on in this view: the text and end
    mark of the assistant's turns, as code-point spans of the rendered text, end exclusive.

    Returns conv_id, perspective, part (from 0), text, masks (array of start, end), n_turns and
    n_own. A conversation is one part unless it is very long, see `turn_parts`. Turns are ordered by
    turn number (null before 0), ties by a hash of role and text; repeated rows are repeated turns. A
    null text is empty. A null role is a user without name and has no view. Null conv_id is one
    conversation. A conversation without speakers, or an empty table, gives no rows. Other columns
    are left out.
    """
    people = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("role").cast("string").alias("perspective"))
    people = people.where(F.col("perspective").isNotNull() & ~F.col("perspective").isin(*not_speakers)).distinct()
    parts = turn_parts(turns, span)
    views = parts.alias("t").join(people.alias("p"), F.col("t.conv_id").eqNullSafe(F.col("p.conv_id"))).select(
        "t.conv_id", "perspective", "part", "turns"
    )

    def piece(turn: Column) -> Column:
        role, own = turn["role"], turn["role"].eqNullSafe(F.col("perspective"))
        head = (
            F.when(own, F.lit("<|assistant|>\n"))
            .when(role.isin(*not_speakers), F.concat(F.lit("<|"), role, F.lit("|>\n")))
            .when(role.isNull(), F.lit("<|user|>\n"))
            .otherwise(F.concat(F.lit("<|user name="), role, F.lit("|>\n")))
        )
        body = F.concat(turn["text"], F.lit("<|end|>"))
        return F.struct(
            head.alias("head"), body.alias("body"), own.alias("own"),
            (F.length(head) + F.length(body) + 1).cast("long").alias("length"), F.length(head).cast("long").alias("skip"),
        )

    views = views.withColumn("pieces_", F.transform("turns", piece))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"))
    marks = F.aggregate(
        "pieces_", start,
        lambda done, p: F.struct(
            (done["at"] + p["length"]).alias("at"),
            F.when(
                p["own"],
                F.concat(done["spans"], F.array(F.struct((done["at"] + p["skip"]).alias("start"), (done["at"] + p["length"] - 1).alias("end")))),
            ).otherwise(done["spans"]).alias("spans"),
        ),
        lambda done: done["spans"],
    )
    return views.select(
        "conv_id", "perspective", "part",
        F.array_join(F.transform("pieces_", lambda p: F.concat(p["head"], p["body"], F.lit("\n"))), "").alias("text"),
        marks.alias("masks"), F.size("turns").cast("long").alias("n_turns"),
        F.size(F.filter("pieces_", lambda p: p["own"])).cast("long").alias("n_own"),
    )
