"""Mixing sources to target weights along a time-varying curriculum."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wikicells.llm.ranks import ranked, shuffle_key, stratum
from wikicells.llm.scratch import settle

WORDS = r"[^\x20\x09-\x0D]+"


def targets(sizes: DataFrame, weights: Sequence[int], slopes: Sequence[float], share: float, most: int) -> DataFrame:
    """One row a source: weight, slope and target words.

    `sizes` has (stratum_, source_size). Weights and slopes repeat over the sources in code-point
    order. A source asks for level * weight, but for `most` times its size at most; the level is
    where the demands sum up to `share` of all words. That is what sharing by weight and resharing
    what lies above the limits come to. Sources are sorted by the level at which they reach their
    limit, so the level follows from running sums over the sources (one row each).
    """
    def repeat(values: Sequence[float]) -> Column:
        return F.element_at(F.array(*map(F.lit, values)), (F.col("number_") % len(values) + 1).cast("int"))

    everything = Window.partitionBy()
    rows = sizes.withColumn("number_", F.row_number().over(Window.orderBy("stratum_")) - 1).select(
        "stratum_", "source_size", repeat([int(w) for w in weights]).alias("weight"), repeat([float(s) for s in slopes]).alias("slope"),
    )
    filling = Window.orderBy(F.col("source_size") / F.col("weight"), "stratum_").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.select(
        "*",
        F.coalesce(F.sum(most * F.col("source_size")).over(filling), F.lit(0)).alias("full_"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(filling), F.lit(0))).alias("open_"),
        F.sum("source_size").over(everything).alias("all_"),
    ).withColumn("level_", (share * F.col("all_") - F.col("full_")) / F.col("open_"))
    # the first source in this order whose demand stays within its limit fixes the level for all after it
    fits = F.col("level_") * F.col("weight") <= most * F.col("source_size")
    rows = rows.withColumn("at_", F.min(F.when(fits, F.struct("full_", "level_"))).over(everything))
    return rows.select(
        "stratum_", "source_size", "weight", "slope",
        F.coalesce(
            F.least(F.col("at_.level_") * F.col("weight"), (most * F.col("source_size")).cast("double")),
            (most * F.col("source_size")).cast("double"),
        ).alias("target"),
    )


def at(part: Column, slope: Column) -> Column:
    """The time in 0 to 1 by which a source has handed out this part of its target.

    Its weight at time t is proportional to 1 + slope * (2t - 1), so the demand until t is
    t + slope * (t^2 - t) of the target; this is the inverse.
    """
    root = F.sqrt((1 - slope) * (1 - slope) + 4 * slope * part)
    return F.when(slope == 0, part).otherwise((root - (1 - slope)) / (2 * slope))


def mix(
    docs: DataFrame, weights: Sequence[int] = (3, 1, 2), slopes: Sequence[float] = (0.5, -0.5, 0.0), share: float = 1.5,
    most: int = 2, cut: bool = True, seed: str = "mixture",
) -> DataFrame:
    """Every document with the words the mix takes of it and its training positions.

    A source's documents follow each other in a seeded random order, again from the start when the
    target is larger than the source. With `cut` the last document is taken up to the word at which
    the target is met, so a source's words sum up to its target rounded down; without, documents are
    taken whole and the sum is off by half of one document at most. A copy of a document gets as
    position the time at which the source's demand reaches its first word; rows come sorted by it.

    Returns doc_id, source, text_key (xxhash64 of the text), size, source_size, target, taken,
    copies (times taken, a cut one included) and positions (one each, array). A null or blank text
    has no words: size 0, taken 0. A null source is the last source. Rows without doc_id and
    repeated rows are documents like others. An empty table gives no rows. Other columns are left
    out. Only small rows are shuffled, never the texts.
    """
    if any(w <= 0 for w in weights) or any(not -1 <= s <= 1 for s in slopes) or share > most:
        raise ValueError("weights must be positive, slopes in -1 to 1, the share at most the most repeats")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = settle(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.xxhash64(F.col("text")).alias("text_key"), F.regexp_count(text, F.lit(WORDS)).cast("long").alias("size"),
    ))
    rows = rows.withColumn("stratum_", stratum(F.col("source"))).withColumn("key_", shuffle_key(seed, F.col("doc_id"), F.col("size")))
    sizes = rows.groupBy("stratum_").agg(F.sum("size").alias("source_size"))
    rows = ranked(rows, "stratum_", "key_", ["doc_id", "size", "text_key"], "size")
    rows = rows.join(targets(sizes, weights, slopes, share, most), "stratum_")
    size, total, before = F.col("size"), F.col("source_size"), F.col("before")
    goal = F.floor(F.col("target"))
    rows = rows.withColumn("epochs_", F.when(total > 0, F.floor(goal / total)).otherwise(0))
    rows = rows.withColumn("rest_", goal - F.col("epochs_") * total)
    if cut:
        extra = F.greatest(F.lit(0), F.least(size, F.col("rest_") - before))
    else:
        extra = F.when(2 * before + size <= 2 * F.col("rest_"), size).otherwise(0)
    rows = rows.withColumn("extra_", extra.cast("long"))
    copies = (F.when(size > 0, F.col("epochs_")).otherwise(0) + F.when(F.col("extra_") > 0, 1).otherwise(0)).cast("int")
    rows = rows.withColumn("copies", copies).withColumn("taken", (F.col("epochs_") * size + F.col("extra_")).cast("long"))
    part = lambda i: (before + i * total) / F.col("target")
    positions = F.when(
        F.col("copies") > 0, F.transform(F.sequence(F.lit(0), F.col("copies") - 1), lambda i: at(part(i), F.col("slope")))
    ).otherwise(F.array().cast("array<double>"))
    return rows.withColumn("positions", positions).select(
        "doc_id", "source", "text_key", "size", "source_size", "target", "taken", "copies", "positions"
    )


def by_position(mixed: DataFrame) -> DataFrame:
    """Range-sorts documents by their first training position; documents that are not taken come last."""
    return mixed.withColumn("position", F.try_element_at("positions", F.lit(1))).orderBy(
        F.col("position").asc_nulls_last(), "doc_id", "text_key"
    )


def repeat_rows(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The rows of `docs`, all columns, each as often as `mixed` takes it, range-sorted by training position; rows not taken go.

    Each copy stands at its own position. Rows equal in doc_id and text share their copies. This joins
    and sorts, and so shuffles, the texts.
    """
    no_id = F.lit(-(2**63)).cast("long")
    keys = ["id", "text_key"]
    same = Window.partitionBy(*keys)
    copies = mixed.select(F.coalesce("doc_id", no_id).alias("id"), "text_key", "positions").withColumn("equals", F.count("*").over(same))
    copies = copies.select(*keys, "equals", F.explode("positions").alias("position")).withColumn("turn", F.row_number().over(same.orderBy("position")))
    # the copies of equal rows are dealt to them in turn
    copies = copies.select(*keys, ((F.col("turn") - 1) % F.col("equals") + 1).cast("int").alias("n"), "position")
    # the row as a whole, so that its columns may have any names
    rows = docs.select(F.struct("*").alias("row"), F.coalesce(F.col("doc_id").cast("long"), no_id).alias("id"), F.xxhash64("text").alias("text_key"))
    rows = rows.withColumn("n", F.row_number().over(same.orderBy(F.lit(0)))).join(copies, [*keys, "n"])
    return rows.orderBy("position", *keys, "n").select("row.*")
