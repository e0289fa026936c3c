"""Proportional stratified interleaving of documents into shards."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wikicells.llm.ranks import ranked, shuffle_key, stratum
from wikicells.llm.scratch import settle

#: Cuts of the fractional ranks that are sorted apart from each other.
CUTS = 4096


def interleave(docs: DataFrame, shards: int = 8, seed: str = "interleave") -> DataFrame:
    """Every document with its shard, such that each shard holds each source in proportion.

    Rows are shuffled by a seeded key within their source; a row's fractional rank says how far
    through its source it is. All rows sorted by fractional rank (ties by source) and cut at equal
    counts give shards whose sizes are at most one row apart and whose mixture is the corpus's.

    Returns doc_id, source, size (UTF-8 bytes plus 1), text_crc32, shard, slot (from 0 within the
    shard). A null text counts as empty, a null source is a source of its own, rows without doc_id
    and repeated rows are rows like others: each gets a slot. An empty table gives no rows. Other
    columns are left out. Only small rows are shuffled, never the texts.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = settle(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    ))
    rows = rows.withColumn("stratum_", stratum(F.col("source"))).withColumn("key_", shuffle_key(seed, F.col("doc_id")))
    rows = ranked(rows, "stratum_", "key_", ["doc_id", "text_crc32", "size"], "size")
    rows = rows.select(
        "doc_id", "source", "size", "text_crc32", "stratum_",
        ((2 * F.col("rank") + 1) / (2.0 * F.col("group_rows"))).alias("fraction_"),
    ).withColumn("cut_", F.floor(F.col("fraction_") * CUTS))
    rows = settle(rows)
    ahead = Window.orderBy("cut_").rowsBetween(Window.unboundedPreceding, -1)
    cuts = rows.groupBy("cut_").agg(F.count("*").alias("n_"))
    cuts = cuts.select(
        "cut_", F.coalesce(F.sum("n_").over(ahead), F.lit(0)).alias("ahead_"), F.sum("n_").over(Window.partitionBy()).alias("all_"),
    )
    within = Window.partitionBy("cut_").orderBy("fraction_", "stratum_")
    place = F.col("ahead_") + F.col("n_") - 1
    return (
        rows.withColumn("n_", F.row_number().over(within))
        .join(cuts, "cut_")
        .withColumn("place_", place)
        .withColumn("shard", F.expr(f"CAST((place_ * {shards}) DIV all_ AS INT)"))
        .withColumn("slot", F.expr(f"place_ - (shard * all_ + {shards - 1}) DIV {shards}"))
        .select("doc_id", "source", "size", "text_crc32", "shard", "slot")
    )
