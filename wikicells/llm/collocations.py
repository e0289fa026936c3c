"""Phrases whose words occur together more than apart, mined best first with admissible bounds.

A phrase grows word by word from its prefix. Counts of a prefix bound the score of all that may grow
from it: cut after its first word, a phrase p of count a scores a * a / (f(first) * f(rest)), and as
the rest occurs at least a times, and no phrase more often than its prefix, no phrase that begins
with the words x y scores above f(x y) / f(x).

Words and, of words that are frequent enough, pairs are counted first. The frontier are the pairs by
their bounds. A round takes the best of them in every language and counts what grows from these pairs,
and what ends with pairs that score as high, since these may swallow a pair. A language is settled
once as many phrases survive at or above the level of the round as are wanted: nothing that is left
in its frontier can reach them. Otherwise the next round takes a lower level.

Tasks count locally before anything is shuffled. What a round wants counted is sent to the tasks as
bitmaps of hashes of a fixed size; a chance hit is counted for nothing, exactly like the others.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wikicells.llm.scratch import settle

#: Words that a task counts before it passes the counts on, less than 2^31.
CHUNK = 1 << 20
#: Bytes of a text that are cut into words at a time.
PART = 1 << 22
#: Bits of a bitmap of hashes: 8 MB.
BITS = 1 << 26
#: Factors by which the rank that sets a round's level grows; the round after the last takes all that is left.
ROUNDS = (1, 4, 16)

_BREAK = b"\xff"  # a byte that UTF-8 never has
_TABLE = bytes.maketrans(
    bytes(range(65, 91)) + b"\t.,;:!?\n\x0b\x0c\r", bytes(range(97, 123)) + b" " + _BREAK * 10
)
_CUT = re.compile(rb"[ \xff]")
_ROTATE = 21


class _Numbers(dict):
    """Numbers of words in the order of their appearance; 0 breaks a phrase."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _parts(text: bytes) -> Iterator[list[bytes]]:
    """Words of a text, with a break at every end of a piece, in parts that end between words."""
    text, at = text.translate(_TABLE), 0
    while at < len(text):
        end = _CUT.search(text, at + PART)
        until = end.start() if end else len(text)
        yield text[at:until].replace(_BREAK, b" \xff ").split()
        at = until


def _hashes(words: list[bytes], used: np.ndarray, lang: str) -> np.ndarray:
    """Spark's hash of (lang, word) for the used numbers."""
    seed, out = xxhash.xxh64_intdigest(lang.encode(), 42), np.zeros(len(words), np.uint64)
    out[used] = [xxhash.xxh64_intdigest(words[i], seed) for i in used.tolist()]
    return out


def _has(bitmap: np.ndarray, slots: np.ndarray) -> np.ndarray:
    slots = slots & np.uint64(BITS - 1)
    return (bitmap[slots >> np.uint64(3)] >> (slots & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _pair(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return x ^ ((y << np.uint64(_ROTATE)) | (y >> np.uint64(64 - _ROTATE)))


def _grams(ids: np.ndarray, n: int, words: list[bytes], lang: str, bitmaps: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(word numbers, count) of the distinct runs of n words that the bitmaps want."""
    windows = np.lib.stride_tricks.sliding_window_view(ids, n)
    windows = windows[(windows > 0).all(1)]
    if n > 1 and len(windows):
        hashes = _hashes(words, np.unique(windows), lang)
        if n == 2:
            frequent = _has(bitmaps[0], hashes)
            windows = windows[frequent[windows].all(1)]
        else:
            x, y, z = (hashes[windows[:, k]] for k in range(3))
            windows = windows[_has(bitmaps[0], _pair(x, y)) | _has(bitmaps[1], _pair(y, z))]
    key = windows[:, 0].astype(np.int64)
    if n > 1:
        key = key << 32 | windows[:, 1]
    order = np.lexsort((windows[:, 2], key)) if n > 2 else np.argsort(key, kind="stable")
    key, windows = key[order], windows[order]
    fresh = np.diff(key, prepend=-1) != 0
    if n > 2:
        fresh |= np.diff(windows[:, 2], prepend=-1) != 0
    first = np.flatnonzero(fresh)
    return windows[first], np.diff(np.append(first, len(windows)))


def _counts(texts: DataFrame, n: int, bitmaps: list[np.ndarray] = ()) -> DataFrame:
    """(lang, w1 .. wn, f): occurrences of runs of n words within pieces. For n = 1 a null word has the
    occurrences of all words of the language."""
    names = [f"w{k + 1}" for k in range(n)]
    sent = texts.sparkSession.sparkContext.broadcast(bitmaps)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, held, size = _Numbers({_BREAK: 0}), defaultdict(list), 0

        def flushed() -> Iterator[pa.RecordBatch]:
            words = list(numbers)
            known = pa.array(words, pa.binary())
            for lang, runs in held.items():
                ids = np.concatenate(runs)
                if len(ids) >= n:
                    found, count = _grams(ids, n, words, lang, sent.value)
                    columns, counts = [known.take(pa.array(found[:, k])) for k in range(n)], count
                    if n == 1:
                        columns, counts = [pa.concat_arrays([columns[0], pa.nulls(1, pa.binary())])], np.append(count, count.sum())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(counts), pa.string()), *columns, pa.array(counts, pa.int64())], names=["lang", *names, "f"]
                    )

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                for words in _parts(text.as_py()):
                    ids = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
                    held[lang].append(ids)
                    size += len(ids)
                    if size >= CHUNK:
                        yield from flushed()
                        # a run may still begin with the last words
                        listed, ids = list(numbers), np.concatenate(held[lang])
                        last = [listed[i] for i in ids[len(ids) - n + 1 :].tolist()]
                        numbers, held = _Numbers({_BREAK: 0}), defaultdict(list)
                        held[lang].append(np.array([numbers[word] for word in last], np.int64))
                        size = 0
                held[lang].append(np.zeros(1, np.int64))
        yield from flushed()

    found = texts.mapInArrow(run, f"lang string, {', '.join(f'{name} binary' for name in names)}, f long")
    return found.groupBy("lang", *(F.col(name).cast("string").alias(name) for name in names)).agg(F.sum("f").alias("f"))


def _hash(word: str) -> Column:
    return F.xxhash64("lang", word)


def _pair_hash(x: str, y: str) -> Column:
    x, y = _hash(x), _hash(y)
    return x.bitwiseXOR(F.shiftleft(y, _ROTATE).bitwiseOR(F.shiftrightunsigned(y, 64 - _ROTATE)))


def _bitmap(hashes: DataFrame) -> np.ndarray:
    """A bitmap of the hashes, made by Spark; BITS / 8 bytes whatever the number of hashes."""
    slot = F.col("hash").bitwiseAND(F.lit(BITS - 1)) + 1
    rows = hashes.select(slot.alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")
    )
    out = np.zeros((BITS // 32768, 4096), np.uint8)
    for row in rows.collect():
        out[row["bucket"] - 1] = np.frombuffer(row["bits"], np.uint8)
    return out.ravel()


def _score(a: str, left: str, right: str) -> Column:
    """floor(1000000 a a / (left right)), exact for counts up to 10^15."""
    a, left, right = (f"cast({x} AS decimal(18,0))" for x in (a, left, right))
    return F.expr(f"cast(({a} * {a} * cast(1000000 AS decimal(7,0))) div ({left} * {right}) AS long)")


def _level(pairs: DataFrame, rank: int) -> DataFrame:
    """(lang, level): the score of the pair of that rank, 0 where there are fewer."""
    placed = pairs.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score")))).where(F.col("place") <= rank)
    return placed.groupBy("lang").agg(F.when(F.count("*") == rank, F.min("score")).otherwise(0).cast("long").alias("level"))


def _survivors(pairs: DataFrame, triples: DataFrame, levels: DataFrame, share: int) -> DataFrame:
    """Phrases at or above their language's level that no longer candidate swallows."""
    wider = triples.select("lang", "w1", "w2", "a").union(triples.select("lang", "w2", "w3", "a"))
    wider = wider.groupBy("lang", "w1", "w2").agg(F.max("a").alias("within"))
    two = pairs.join(levels, "lang").where("score >= level").join(wider, ["lang", "w1", "w2"], "left").where(
        F.col("within").isNull() | (100 * F.col("within") < share * F.col("a"))
    ).select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", F.col("f1").alias("l"), F.col("f2").alias("r"), "score")
    three = triples.join(levels, "lang").where("score >= level").select(
        "lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", "l", "r", "score"
    )
    return two.union(three)


def collocations(docs: DataFrame, top: int = 2000, least: int = 10, share: int = 50) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's `top` phrases of two or three words.

    Texts are lower-cased (A-Z), split into pieces at `.,;:!?` and line ends, and those into words at
    spaces and tabs. All counts are by `lang`, null being `und`, over contiguous runs within pieces,
    overlaps included: a of the phrase, which must be `least` or more, l and r of the parts of the cut
    that scores least (the first such cut), n of all words. The score is floor(1000000 a a / (l r)).
    A phrase is left out if a longer one that occurs `least` times or more holds it and has `share`
    percent of its count. Order: score, then a, descending, then phrase by its bytes.

    Null and empty texts have no words; a language without phrases has no rows, as has an empty
    table. Repeated rows count each. Other columns are ignored.
    """
    texts = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").cast("binary").alias("text")
    ).where(F.octet_length("text") > 0)
    words = settle(_counts(texts, 1).where((F.col("f") >= least) | F.col("w1").isNull()))
    total = words.where("w1 IS NULL").select("lang", F.col("f").alias("n"))
    words = words.where("w1 IS NOT NULL")

    counted = _counts(texts, 2, [_bitmap(words.select(_hash("w1").alias("hash")))]).where(F.col("f") >= least).withColumnRenamed("f", "a")
    pairs = counted.join(words.withColumnRenamed("f", "f1"), ["lang", "w1"]).join(
        words.select("lang", F.col("w1").alias("w2"), F.col("f").alias("f2")), ["lang", "w2"]
    )
    bound = F.expr("cast((cast(a AS decimal(18,0)) * cast(1000000 AS decimal(7,0))) div cast(f1 AS decimal(18,0)) AS long)")
    pairs = settle(pairs.select("lang", "w1", "w2", "a", "f1", "f2", _score("a", "f1", "f2").alias("score"), bound.alias("bound")))

    levels = settle(pairs.select("lang").distinct().select("lang", F.lit(None).cast("long").alias("level"), F.lit(False).alias("settled")))
    triples = None
    for factor in (*ROUNDS, None):
        lower = _level(pairs, top * factor) if factor else levels.select("lang", F.lit(0).cast("long").alias("level"))
        lower = lower.withColumnRenamed("level", "lower")
        levels = settle(levels.join(lower, "lang").select(
            "lang", F.col("level").alias("above"), F.when(F.col("settled"), F.col("level")).otherwise(F.col("lower")).alias("level"), "settled"
        ))
        frontier = pairs.join(levels.where("NOT settled"), "lang")
        # what earlier rounds have expanded is not expanded again
        grow, end = (frontier.where(f"{of} >= level AND (above IS NULL OR {of} < above)") for of in ("bound", "score"))
        bitmaps = [_bitmap(of.select(_pair_hash("w1", "w2").alias("hash"))) for of in (grow, end)]
        fresh = _counts(texts, 3, bitmaps).where(F.col("f") >= least).withColumnRenamed("f", "a")
        left = pairs.select("lang", "w1", "w2", F.col("a").alias("f12"), "f1")
        right = pairs.select("lang", F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("f23"), F.col("f2").alias("f3"))
        fresh = fresh.join(left, ["lang", "w1", "w2"]).join(right, ["lang", "w2", "w3"])
        fresh = fresh.withColumn("s1", _score("a", "f1", "f23")).withColumn("s2", _score("a", "f12", "f3"))
        early = F.col("s1") <= F.col("s2")
        fresh = fresh.select(
            "lang", "w1", "w2", "w3", "a", F.when(early, F.col("f1")).otherwise(F.col("f12")).alias("l"),
            F.when(early, F.col("f23")).otherwise(F.col("f3")).alias("r"), F.least("s1", "s2").alias("score"),
        )
        triples = settle(fresh if triples is None else triples.union(fresh).distinct())
        found = _survivors(pairs, triples, levels.select("lang", "level"), share).groupBy("lang").agg(F.count("*").alias("found"))
        levels = settle(levels.join(found, "lang", "left").select(
            "lang", "level", (F.col("settled") | (F.col("level") == 0) | (F.coalesce("found", F.lit(0)) >= top)).alias("settled")
        ))
        if levels.where("NOT settled").isEmpty():
            break
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        _survivors(pairs, triples, levels.select("lang", "level"), share).withColumn("rank", F.row_number().over(best).cast("long"))
        .where(F.col("rank") <= top).join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
