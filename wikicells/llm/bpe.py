"""Byte-level BPE: texts to token ids and back."""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wikicells.llm.scratch import settle

#: Distinct words, the most frequent ones, whose tokens are folded once and sent to all tasks.
DICTIONARY = 1 << 17
#: Bytes of the longest word of the dictionary.
LONGEST = 64
#: Slots of the rank map.
SLOTS = 1 << 16
#: Rare words whose tokens a worker remembers.
REMEMBERED = 1 << 17
#: Documents that a task encodes at a time.
SLICE = 128


def read_ranks(path: str) -> dict[bytes, int]:
    """The vocabulary of a rank file: base64 token, rank. A rank is a token's id and its place among the merges."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def rank_map(spark: SparkSession, ranks: dict[bytes, int]) -> Column:
    """The vocabulary as one value, an array of small maps that Spark finds by the crc32 of a token.

    Spark searches a map entry by entry, so one map of the whole vocabulary would be slow. The
    vocabulary, and so the value, has a fixed size. It is read from a table, as the driver keeps the
    text of every plan, and with it that of a literal.
    """
    slots: list[dict[str, int]] = [{} for _ in range(SLOTS)]
    for token, rank in ranks.items():
        slots[zlib.crc32(token) % SLOTS][token.hex().upper()] = rank
    table = settle(spark.createDataFrame([(json.dumps(slots),)], "slots string"))
    return table.select(F.from_json("slots", "array<map<string,int>>")).scalar()


def folded(word: Column, vocabulary: Column) -> Column:
    """Token ids of a word given as bytes, by higher-order functions.

    Starts from single bytes; each step of the fold merges the neighbours that form the token of
    lowest rank, the leftmost of equals, until there are none. A word that is a token is that token.
    """
    def rank(ranks: Column, token: Column) -> Column:
        return ranks[F.pmod(F.crc32(token), F.lit(SLOTS)).cast("int")][F.hex(token)]

    def step(ranks: Column, parts: Column) -> Column:
        pairs = F.filter(
            F.transform(
                F.sequence(F.lit(1), F.size(parts) - 1),
                lambda i: F.struct(rank(ranks, F.concat(parts[i - 1], parts[i])).alias("rank"), i.alias("at")),
            ),
            lambda p: p["rank"].isNotNull(),
        )
        merged = F.transform(
            F.slice(F.array_sort(pairs), 1, 1),
            lambda p: F.concat(
                F.slice(parts, 1, p["at"] - 1), F.array(F.concat(parts[p["at"] - 1], parts[p["at"]])),
                F.slice(parts, p["at"] + 2, F.size(parts)),
            ),
        )
        return F.when(F.size(parts) < 2, parts).otherwise(F.coalesce(F.try_element_at(merged, F.lit(1)), parts))

    def fold(ranks: Column) -> Column:
        size = F.octet_length(word)
        parts = F.transform(F.sequence(F.lit(1), size), lambda i: F.substring(word, i, F.lit(1)))
        parts = F.aggregate(F.sequence(F.lit(1), size), parts, lambda done, _: step(ranks, done))
        whole = rank(ranks, word)
        return F.when(whole.isNotNull(), F.array(whole)).otherwise(F.transform(parts, lambda part: rank(ranks, part)))

    return F.transform(F.array(vocabulary), fold)[0]


def dictionary(docs: DataFrame, ranks: dict[bytes, int], pattern: str, size: int = DICTIONARY) -> dict[str, bytes]:
    """Tokens, as little-endian 32-bit ids, of the most frequent words of all documents: `size` at most.

    Words are counted over all texts. The least count that keeps the number of words within `size`
    comes from a histogram of the counts in eighths of powers of two, so ties stay together.
    """
    spark = docs.sparkSession
    words = docs.select(F.explode(F.regexp_extract_all("text", F.lit("(?U)" + pattern), F.lit(0))).alias("word"))
    counts = settle(words.groupBy("word").count().where(F.octet_length("word").between(1, LONGEST)))
    step = F.floor(F.log2("count") * 8).cast("int")
    histogram = sorted(counts.groupBy(step.alias("step")).count().collect(), reverse=True)
    held, least = 0, None
    for row in histogram:
        held += row["count"]
        if held > size:
            break
        least = row["step"]
    if least is None:
        return {}
    found = counts.where(step >= least).repartition(spark.sparkContext.defaultParallelism * 4, "word")
    # a column of its own first, as Spark takes no subquery as the argument of a higher-order function
    found = found.select("word", rank_map(spark, ranks).alias("vocabulary"))
    tokens = found.select("word", folded(F.encode("word", "UTF-8"), F.col("vocabulary")).alias("ids"))
    table = tokens.toArrow()  # of a bounded number of rows
    ids = table.column("ids").combine_chunks()
    data, places = ids.values.to_numpy().astype("<u4").tobytes(), (4 * ids.offsets.to_numpy()).tolist()
    return {word.as_py(): data[places[i] : places[i + 1]] for i, word in enumerate(table.column("word"))}


def merge(word: bytes, ranks: dict[bytes, int]) -> bytes:
    """Tokens of a word that the dictionary lacks, in time n log n for any length."""
    if word in ranks:
        return ranks[word].to_bytes(4, "little")
    n = len(word)
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))  # of the part that starts here
    heap = [(rank, i, i + 2) for i in range(n - 1) if (rank := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, until = heapq.heappop(heap)
        middle = end[i]
        if not middle or middle >= n or end[middle] != until:
            continue
        end[i], end[middle] = until, 0
        if until < n:
            before[until] = i
            if (rank := ranks.get(word[i : end[until]])) is not None:
                heapq.heappush(heap, (rank, i, end[until]))
        if (left := before[i]) >= 0 and (rank := ranks.get(word[left:until])) is not None:
            heapq.heappush(heap, (rank, left, until))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[word[i : end[i]]])
        i = end[i]
    return np.array(ids, "<u4").tobytes()


def encoder(ranks: dict[bytes, int], known: dict[str, bytes], pattern: str) -> Callable[[str], bytes]:
    """A function from a text to its ids; words outside the dictionary are remembered up to a bound."""
    words, rare = regex.compile(pattern).findall, {}

    def tokens(word: str) -> bytes:
        if (ids := rare.get(word)) is None:
            ids = merge(word.encode(), ranks)
            if len(word) <= LONGEST:
                if len(rare) >= REMEMBERED:
                    rare.clear()
                rare[word] = ids
        return ids

    get = known.get
    return lambda text: b"".join([get(word) or tokens(word) for word in words(text)])


def _slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            yield batch.slice(at, SLICE)


def _encoded(batches: Iterable[pa.RecordBatch], to_ids: Callable[[str], bytes]) -> Iterator[pa.RecordBatch]:
    for batch in _slices(batches):
        ids = [to_ids(text.as_py()) for text in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary())], names=["doc_id", "ids"])


def _decoded(batches: Iterable[pa.RecordBatch], to_bytes: Callable[[bytes], bytes]) -> Iterator[pa.RecordBatch]:
    for batch in _slices(batches):
        texts = [to_bytes(ids.as_py()) for ids in batch.column("ids")]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())], names=["doc_id", "ids", "bytes"])


def _digested(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.column("ids").to_pylist(), batch.column("bytes").to_pylist()
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"), pa.array([len(x) // 4 for x in ids], pa.int64()),
            *(pa.array([hashlib.sha256(x).hexdigest() for x in column], pa.string()) for column in (ids, texts)),
        ], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def _prepared(docs: DataFrame, path: str, pattern: str, size: int) -> tuple[DataFrame, Broadcast]:
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ranks = read_ranks(path)
    return texts, docs.sparkSession.sparkContext.broadcast((ranks, dictionary(texts, ranks, pattern, size)))


def encode(docs: DataFrame, path: str, pattern: str, size: int = DICTIONARY) -> DataFrame:
    """(doc_id, ids) of every document; ids are binary, little-endian unsigned 32-bit token ids.

    A word is a match of `pattern`, encoded by itself; there are no special tokens. The most
    frequent distinct words of the corpus are folded once by higher-order functions, see `folded`,
    and sent to the tasks, a table of fixed size. The other words, a few percent of all, are merged
    where they occur, as sending all distinct words, or shuffling every word of every text, would
    grow with the corpus. Texts are encoded whole and not shuffled. A null or empty text has no ids.
    Repeated rows give repeated rows, a null doc_id is carried along, an empty table gives no rows;
    other columns are left out.
    """
    texts, sent = _prepared(docs, path, pattern, size)
    return texts.mapInArrow(lambda batches: _encoded(batches, encoder(*sent.value, pattern)), "doc_id long, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Adds `bytes` to (doc_id, ids): the bytes of the tokens one after the other. No ids give no bytes."""
    sent = encoded.sparkSession.sparkContext.broadcast(read_ranks(path))
    return encoded.select("doc_id", "ids").mapInArrow(
        lambda batches: _decoded(batches, decoder(sent.value)), "doc_id long, ids binary, bytes binary"
    )


def round_trip(docs: DataFrame, path: str, pattern: str, size: int = DICTIONARY) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): what `encode` and then `decode` give, as digests, in one go."""
    texts, sent = _prepared(docs, path, pattern, size)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, known = sent.value
        return _digested(_decoded(_encoded(batches, encoder(ranks, known, pattern)), decoder(ranks)))

    return texts.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def decoder(ranks: dict[bytes, int]) -> Callable[[bytes], bytes]:
    """A function from ids to the text's bytes: the tokens' bytes one after the other."""
    pieces = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        pieces[rank] = token
    return lambda ids: b"".join(map(pieces.__getitem__, np.frombuffer(ids, "<u4").tolist()))
