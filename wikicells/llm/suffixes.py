"""Exact repeated-substring removal by a depth-limited radix sort of suffixes.

Suffixes are ordered only as far as the threshold of so many bytes; suffixes that are equal so far
are the repeated windows. Sorting all of them would move each byte of the corpus hundreds of times,
so the passes, most significant digit first, go over few suffixes each:

1. Every window of `threshold` bytes has one anchor, the place of its least gram (GRAM bytes, least
   by a hash, leftmost of equals). The choice depends on the window's bytes alone, so equal windows
   have equal grams at equal places. The windows of one anchor start next to each other, so an
   anchor stands for a run of suffixes. The first digit is the anchor's gram: an anchor whose gram
   occurs once has no repeated window and is done.
2. The second digit is all that the run's windows cover. Anchors that are equal in it are repeated
   as a whole. One of each class goes on, where a gram has several classes.
3. The last digit is each window itself, compared within the gram.

Digits are compared by 64-bit polynomial hashes, windows by a pair of them within equal grams.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wikicells.llm.scratch import settle

GRAM = 64
#: Bytes of a text that are hashed at a time.
CHUNK = 1 << 21
#: Texts that a task works on at a time.
SLICE = 512
#: Classes of a gram whose windows are compared in one task; those of commoner grams are counted by Spark.
CROWD = 4096
#: Bytes of contexts that a task compares at a time, at least one gram.
HELD = 1 << 20

_MULTIPLIER = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_BYTES = tuple(np.random.default_rng(seed).integers(1, 2**63, 256, np.uint64) for seed in (5, 6))
_PLACE = np.uint64(28)
_tables: dict = {}


def _powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a multiplier and of its inverse, mod 2^64."""
    if which not in _tables or len(_tables[which][0]) < n:
        size, out = 1 << max(16, (n - 1).bit_length()), []
        for base in (_MULTIPLIER[which], pow(_MULTIPLIER[which], -1, 2**64)):
            table = np.full(size, np.uint64(base))
            table[0] = 1
            out.append(np.cumprod(table, dtype=np.uint64))
        _tables[which] = tuple(out)
    return _tables[which]


def _sums(raw: np.ndarray, which: int) -> np.ndarray:
    out = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTES[which][raw] * _powers(which, len(raw) + 1)[0][: len(raw)], out=out[1:])
    return out


def _hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray, which: int) -> np.ndarray:
    x = (sums[end] - sums[start]) * _powers(which, len(sums))[1][start]
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def anchors(raw: np.ndarray, threshold: int) -> tuple[np.ndarray, ...]:
    """(place, low, high, gram, cover) of each anchor: its windows start from low to high, both included."""
    n = len(raw)
    sums = _sums(raw, 0)
    at = np.arange(n - GRAM + 1)
    grams = _hashes(sums, at, at + GRAM, 0)
    keys = (grams >> _PLACE << _PLACE) | at.astype(np.uint64)
    width, done = threshold - GRAM + 1, 1
    while 2 * done <= width:
        keys = np.minimum(keys[:-done], keys[done:])
        done *= 2
    if done < width:
        keys = np.minimum(keys[: len(keys) - (width - done)], keys[width - done :])
    place = (keys & ((np.uint64(1) << _PLACE) - np.uint64(1))).astype(np.int64)
    low = np.flatnonzero(np.diff(place, prepend=-1))
    high = np.append(low[1:], len(place)) - 1
    place = place[low]
    return place, low, high, grams[place], _hashes(sums, low, high + threshold, 0)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            yield batch.slice(at, SLICE)


_ANCHOR = "doc long, print long, place long, low long, high long, gram long, cover long"


def _find(threshold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            found = []
            for i, text in enumerate(batch.column("text")):
                raw = np.frombuffer(text.as_buffer(), np.uint8)
                for begin in range(0, max(0, len(raw) - threshold + 1), CHUNK):
                    part = anchors(raw[begin : begin + CHUNK + threshold - 1], threshold)
                    place, low, high, gram, cover = part
                    found.append((np.full(len(place), i), place + begin, low + begin, high + begin, gram.astype(np.int64), cover.astype(np.int64)))
            if found:
                row, *columns = (np.concatenate(x) for x in zip(*found, strict=True))
                ids = [batch.column(c).take(pa.array(row)) for c in ("doc", "print")]
                yield pa.RecordBatch.from_arrays([*ids, *map(pa.array, columns)], names=_ANCHOR.replace(" long", "").split(", "))

    return run


_CONTEXT = "gram long, doc long, print long, low long, context binary, single boolean, crowded boolean"


def _cut(threshold: int):
    """Contexts of a document's anchors: the bytes that their windows cover."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            rows, contexts, of = [], [], batch.column("wanted")
            for row in range(batch.num_rows):
                raw = memoryview(batch.column("text")[row].as_buffer())
                for want in of[row].as_py():
                    rows.append((row, want["gram"], want["low"], want["single"], want["crowded"]))
                    contexts.append(bytes(raw[want["low"] : want["high"] + threshold]))
            row, gram, low, single, crowded = zip(*rows, strict=True) if rows else ((),) * 5
            row = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays([
                pa.array(gram, pa.int64()), batch.column("doc").take(row), batch.column("print").take(row),
                pa.array(low, pa.int64()), pa.array(contexts, pa.binary()), pa.array(single, pa.bool_()), pa.array(crowded, pa.bool_()),
            ], names=["gram", "doc", "print", "low", "context", "single", "crowded"])

    return run


def _windows(contexts: list[bytes], threshold: int) -> tuple[np.ndarray, ...]:
    """(context, start, hash, other hash) of every window of each context."""
    raw = np.frombuffer(b"".join(contexts), np.uint8)
    lengths = np.array([len(c) for c in contexts])
    first = np.cumsum(lengths) - lengths
    counts = lengths - threshold + 1
    owner = np.repeat(np.arange(len(contexts)), counts)
    start = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    at = start + first[owner]
    return owner, start, *(_hashes(_sums(raw, which), at, at + threshold, which) for which in (0, 1))


def _spans(table: pa.Table, owner: np.ndarray, start: np.ndarray, threshold: int) -> pa.RecordBatch:
    """Spans that repeated windows cover; windows that start next to each other make one."""
    fresh = np.flatnonzero((np.diff(owner, prepend=-1) != 0) | (np.diff(start, prepend=-2) != 1))
    last = np.append(fresh[1:], len(owner))[: len(fresh)] - 1
    rows = pa.array(owner[fresh])
    low = table.column("low").take(rows).to_numpy() if len(fresh) else np.zeros(0, np.int64)
    return pa.RecordBatch.from_arrays([
        *(table.column(c).take(rows).combine_chunks() for c in ("doc", "print")),
        pa.array(low + start[fresh], pa.int64()), pa.array(low + start[last] + threshold, pa.int64()),
    ], names=["doc", "print", "start", "end"])


def _compare(threshold: int):
    """Repeated windows among contexts that come sorted by gram."""
    def solve(table: pa.Table) -> pa.RecordBatch:
        owner, start, *hashes = _windows(table.column("context").to_pylist(), threshold)
        grams = table.column("gram").to_numpy()[owner]
        order = np.lexsort((hashes[1], hashes[0], grams))
        same = (grams[order][1:] == grams[order][:-1]) & np.logical_and(*(h[order][1:] == h[order][:-1] for h in hashes))
        repeated = np.zeros(len(order), bool)
        repeated[order[1:][same]] = repeated[order[:-1][same]] = True
        repeated &= table.column("single").to_numpy(zero_copy_only=False)[owner]
        return _spans(table, owner[repeated], start[repeated], threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.column("context").nbytes
            if size < HELD:
                continue
            table = pa.Table.from_batches(held)
            grams = table.column("gram").to_numpy()
            whole = int(np.searchsorted(grams, grams[-1]))
            if whole:
                yield solve(table.slice(0, whole))
            held, size = table.slice(whole).to_batches(), table.slice(whole).nbytes
        if held:
            yield solve(pa.Table.from_batches(held))

    return run


def _listed(threshold: int):
    """All windows of contexts, with their hashes."""
    names = ["gram", "doc", "print", "start", "hash_1", "hash_2", "single"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                owner, start, *hashes = _windows(part.column("context").to_pylist(), threshold)
                rows = pa.array(owner)
                gram, doc, mark, low, single = (part.column(c).take(rows) for c in ("gram", "doc", "print", "low", "single"))
                yield pa.RecordBatch.from_arrays(
                    [gram, doc, mark, pa.array(low.to_numpy() + start), *(pa.array(h.astype(np.int64)) for h in hashes), single], names=names
                )

    return run


def _texts(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.cast("binary").alias("text"))
    return rows.select(
        "doc_id", F.coalesce("doc_id", F.lit(-(2**63)).cast("long")).alias("doc"),
        F.xxhash64(F.col("doc_id").isNull(), "text").alias("print"), "text",
    )


def _repeated(texts: DataFrame) -> DataFrame:
    """(doc, print) of rows that are there more than once."""
    return settle(texts.groupBy("doc", "print").count().where("count > 1").select("doc", "print"))


def repeated_spans(docs: DataFrame, threshold: int = 200) -> DataFrame:
    """(doc, print, start, end): bytes of texts that lie in a window of `threshold` bytes which also
    starts anywhere else. Spans of a text may touch and overlap. `doc` is doc_id, or the least long
    for null, and `print` tells rows of one doc_id apart by a hash of the text. A repeated row is one
    text here, whose spans count once, with one over all of it.
    """
    texts = _texts(docs)
    repeated = _repeated(texts)
    once = _once(texts, repeated)
    whole = once.join(repeated, ["doc", "print"], "left_semi").where(F.octet_length("text") >= threshold)
    whole = whole.select("doc", "print", F.lit(0).cast("long").alias("start"), F.octet_length("text").cast("long").alias("end"))
    return _spans_of(once, threshold).union(whole)


def _once(texts: DataFrame, repeated: DataFrame) -> DataFrame:
    """One row of each repeated one, and all others, which are not shuffled for that."""
    copies = texts.join(repeated, ["doc", "print"], "left_semi").groupBy("doc", "print").agg(F.min("doc_id").alias("doc_id"), F.min("text").alias("text"))
    return texts.join(repeated, ["doc", "print"], "left_anti").unionByName(copies)


def _spans_of(texts: DataFrame, threshold: int) -> DataFrame:
    """Spans of texts of which each (doc, print) is there once."""
    found = settle(texts.where(F.octet_length("text") >= threshold).select("doc", "print", "text").mapInArrow(_find(threshold), _ANCHOR), SLICE)
    # settled counts are joined anew, so that Spark can split a gram that is very common
    often = settle(found.groupBy("gram").count().where("count > 1").select("gram"))
    found = settle(found.join(often, "gram", "left_semi"))
    one = F.min(F.struct("doc", "print", "place", "low", "high")).alias("one")
    classes = settle(found.groupBy("gram", "cover").agg(F.count("*").alias("n"), one))
    kinds = settle(classes.groupBy("gram").agg(F.count("*").alias("kinds")).where("kinds > 1"))
    whole = found.join(classes.where("n > 1").select("gram", "cover"), ["gram", "cover"]).select(
        "doc", "print", F.col("low").alias("start"), (F.col("high") + threshold).alias("end")
    )
    wanted = classes.join(kinds, "gram").groupBy("one.doc", "one.print").agg(F.collect_list(
        F.struct("gram", "one.low", "one.high", (F.col("n") == 1).alias("single"), (F.col("kinds") > CROWD).alias("crowded"))
    ).alias("wanted"))
    contexts = settle(texts.join(wanted, ["doc", "print"]).mapInArrow(_cut(threshold), _CONTEXT), SLICE)
    quiet = contexts.where("NOT crowded").repartition("gram").sortWithinPartitions("gram")
    quiet = quiet.mapInArrow(_compare(threshold), "doc long, print long, start long, end long")
    keys = ["gram", "hash_1", "hash_2"]
    listed = contexts.where("crowded").mapInArrow(
        _listed(threshold), "gram long, doc long, print long, start long, hash_1 long, hash_2 long, single boolean"
    )
    twice = listed.groupBy(*keys).count().where("count > 1").select(*keys)
    listed = listed.where("single").join(twice, keys, "left_semi").select(
        "doc", "print", "start", (F.col("start") + threshold).alias("end")
    )
    return whole.union(quiet).union(listed)


def _runs(spans: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of spans; touching spans are one run."""
    spans = np.array([(s["start"], s["end"]) for s in spans], np.int64).reshape(-1, 2)
    start, end = spans[np.argsort(spans[:, 0], kind="stable")].T
    end = np.maximum.accumulate(end)
    fresh = np.flatnonzero(np.concatenate([[True], start[1:] > end[:-1]]))
    return start[fresh], end[np.append(fresh[1:], len(end)) - 1]


def without_repeats(docs: DataFrame, threshold: int = 200) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) of every document; `kept` is what is left, binary.

    A text's UTF-8 bytes go that lie in a string of `threshold` bytes which also starts anywhere
    else in the corpus, the same text included; matches never cross texts, and all is judged on the
    input. A null text is empty; texts shorter than the threshold are kept whole, as is an empty
    one. Repeated rows are texts of their own, so all of their windows are repeated; they are
    compared with the others once, whatever their number. A null doc_id
    is carried along. An empty table gives no rows. Other columns are left out.

    `kept` need not be UTF-8, as spans may begin within a character.
    """
    texts = _texts(docs)
    repeated = _repeated(texts)
    spans = _spans_of(_once(texts, repeated), threshold).groupBy("doc", "print").agg(F.collect_list(F.struct("start", "end")).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            out = []
            for i in range(batch.num_rows):
                raw, spans = memoryview(batch.column("text")[i].as_buffer()), batch.column("spans")[i].as_py()
                start, end = _runs(spans) if spans else (np.zeros(0, np.int64),) * 2
                pieces = zip([0, *end.tolist()], [*start.tolist(), len(raw)], strict=True)
                out.append((len(raw), int((end - start).sum()), len(start), b"".join(raw[a:b] for a, b in pieces)))
            n_bytes, n_removed, n_spans, kept = zip(*out, strict=True) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (n_bytes, n_removed, n_spans)), pa.array(kept, pa.binary()),
            ], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    single = texts.join(repeated, ["doc", "print"], "left_anti").join(spans, ["doc", "print"], "left").mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    )
    # all of a repeated row goes if it has a window at all; its bytes need not meet any spans
    size, gone = F.octet_length("text").cast("long"), F.octet_length("text") >= threshold
    copies = texts.join(repeated, ["doc", "print"], "left_semi").select(
        "doc_id", size.alias("n_bytes"), F.when(gone, size).otherwise(0).alias("n_removed"),
        gone.cast("long").alias("n_spans"), F.when(gone, F.lit("").cast("binary")).otherwise(F.col("text")).alias("kept"),
    )
    return single.union(copies)
