"""MinHash near-duplicate detection with exact confirmation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wikicells.llm.components import components
from wikicells.llm.scratch import settle

BANDS = 32
ROWS = 6
#: Shingles that a block of a candidate group holds on average.
BLOCK = 150_000
#: Documents that a block holds on average, at most.
DOCUMENTS = 512
#: Columns of the matrices that are multiplied at a time.
COLUMNS = 4096
#: Texts that go to Python at a time.
SLICE = 1024
#: Hashes that are minimised at a time.
CHUNK = 1 << 18

_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIXER = np.uint64(0xBF58476D1CE4E5B9)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIXER
    x = (x ^ (x >> np.uint64(29))) * _ODD
    return x ^ (x >> np.uint64(32))


_BYTES = _mixed(np.arange(1, 257, dtype=np.uint64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def shingles(text: bytes, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles of so many words; of all its words if it has fewer."""
    raw = _LOWER[np.frombuffer(text, np.uint8)]
    inside = ~_WHITE[raw]
    edges = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0, append=0))
    start, end = edges[::2], edges[1::2]
    if not len(start):
        return np.zeros(0, np.uint64)
    # hash of a word: its bytes as a polynomial
    lengths = end - start
    first = np.cumsum(lengths) - lengths
    place = np.arange(lengths.sum()) - np.repeat(first, lengths)
    terms = _BYTES[raw[inside]] * _powers(_ODD, int(lengths.max()))[place]
    hashes = _mixed(np.add.reduceat(terms, first) + lengths.astype(np.uint64))
    count = min(words, len(hashes))
    joined = np.full(len(hashes) - count + 1, np.uint64(count))
    for k in range(count):
        joined = _mixed(joined * _ODD + hashes[k : k + len(joined)])
    return np.unique(joined)


def _hash_functions(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    return rng.integers(0, 2**63, n, np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 2**63, n, np.uint64)


def minima(sets: list[np.ndarray], bands: int, rows: int) -> np.ndarray:
    """Band keys (sets x bands) of non-empty sets: a hash of the minima of `rows` universal hash functions each."""
    factor, addend = _hash_functions(bands * rows)
    values = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    keys = np.empty((len(sets), bands), np.uint64)
    for band in range(bands):
        key = np.full(len(sets), np.uint64(band))
        for k in range(band * rows, (band + 1) * rows):
            key = _mixed(key * _ODD + np.minimum.reduceat((values * factor[k] + addend[k]) >> np.uint64(32), starts))
        keys[:, band] = key
    return keys


def _flushed(sets: list[np.ndarray], ids: list, bands: int, rows: int) -> pa.RecordBatch:
    keys = minima([s for s in sets if len(s)] or [np.zeros(1, np.uint64)], bands, rows).astype(np.int64)
    at = np.cumsum([len(s) > 0 for s in sets]) - 1
    return pa.RecordBatch.from_arrays([
        pa.array(ids, pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
        pa.array([int(np.bitwise_xor.reduce(_mixed(s)).astype(np.int64)) if len(s) else None for s in sets], pa.int64()),
        pa.array([int(np.sum(_mixed(s + _ODD), dtype=np.uint64).astype(np.int64)) if len(s) else None for s in sets], pa.int64()),
        pa.array([keys[i] if len(s) else [] for i, s in zip(at, sets, strict=True)], pa.list_(pa.int64())),
    ], names=["doc_id", "n_shingles", "print_1", "print_2", "bands"])


def signatures(docs: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, n_shingles, print_1, print_2, bands): size and fingerprint of the set, and band keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets, ids, held = [], [], 0
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                sets.append(shingles((text.as_py() or "").encode(), words))
                ids.append(doc_id)
                held += len(sets[-1])
                if held >= CHUNK:
                    yield _flushed(sets, ids, bands, rows)
                    sets, ids, held = [], [], 0
            if sets:
                yield _flushed(sets, ids, bands, rows)

    return docs.mapInArrow(run, "doc_id long, n_shingles long, print_1 long, print_2 long, bands array<long>")


def _incidence(sets: list[np.ndarray], columns: np.ndarray) -> np.ndarray:
    out = np.zeros((len(sets), len(columns)), np.float32)
    for row, s in zip(out, sets, strict=True):
        row[np.searchsorted(columns, s[np.isin(s, columns, assume_unique=True)])] = 1
    return out


def links_between(left: list[np.ndarray], right: list[np.ndarray], percent: int) -> np.ndarray:
    """Truth matrix of 100 * intersection >= percent * union over full sets.

    Intersections are products of incidence matrices over the shingles that both sides hold.
    """
    common = np.intersect1d(np.concatenate(left), np.concatenate(right))
    both = np.zeros((len(left), len(right)), np.float64)
    for k in range(0, len(common), COLUMNS):
        columns = common[k : k + COLUMNS]
        both += _incidence(left, columns) @ _incidence(right, columns).T
    sizes = np.add.outer([len(s) for s in left], [len(s) for s in right])
    return 100 * both >= percent * (sizes - both)


def forest(ids: list[int], linked: np.ndarray, split: int) -> list[tuple[int, int]]:
    """Links that connect what all true links connect; rows of `linked` are ids before `split`, columns ids after it."""
    root = list(range(len(ids)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    out = []
    for i, row in enumerate(linked):
        for j in np.flatnonzero(row).tolist():
            a, b = find(i), find(split + j)
            if a != b:
                root[a] = b
                out.append((ids[i], ids[split + j]))
    return out


def _confirm(words: int, percent: int):
    def run(table: pa.Table) -> pa.Table:
        ids, sides = table.column("id").to_pylist(), table.column("side").to_pylist()
        sets = [shingles(text.as_py().encode(), words) for text in table.column("text")]
        order = sorted(range(len(ids)), key=lambda i: (sides[i], ids[i]))
        ids, sets, left = [ids[i] for i in order], [sets[i] for i in order], sum(s == 0 for s in sides)
        found = []
        if left and left < len(ids):
            found = forest(ids, links_between(sets[:left], sets[left:], percent), left)
        elif left:  # a block with itself
            found = forest(ids, np.triu(links_between(sets, sets, percent), 1), 0)
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    return run


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, n_shingles, class_id, component_id, kept) of every document.

    Two documents are linked when the Jaccard similarity of their sets of word shingles is at least
    `percent` / 100; a component is what links connect. Documents of equal sets are one class, named
    by its smallest doc_id, and only one of them is compared further.

    Banding of MinHash signatures proposes candidates: with 32 bands of 6 rows a pair of similarity
    0.8 is missed once in 50 thousand times, one of 0.85 once in four million. What bands connect is a
    candidate group. All pairs of a group are then confirmed on full sets, in blocks of bounded size:
    a pair of blocks is one task, which multiplies incidence matrices and returns a spanning forest
    of its links, never the pairs. So a group may be of any size and no link is lost to it.

    Words are runs of bytes other than ASCII white space, lower-cased in A-Z. A text with fewer words
    is one shingle of all. A null, empty or blank text has an empty set and is linked with nothing.
    A row without doc_id is returned as its own class and component (null), never linked. Repeated
    doc_ids count as one document if their sets are equal, and are linked through their id
    otherwise. An empty table gives no rows. Other columns are left out.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = settle(signatures(texts, words, bands, rows), SLICE)
    prints = ["print_1", "print_2", "n_shingles"]
    classes = settle(
        signed.where("doc_id IS NOT NULL AND n_shingles > 0").groupBy(*prints).agg(
            F.min("doc_id").alias("id"), F.min_by("bands", "doc_id").alias("bands")
        )
    )
    banded = classes.select("id", F.explode("bands").alias("key"))
    stars = banded.groupBy("key").agg(F.min("id").alias("a"), F.count("*").alias("n")).where("n > 1").select("key", "a")
    groups = settle(components(banded.join(stars, "key").select("a", F.col("id").alias("b"))))
    groups = groups.join(classes.select("id", "n_shingles"), "id")
    blocks = F.ceil(F.greatest(F.sum("n_shingles") / BLOCK, F.count("*") / DOCUMENTS)).cast("int")
    counts = groups.groupBy("component").agg(blocks.alias("blocks"))
    # a document meets its own block once and every other block once
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda other: F.struct(
            F.least(other, F.col("block")).alias("low"), F.greatest(other, F.col("block")).alias("high"), (other < F.col("block")).cast("int").alias("side")
        ),
    )
    members = groups.join(counts, "component").withColumn("block", block)
    held = texts.join(members.select(F.col("id").alias("doc_id"), "component", "block", "blocks"), "doc_id")
    meeting = held.select(F.col("doc_id").alias("id"), "text", "component", "block", F.explode(pairs).alias("pair")).select(
        "id", "text", "component", "pair.low", "pair.high", "pair.side"
    )
    links = meeting.groupBy("component", "low", "high").applyInArrow(_confirm(words, percent), "a long, b long")
    linked = components(settle(links))
    found = signed.join(classes.select(*prints, F.col("id").alias("class_id")), prints, "left")
    found = found.join(linked.select(F.col("id").alias("class_id"), "component"), "class_id", "left")
    own = F.coalesce("component", "class_id", "doc_id")
    return found.select(
        "doc_id", "n_shingles", F.coalesce("class_id", "doc_id").alias("class_id"), own.alias("component_id"),
        F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept"),
    )


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs`, all columns, without near-duplicates: of a component the document of smallest id stays.

    Rows of one doc_id are one document, of which one row stays. Rows without doc_id all stay.
    """
    kept = near_duplicates(docs, words, percent).where("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    # the row as a whole, so that its columns may have any names
    rows = docs.where("doc_id IS NOT NULL").select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text"))
    first = Window.partitionBy("doc_id").orderBy("text")
    named = rows.join(kept, "doc_id", "left_semi").withColumn("n", F.row_number().over(first)).where("n = 1")
    return named.select("row.*").union(docs.where("doc_id IS NULL"))
