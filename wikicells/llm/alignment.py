"""Cross-tokenizer alignment: which tokens of two tokenizers overlap, scored by the documents that show it.

1. Each text is cut where both tokenizers end a token anyway, so that distinct pieces are encoded, and
   their tokens aligned by the ends of both sides, once a task, many at a time.
2. Documents are numbered in blocks. For every linked pair of ids, a block has an inverted posting: a
   compressed bitmap of its documents, and one for each binary digit of the links beyond the first.
3. Postings of parts of a text are OR-merged within the block. Popcounts over all blocks give the
   documents and links of a pair, and so its score.
4. The scores go back along the postings: each block folds them into sums for its documents.

Nothing of the size of the corpus is sent around: a posting is a row for each pair and block.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wikicells.llm.scratch import settle

#: Documents of a block, a multiple of 16.
BLOCK = 4096
#: Postings after which a block is closed.
POSTINGS = 1 << 21
#: Characters of a text that are aligned at a time.
PART = 1 << 20
#: Pieces that a task remembers, and the length up to which it does.
REMEMBERED = 1 << 19
LONGEST = 64
#: A pair in one number: A's id, then B's id in so many bits.
BITS = 24

#: Both tokenizers begin a token at a single space between two characters that are no white space.
#: Python's white space includes all of the tokenizers', so this cuts nowhere else.
CUT = re.compile(r"(?<=\S) (?=\S)")

_ROW = (
    "block long, slot int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "a int, b int, plane int, n long, docs binary"
)


def byte_level(vocabulary: dict[str, int]) -> list[bytes]:
    """Bytes of every token of a byte-level vocabulary: printable bytes stand for themselves, the
    others, in order, for the characters from 256 on."""
    plain = [b for b in range(256) if chr(b).isprintable() and b != 32 and b != 0xAD]
    letter = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    out = [b""] * (max(vocabulary.values(), default=-1) + 1)
    for token, i in vocabulary.items():
        out[i] = bytes(letter[c] for c in token) if all(c in letter for c in token) else token.encode()
    return out


class Aligner:
    """Tokens of texts and their alignment. The alignment of distinct pieces is remembered up to a bound."""

    def __init__(self, byte_json: bytes, piece_model: bytes) -> None:
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_str(byte_json.decode())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        self.bytes_a = byte_level(self.a.get_vocab(with_added_tokens=True))
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode() for i, piece in enumerate(pieces)
        ]
        self.length_a, self.length_b = (np.array([len(x) for x in spelled]) for spelled in (self.bytes_a, self.bytes_b))
        # ids as text, with what follows them within a group and at the end of its A or B side
        self.shown = [
            f"{i}{end}".encode() for n, last in ((len(self.bytes_a), "|"), (len(self.bytes_b), ";")) for i in range(n) for end in (",", last)
        ]
        self.length_shown = np.array([len(x) for x in self.shown])
        self.known: dict[str, tuple[bytes, bytes, int, int]] = {}

    def _tokens(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both tokenizers for a space and the text, or none if they do not spell it."""
        a = self.a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids  # without offsets
        b, raw = self.b.encode(text), (" " + text).encode()
        if b"".join(map(self.bytes_a.__getitem__, a)) != raw or b"".join(map(self.bytes_b.__getitem__, b)) != raw:
            return None
        return np.array(a, np.int32), np.array(b, np.int32)

    def _learn(self, pieces: list[str]) -> dict[str, tuple[bytes, bytes, int, int] | None]:
        """Alignment of pieces. Those without white space at an end are encoded as one text and cut apart again."""
        plain = [piece for piece in pieces if piece and not piece[0].isspace() and not piece[-1].isspace()]
        tokens, found = self._tokens(" ".join(plain)) if plain else None, {}
        if tokens:
            found = dict(zip(plain, self.align(*tokens, np.cumsum([len(piece.encode()) + 1 for piece in plain])), strict=True))
        for piece in pieces:
            if piece not in found:
                alone = self._tokens(piece)
                found[piece] = self.align(*alone, np.array([len(piece.encode()) + 1]))[0] if alone else None
        return found

    def _pieces(self, pieces: list[str]) -> list[tuple[bytes, bytes, int, int] | None]:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        out = list(map(self.known.get, pieces))
        if None in out:
            fresh = self._learn(list(dict.fromkeys(piece for piece, x in zip(pieces, out, strict=True) if x is None)))
            out = [x or fresh[piece] for piece, x in zip(pieces, out, strict=True)]
            self.known.update((piece, x) for piece, x in fresh.items() if x and len(piece) <= LONGEST)
        return out

    def align(self, a: np.ndarray, b: np.ndarray, cuts: np.ndarray) -> list[tuple[bytes, bytes, int, int]]:
        """(groups as text, links, tokens of A, tokens of B) of every piece of two tokenizations of the same bytes.

        Pieces end at the bytes `cuts`, where both sides end a token. Between two neighbouring ends of
        tokens, of whichever side, lies one link: the pair of the tokens there. Ends that both sides
        have end a group. So a piece has the same groups and links wherever it stands.
        """
        end_a, end_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        ends = np.sort(np.concatenate([end_a, end_b]), kind="stable")
        shared = ends[1:] == ends[:-1]
        both, ends = ends[1:][shared], np.append(ends[:-1][~shared], ends[-1:])
        links = a[np.searchsorted(end_a, ends)].astype(np.int64) << BITS | b[np.searchsorted(end_b, ends)]
        last_a, last_b = np.searchsorted(end_a, both), np.searchsorted(end_b, both)
        code_a, code_b = 2 * a, 2 * (b + len(self.length_a))
        code_a[last_a] += 1
        code_b[last_b] += 1
        tokens_a, tokens_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
        order = np.empty(len(a) + len(b), np.int32)
        order[np.arange(len(a)) + np.repeat(np.cumsum(tokens_b) - tokens_b, tokens_a)] = code_a
        order[np.arange(len(b)) + np.repeat(np.cumsum(tokens_a), tokens_b)] = code_b
        shown, links = b"".join(map(self.shown.__getitem__, order.tolist())), links.tobytes()
        until_a, until_b = np.searchsorted(end_a, cuts) + 1, np.searchsorted(end_b, cuts) + 1
        n_a, n_b = np.diff(until_a, prepend=0).tolist(), np.diff(until_b, prepend=0).tolist()
        at_shown = np.cumsum(self.length_shown[order])[until_a + until_b - 1].tolist()
        at_links = (8 * (np.searchsorted(ends, cuts) + 1)).tolist()
        return [
            (shown[low : high - 1], links[first:last], x, y)
            for low, high, first, last, x, y in zip([0, *at_shown], at_shown, [0, *at_links], at_links, n_a, n_b, strict=False)
        ]

    def text(self, text: str) -> tuple[np.ndarray, str, list[tuple[np.ndarray, np.ndarray]]]:
        """((n_a, n_b, n_groups), digest of the groups, (pairs, links of each) of every part of the text)."""
        counts, digest, parts, at = np.zeros(3, np.int64), hashlib.sha256(), [], 0
        while at < len(text):
            end = CUT.search(text, at + PART)
            found = self._pieces(CUT.split(text[at : end.start() if end else len(text)]))
            if None in found:
                return np.zeros(3, np.int64), "", []
            shown, links, n_a, n_b = zip(*found, strict=True)
            shown = b";".join(shown)
            digest.update(b";" + shown if at else shown)
            counts += sum(n_a), sum(n_b), shown.count(b"|")
            parts.append(np.unique(np.frombuffer(b"".join(links), np.int64), return_counts=True))
            at = end.end() if end else len(text)
        return counts, digest.hexdigest() if parts else "", parts


def packed(slots: np.ndarray, starts: np.ndarray) -> pa.Array:
    """Compressed bitmaps of the slots of each run: 16-bit numbers of few documents, bits of many."""
    sizes = np.diff(np.append(starts, len(slots)))
    dense = sizes >= BLOCK // 16
    width = np.where(dense, BLOCK // 8, 2 * sizes)
    offsets = np.concatenate([[0], np.cumsum(width)])
    owner = np.repeat(np.arange(len(starts)), sizes)
    data, many = np.zeros(offsets[-1], np.uint8), dense[owner]
    few = np.flatnonzero(~many)
    at = offsets[owner[few]] + 2 * (few - starts[owner[few]])
    data[at], data[at + 1] = slots[few] & 255, slots[few] >> 8
    bits = slots[many]
    np.bitwise_or.at(data, offsets[owner[many]] + (bits >> 3), (1 << (bits & 7)).astype(np.uint8))
    return pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)]).cast(pa.binary())


def unpacked(bitmaps: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bitmap, slot) of every document in the bitmaps."""
    bitmaps = bitmaps.cast(pa.large_binary())
    offsets = np.frombuffer(bitmaps.buffers()[1], np.int64)[bitmaps.offset : bitmaps.offset + len(bitmaps) + 1]
    data = np.frombuffer(bitmaps.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]] if len(bitmaps) else np.zeros(0, np.uint8)
    width = np.diff(offsets)
    dense = width == BLOCK // 8
    many = np.repeat(dense, width)
    few_owner = np.repeat(np.flatnonzero(~dense), width[~dense] // 2)
    bits = np.unpackbits(data[many].reshape(-1, BLOCK // 8), axis=1, bitorder="little") if dense.any() else np.zeros((0, BLOCK), np.uint8)
    row, slot = np.nonzero(bits)
    return np.concatenate([few_owner, np.flatnonzero(dense)[row]]), np.concatenate([data[~many].view("<u2").astype(np.int64), slot])


def postings(slots: np.ndarray, codes: np.ndarray, links: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, pa.Array]]:
    """(plane, pairs, documents of each, their bitmap): plane -1 has all documents of a pair, plane p
    those with the p-th binary digit in their number of links beyond the first.

    Parts of one document come in any order: their bitmaps are OR-merged, their links added.
    """
    order = np.lexsort((slots, codes))
    slots, codes, links = slots[order], codes[order], links[order]
    first = np.flatnonzero((np.diff(codes, prepend=-1) != 0) | (np.diff(slots, prepend=-1) != 0))
    slots, codes, links = slots[first], codes[first], np.add.reduceat(links, first) - 1 if len(first) else links
    for plane in range(-1, int(links.max(initial=0)).bit_length()):
        chosen = (links >> plane) & 1 == 1 if plane >= 0 else np.ones(len(codes), bool)
        if chosen.any():
            pairs = codes[chosen]
            starts = np.flatnonzero(np.diff(pairs, prepend=-1))
            yield plane, pairs[starts], np.diff(np.append(starts, len(pairs))), packed(slots[chosen], starts)


class _Block:
    """Documents of a block on their way to rows."""

    def __init__(self, number: int) -> None:
        self.number, self.docs, self.parts, self.size = number, [], [], 0

    def add(self, doc_id: int | None, counts: np.ndarray, digest: str, parts: list[tuple[np.ndarray, np.ndarray]]) -> None:
        slot = len(self.docs)
        self.docs.append((doc_id, *counts.tolist(), sum(int(links.sum()) for _, links in parts), digest))
        self.parts += [(np.full(len(codes), slot), codes, links) for codes, links in parts]
        self.size += sum(len(codes) for codes, _ in parts)

    def rows(self) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(field.split()[0], _TYPES[field.split()[1]]) for field in _ROW.split(", ")])

        def batch(size: int, **columns: pa.Array) -> pa.RecordBatch:
            columns["block"] = pa.array(np.full(size, self.number), pa.int64())
            return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(size, f.type)) for f in schema], schema=schema)

        if self.docs:
            names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
            found = {name: pa.array(x, schema.field(name).type) for name, x in zip(names, zip(*self.docs, strict=True), strict=True)}
            yield batch(len(self.docs), slot=pa.array(range(len(self.docs)), pa.int32()), **found)
        if self.parts:
            for plane, pairs, n, docs in postings(*(np.concatenate(x) for x in zip(*self.parts, strict=True))):
                yield batch(
                    len(pairs), a=pa.array(pairs >> BITS, pa.int32()), b=pa.array(pairs & ((1 << BITS) - 1), pa.int32()),
                    plane=pa.array(np.full(len(pairs), plane), pa.int32()), n=pa.array(n, pa.int64()), docs=docs,
                )


_TYPES = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}


def index(docs: DataFrame, byte_path: str, piece_path: str) -> tuple[DataFrame, DataFrame]:
    """Documents with their block and slot, and the postings (a, b, block, plane, n, docs), both settled."""
    with open(byte_path, "rb") as one, open(piece_path, "rb") as other:
        models = docs.sparkSession.sparkContext.broadcast((one.read(), other.read()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, number = Aligner(*models.value), TaskContext.get().partitionId() << 32
        block = _Block(number)
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                block.add(doc_id, *aligner.text(text.as_py() or ""))
                if len(block.docs) >= BLOCK or block.size >= POSTINGS:
                    yield from block.rows()
                    number += 1
                    block = _Block(number)
        yield from block.rows()

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = settle(texts.mapInArrow(run, _ROW), 512)
    return (
        found.where("plane IS NULL").select("block", "slot", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"),
        found.where("plane IS NOT NULL").select("a", "b", "block", "plane", "n", "docs"),
    )


def pair_scores(found: DataFrame) -> DataFrame:
    """(a, b, documents, links, best) of every pair with a posting: popcounts of its bitmaps over all blocks.

    `best` holds for the pairs whose documents are the most that any pair of their A id has, ties
    included. An A id has as many pairs as B has ids at most.
    """
    weight = F.when(F.col("plane") < 0, 1).otherwise(F.call_function("shiftleft", F.lit(1).cast("long"), F.greatest("plane", F.lit(0))))
    counts = found.groupBy("a", "b").agg(
        F.sum(F.when(F.col("plane") < 0, F.col("n"))).alias("documents"), F.sum(F.col("n") * weight).alias("links")
    )
    return counts.withColumn("best", F.col("documents") == F.max("documents").over(Window.partitionBy("a")))


def _fold(table: pa.Table) -> pa.Table:
    """Sums of a block's documents from its postings with their scores."""
    table = table.combine_chunks()
    owner, slot = unpacked(table.column("docs").chunk(0))
    weight = np.left_shift(1, np.maximum(table.column("plane").to_numpy().astype(np.int64), 0))[owner]
    sums = np.zeros((2, BLOCK), np.int64)
    np.add.at(sums[0], slot, weight * table.column("best").to_numpy()[owner])
    np.add.at(sums[1], slot, weight * table.column("documents").to_numpy()[owner])
    seen = np.unique(slot)
    return pa.table({
        "block": pa.array(np.full(len(seen), table.column("block")[0].as_py()), pa.int64()), "slot": pa.array(seen, pa.int32()),
        "n_best": pa.array(sums[0][seen], pa.int64()), "count_sum": pa.array(sums[1][seen], pa.int64()),
    })


def align(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every document.

    A is the byte-level tokenizer in `byte_path`, run on a space and the text, B the piece tokenizer
    in `piece_path`, which adds that space itself; strings of special tokens are plain text. Offsets
    where tokens of both end cut the tokens into groups; overlapping tokens are linked. `count_sum`
    adds, over a document's links, the documents of the corpus that hold the linked pair of ids, and
    `n_best` counts links whose pair has the most documents among those of its A id, ties included.
    `groups_sha256` is the digest of the groups in the form `a1,a2|b1;a3|b2,b3`.

    A text that is null, empty, or not what the tokens of A or of B spell has no tokens: zeros and an
    empty digest. Repeated rows are documents of their own; a null doc_id is carried along. An empty
    table gives no rows. Other columns are left out. Texts are read whole, in parts.
    """
    rows, found = index(docs, byte_path, piece_path)
    scores = settle(pair_scores(found).select("a", "b", "documents", F.col("best").cast("int").alias("best")))
    sums = (
        found.join(scores, ["a", "b"]).select("block", "plane", "docs", "documents", "best")
        .groupBy("block").applyInArrow(_fold, "block long, slot int, n_best long, count_sum long")
    )
    return rows.join(sums, ["block", "slot"], "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", F.lit(0)).alias("n_best"), F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256",
    )


def read_vocabulary(path: str) -> dict[str, int]:
    """Tokens and ids of a byte-level vocabulary file."""
    with open(path, encoding="utf-8") as file:
        return json.load(file)["model"]["vocab"]
