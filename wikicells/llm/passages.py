"""Removal of passages that earlier documents hold, by automata of the recurring ones.

1. Every window of so many words has one anchor, the place of its least gram (GRAM words, least by a
   hash, leftmost of equals), so equal windows have equal anchors. The windows of one anchor start
   next to each other and make a stretch of the text. Grams that only one document holds are done.
2. Confirmed are the windows that two documents hold: stretches that are equal as a whole make a
   class, and where a gram has several classes, their windows are compared, one stretch of each class.
   A class with confirmed windows gives a passage, and for its windows the first document of each.
3. The passages are dealt into shards of bounded size; a task compiles a shard's passages to an
   Aho-Corasick automaton whose letters are words.
4. All stretches of all documents with a gram of step 1 are streamed through the automaton of their
   shard, which locates every occurrence, word by word. Stretches of a very common class are dealt to
   several copies of its passage.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wikicells.llm.scratch import settle

GRAM = 16
#: Bytes of a text that are cut into words, and words whose windows are taken, at a time.
PART = 1 << 21
CHUNK = 1 << 20
#: Texts that a task works on at a time.
SLICE = 512
#: Passages of an automaton, on average.
SHARD = 4096
#: Stretches of a class that go to one copy of its passage, about.
HOT = 1 << 14

_SPACE = b" \t\n\x0b\x0c\r"
_CUT = re.compile(rb"[ \t-\r]")
_SEPARATES = np.isin(np.arange(256), list(_SPACE))
_MULTIPLIER = 0x9E3779B97F4A7C15
_BYTES = np.random.default_rng(11).integers(1, 2**63, 256, np.uint64)
_powers: dict = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse, mod 2^64."""
    if len(_powers.get("up", ())) < n:
        for name, base in (("up", _MULTIPLIER), ("down", pow(_MULTIPLIER, -1, 2**64))):
            table = np.full(1 << max(16, (n - 1).bit_length()), np.uint64(base))
            table[0] = 1
            _powers[name] = np.cumprod(table, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def _sums(values: np.ndarray) -> np.ndarray:
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _power(len(values) + 1)[0][: len(values)], out=out[1:])
    return out


def _hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the values from start to end, the same at every place."""
    x = (sums[end] - sums[start]) * _power(len(sums))[1][start]
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _bounds(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a text."""
    edges = np.diff(_SEPARATES[raw].astype(np.int8), prepend=np.int8(1), append=np.int8(1))
    return np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)


def _pieces(raw: bytes | memoryview) -> Iterator[bytes]:
    """A text in parts that end between words."""
    at = 0
    while at < len(raw):
        end = _CUT.search(raw, at + PART)
        until = end.start() if end else len(raw)
        yield bytes(raw[at:until])
        at = until


def word_hashes(raw: bytes | memoryview) -> np.ndarray:
    out = [np.zeros(0, np.uint64)]
    for piece in _pieces(raw):
        part = np.frombuffer(piece, np.uint8)
        out.append(_hashes(_sums(_BYTES[part]), *_bounds(part)))
    return np.concatenate(out)


def anchors(words: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """(low, high, gram, cover) of each anchor: its windows start from low to high, both included;
    cover is a hash of all that they cover."""
    sums, gram = _sums(words), min(GRAM, window)
    at = np.arange(len(words) - gram + 1)
    grams = _hashes(sums, at, at + gram)
    place = np.lib.stride_tricks.sliding_window_view(grams, window - gram + 1).argmin(1)
    place += np.arange(len(place))
    low = np.flatnonzero(np.diff(place, prepend=-1))
    high = np.append(low[1:], len(place)) - 1
    return low, high, grams[place[low]].astype(np.int64), _hashes(sums, low, high + window).astype(np.int64)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            yield batch.slice(at, SLICE)


_ANCHOR = ("doc", "print", "low", "high", "gram", "cover")


def _find(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            found = []
            for i, text in enumerate(batch.column("text")):
                words = word_hashes(memoryview(text.as_buffer()))
                for begin in range(0, max(0, len(words) - window + 1), CHUNK):
                    low, high, gram, cover = anchors(words[begin : begin + CHUNK + window - 1], window)
                    found.append((np.full(len(low), i), low + begin, high + begin, gram, cover))
            if found:
                row, *columns = (np.concatenate(x) for x in zip(*found, strict=True))
                ids = [batch.column(c).take(pa.array(row)) for c in ("doc", "print")]
                yield pa.RecordBatch.from_arrays([*ids, *map(pa.array, columns)], names=list(_ANCHOR))

    return run


_WANT = ("gram", "cover", "low", "high", "last", "rep", "several", "member")
_STRETCH = "doc long, print long, gram long, cover long, low long, high long, last long, rep boolean, several boolean, member boolean, words binary"


def _cut(window: int):
    """The wanted stretches of each text, their words joined by single spaces."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            rows, wants, stretches = [], [], []
            for row in range(batch.num_rows):
                raw = memoryview(batch.column("text")[row].as_buffer())
                start, end = _bounds(np.frombuffer(raw, np.uint8))
                for want in batch.column("wanted")[row].as_py():
                    rows.append(row)
                    wants.append(tuple(want[c] for c in _WANT))
                    stretches.append(b" ".join(bytes(raw[start[want["low"]] : end[want["high"] + window - 1]]).split()))
            columns = zip(*wants, strict=True) if wants else [()] * len(_WANT)
            types = (*[pa.int64()] * 5, *[pa.bool_()] * 3)
            yield pa.RecordBatch.from_arrays([
                *(batch.column(c).take(pa.array(rows, pa.int64())) for c in ("doc", "print")),
                *(pa.array(x, t) for x, t in zip(columns, types, strict=True)), pa.array(stretches, pa.binary()),
            ], names=["doc", "print", *_WANT, "words"])

    return run


def _listed(window: int):
    """Every window of the stretches, by its hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                counts = pc.subtract(part.column("high"), part.column("low")).to_numpy() + 1
                words = word_hashes(b" ".join(part.column("words").to_pylist()))
                first = np.cumsum(counts + window - 1) - (counts + window - 1)
                owner = np.repeat(np.arange(len(counts)), counts)
                offset = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
                start = first[owner] + offset
                hashes = _hashes(_sums(words), start, start + window).astype(np.int64) if len(start) else start
                columns = [part.column(c).take(pa.array(owner)) for c in ("gram", "cover", "doc", "last")]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(offset, pa.int64()), pa.array(hashes)], names=["gram", "cover", "doc", "last", "at", "hash"]
                )

    return run


def _merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs of window starts, joined where they touch; both ends included."""
    out: list[tuple[int, int]] = []
    for at, until in sorted(runs):
        if out and at <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(until, out[-1][1]))
        else:
            out.append((at, until))
    return out


class Automaton:
    """An Aho-Corasick automaton over words; a passage has runs of windows with their first document."""

    def __init__(self, window: int) -> None:
        self.window, self.letters, self.passages, self.compiled = window, {}, {}, None

    def add(self, words: list[bytes], runs: list[dict]) -> None:
        """The part of the words that the runs cover becomes a passage."""
        low, high = min(r["at"] for r in runs), max(r["until"] for r in runs) + self.window
        key = tuple(self.letters.setdefault(word, len(self.letters) + 1) for word in words[low:high])
        self.passages.setdefault(key, set()).update((r["at"] - low, r["until"] - low, r["first"]) for r in runs)

    def locate(self, words: list[bytes], doc: int) -> list[tuple[int, int]]:
        """(start, end) of the words in windows that a document before `doc` holds."""
        if not self.passages:
            return []
        if self.compiled is None:
            self.compiled = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
            for key, runs in self.passages.items():
                self.compiled.add_word(key, (len(key), sorted(runs)))
            self.compiled.make_automaton()
        text, found = tuple(map(self.letters.get, words, repeat(0))), []
        for end, (length, runs) in self.compiled.iter(text):
            found += [(end + 1 - length + at, end + 1 - length + until) for at, until, first in runs if first < doc]
        return [(at, until + self.window) for at, until in _merged(found)]


_SPAN = "doc long, print long, start long, end long"


def _stream(window: int):
    """Rows come by shard and copy: its passages' runs, the passages' words, then the stretches to search."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, automaton, runs = None, Automaton(window), {}
        for batch in batches:
            spans = []
            columns = (batch.column(c).to_pylist() for c in ("shard", "copy", "kind", "gram", "cover", "doc", "print", "low", "words", "runs"))
            for shard, copy, kind, gram, cover, doc, mark, low, words, of in zip(*columns, strict=True):
                if (shard, copy) != now:
                    now, automaton, runs = (shard, copy), Automaton(window), {}
                if kind == 0:
                    runs[gram, cover] = of
                elif kind == 1:
                    if (gram, cover) in runs:
                        automaton.add(words.split(b" "), runs.pop((gram, cover)))
                else:
                    spans += [(doc, mark, low + start, low + end) for start, end in automaton.locate(words.split(b" "), doc)]
            columns = zip(*spans, strict=True) if spans else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names=["doc", "print", "start", "end"])

    return run


def _texts(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    return docs.select(F.col("doc_id").cast("long").alias("doc"), text.alias("text")).withColumn("print", F.xxhash64("text"))


def repeated_spans(docs: DataFrame, window: int = 50) -> DataFrame:
    """(doc, print, start, end): words of texts in windows that also start in a document of smaller id.

    Spans of a text may touch and overlap. `doc` is doc_id and `print` tells texts of one doc_id apart
    by a hash. Repeated rows, of the same doc_id and text, have their spans once.
    """
    texts = _texts(docs).where("doc IS NOT NULL").where(F.octet_length("text") >= 2 * window - 1)
    key = ["doc", "print"]
    again = settle(texts.groupBy(*key).count().where("count > 1").select(*key))
    texts = texts.join(again, key, "left_anti").union(texts.join(again, key, "left_semi").dropDuplicates(key))

    found = settle(texts.select("doc", "print", "text").mapInArrow(_find(window), ", ".join(f"{c} long" for c in _ANCHOR)), SLICE)
    often = found.groupBy("gram").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).where("least < most")
    # settled counts are joined anew, so that Spark can split a gram that is very common
    found = settle(found.join(settle(often.select("gram", "least")), "gram"))
    one = F.min(F.struct("doc", "print", "low", "high")).alias("one")
    classes = settle(found.groupBy("gram", "cover").agg(one, F.max("doc").alias("last"), F.count("*").alias("members")))
    several = settle(classes.groupBy("gram").count().where("count > 1").select("gram", F.lit(True).alias("several")))

    # one stretch of each class, and all that a smaller document may hold
    marked = found.join(classes.select("gram", "cover", "one", "last"), ["gram", "cover"]).join(several, "gram", "left").select(
        *_ANCHOR, "last", (F.struct("doc", "print", "low", "high") == F.col("one")).alias("rep"),
        F.coalesce("several", F.lit(False)).alias("several"), (F.col("doc") > F.col("least")).alias("member"),
    ).where("rep OR member")
    wanted = marked.groupBy(*key).agg(F.collect_list(F.struct(*_WANT)).alias("wanted"))
    stretches = settle(texts.join(wanted, key).select("doc", "print", "text", "wanted").mapInArrow(_cut(window), _STRETCH), SLICE)

    listed = stretches.where("rep AND several").select("gram", "cover", "doc", "last", "low", "high", "words").mapInArrow(
        _listed(window), "gram long, cover long, doc long, last long, at long, hash long"
    )
    firsts = settle(
        listed.groupBy("gram", "hash").agg(F.min("doc").alias("first"), F.max("last").alias("most")).where("first < most").select("gram", "hash", "first")
    )
    confirmed = listed.join(firsts, ["gram", "hash"]).where("first < last").groupBy("gram", "cover").agg(
        F.collect_list(F.struct("at", F.col("at").alias("until"), "first")).alias("runs")
    )
    whole = classes.join(several, "gram", "left_anti").where(F.col("one.doc") < F.col("last")).select(
        "gram", "cover",
        F.array(F.struct(F.lit(0).cast("long").alias("at"), (F.col("one.high") - F.col("one.low")).alias("until"), F.col("one.doc").alias("first"))).alias("runs"),
    )
    passages = settle(confirmed.union(whole))
    hot = settle(classes.where(F.col("members") > HOT).select("gram", "cover", F.ceil(F.col("members") / HOT).alias("copies")))

    shards = 1 + passages.count() // SHARD
    shard = F.pmod(F.xxhash64("gram", "cover"), F.lit(shards)).alias("shard")
    copies, all_copies = F.coalesce("copies", F.lit(1)), F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("copies", F.lit(1)) - 1)).alias("copy")
    no_id, no_words = [F.lit(None).cast("long").alias(c) for c in ("doc", "print", "low")], F.lit(None).cast("binary").alias("words")
    no_runs = F.lit(None).cast("array<struct<at:bigint,until:bigint,first:bigint>>").alias("runs")
    dealt = stretches.join(hot, ["gram", "cover"], "left")
    rows = (
        passages.join(hot, ["gram", "cover"], "left").select(shard, all_copies, F.lit(0).alias("kind"), "gram", "cover", *no_id, no_words, "runs")
        .union(dealt.where("rep").select(shard, all_copies, F.lit(1), "gram", "cover", *no_id, "words", no_runs))
        .union(dealt.where("member").select(
            shard, F.pmod(F.xxhash64("doc", "print", "low"), copies), F.lit(2), "gram", "cover", "doc", "print", "low", "words", no_runs
        ))
    )
    rows = rows.repartition("shard", "copy").sortWithinPartitions("shard", "copy", "kind")
    return rows.mapInArrow(_stream(window), _SPAN)


def without_passages(docs: DataFrame, window: int = 50) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of every document; `kept` are the words that are left, joined by single spaces.

    Words are what lies between the six white-space characters of ASCII. A word goes that lies in a
    window of `window` words whose sequence also starts in a document of smaller doc_id; all is judged
    on the input. Rows of one doc_id do not remove each other's words. A null doc_id is neither
    smaller nor larger than another: such rows are kept whole. A null text has no words, and texts
    shorter than the window stay. Repeated rows give repeated rows, an empty table none; other columns
    are left out.
    """
    spans = repeated_spans(docs, window).groupBy("doc", "print").agg(F.collect_list(F.struct("start", "end")).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            out = []
            for i in range(batch.num_rows):
                raw, spans = memoryview(batch.column("text")[i].as_buffer()), batch.column("spans")[i].as_py() or []
                n, removed, kept = 0, 0, []
                edges = [edge for start, last in _merged([(s["start"], s["end"] - 1) for s in spans]) for edge in (start, last + 1)]
                edges = np.array(edges, np.int64)
                for piece in _pieces(raw):
                    words = piece.split()
                    if len(edges):
                        gone = np.searchsorted(edges, np.arange(n, n + len(words)), "right") % 2 == 1
                        removed += int(gone.sum())
                        kept.append(b" ".join([word for word, g in zip(words, gone.tolist(), strict=True) if not g]))
                    else:
                        kept.append(b" ".join(words))
                    n += len(words)
                out.append((n, removed, b" ".join(filter(None, kept))))
            n_words, n_removed, kept = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([
                batch.column("doc"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()),
            ], names=["doc_id", "n_words", "n_removed", "kept"])

    rows = _texts(docs).join(spans, ["doc", "print"], "left").select("doc", "text", "spans").mapInArrow(
        run, "doc_id long, n_words long, n_removed long, kept binary"
    )
    return rows.withColumn("kept", F.col("kept").cast("string"))
