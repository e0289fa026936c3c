"""Toxicity: Levenshtein automata over the trie of a learned lexicon, judged in context."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wikicells.llm.scratch import settle

#: Labelled documents of each class from which lexicon and weights are learned, at most.
SAMPLE = 12_000
#: Toxic documents that hold an entry, at least, whatever the size of the sample.
LEAST = 3
#: Lengths of word starts that can be entries.
STEMS = (3, 4, 5, 6, 7, 8)
#: Words before and after a hit that are its context.
WINDOW = 25
#: Words that a worker remembers, and moves of its automaton.
REMEMBERED = 1 << 18

WORD = re.compile(r"[^\W_]+")
# Quotations of any length within a paragraph. A mark that opens again ends the search, so the time is linear.
QUOTED = re.compile(r'"[^"\n]++"|“[^“”\n]++”|„[^„“”\n]++[“”]|«[^«»\n]++»|^>[^\n]*', re.M)
PLAIN, MISSPELLED, QUOTATION = range(3)


def allowed(entry: str) -> int:
    """Edits within which a word still counts as the entry, or its beginning as the word start, which `*` marks."""
    letters = len(entry.rstrip("*"))
    return 0 if letters < 5 else 1 if letters < 9 else 2


@dataclass
class Automaton:
    """The Levenshtein automata of all entries at once, as a deterministic one over their trie.

    A state is a set of (trie node, edits so far). Moves are computed when first taken.
    """
    entries: list[str]
    children: list[dict[str, int]] = field(default_factory=lambda: [{}])
    word: dict[int, int] = field(default_factory=dict)
    stem: dict[int, int] = field(default_factory=dict)
    most: list[int] = field(default_factory=lambda: [0])

    def __post_init__(self) -> None:
        for number, entry in enumerate(self.entries):
            node = 0
            self.most[0] = max(self.most[0], allowed(entry))
            for letter in entry.rstrip("*"):
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.most.append(0)
                node = self.children[node][letter]
                self.most[node] = max(self.most[node], allowed(entry))
            (self.stem if entry.endswith("*") else self.word)[node] = number
        self.letters = {letter for node in self.children for letter in node}
        self.forget()

    def forget(self) -> None:
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.ends: list[tuple[int, int] | None] = []
        self.starts: list[tuple[int, int] | None] = []
        self.known: dict[str, tuple[int, int] | None] = {}
        self.first = self._state({0: 0})

    def _state(self, nodes: dict[int, int]) -> int:
        """Number of the state of these nodes and edits, after letters left out; -1 if none is left."""
        todo = list(nodes.items())
        for node, edits in todo:  # grows
            for child in self.children[node].values():
                if edits < self.most[child] and edits + 1 < nodes.get(child, 9):
                    nodes[child] = edits + 1
                    todo.append((child, edits + 1))
        if not nodes:
            return -1
        key = frozenset(nodes.items())
        if key not in self.states:
            self.states[key] = len(self.moves)
            self.sets.append(key)
            self.moves.append({})
            hits = [(e, self.word[n]) for n, e in nodes.items() if n in self.word and e <= allowed(self.entries[self.word[n]])]
            self.ends.append(min(hits, default=None))
            begun = [(e, self.stem[n]) for n, e in nodes.items() if n in self.stem and e <= allowed(self.entries[self.stem[n]])]
            self.starts.append(min(begun, default=None))
        return self.states[key]

    def _move(self, state: int, letter: str) -> int:
        nodes: dict[int, int] = {}
        for node, edits in self.sets[state]:
            if edits < self.most[node]:  # a letter too many
                nodes[node] = min(nodes.get(node, 9), edits + 1)
            for other, child in self.children[node].items():
                cost = edits + (other != letter)
                if cost <= self.most[child]:
                    nodes[child] = min(nodes.get(child, 9), cost)
        return self._state(nodes)

    def match(self, word: str) -> tuple[int, int] | None:
        """(edits, entry) of the nearest entry, or None.

        A word goes before a start, unless only the start is there without edits. Of starts with
        equal edits the one goes first that ends first.
        """
        if word in self.known:
            return self.known[word]
        if len(self.known) >= REMEMBERED or len(self.moves) >= REMEMBERED:
            self.forget()
        state, start = self.first, None
        for letter in word:
            letter = letter if letter in self.letters else ""
            after = self.moves[state].get(letter)
            if after is None:
                after = self.moves[state][letter] = self._move(state, letter)
            state = after
            if state < 0:
                break
            if (begun := self.starts[state]) is not None and (start is None or begun[0] < start[0]):
                start = begun
        hit = self.ends[state] if state >= 0 else None
        if start is not None and (hit is None or start[0] == 0 < hit[0]):
            hit = start
        self.known[word] = hit
        return hit


def hits(text: str, automaton: Automaton) -> list[tuple[int, int, int]]:
    """(entry, kind, place in words) of each lexicon word; what stands in quotation marks or a quoted line is quotation."""
    lower = text.lower()
    words = WORD.findall(lower)
    match = automaton.match
    found = {w: hit for w in set(words) if (hit := match(w))}
    if not found:
        return []
    quoted = [m.span() for m in QUOTED.finditer(lower)]
    out = []
    for place, m in enumerate(WORD.finditer(lower)):
        if hit := found.get(m.group()):
            inside = any(a <= m.start() < b for a, b in quoted)
            out.append((hit[1], QUOTATION if inside else MISSPELLED if hit[0] else PLAIN, place))
    return out


@dataclass
class Model:
    """Entries, their weights by kind of hit, and the logistic weights of a document's features."""
    entries: list[str]
    weights: np.ndarray
    logistic: np.ndarray

    def features(self, found: Iterable[tuple[int, int, int]]) -> list[float]:
        """1, evidence (each entry by its weightiest hit), its logarithm, and the evidence of the densest context window."""
        most: dict[int, float] = defaultdict(float)
        places = []
        for entry, kind, place in found:
            weight = self.weights[entry, kind]
            most[entry] = max(most[entry], weight)
            places.append((place, weight))
        evidence, dense, left, running = sum(most.values()), 0.0, 0, 0.0
        for place, weight in places:
            running += weight
            while places[left][0] < place - 2 * WINDOW:
                running -= places[left][1]
                left += 1
            dense = max(dense, running)
        return [1.0, evidence, float(np.log1p(evidence)), float(np.log1p(max(dense, 0.0)))]

    def score(self, found: Iterable[tuple[int, int, int]]) -> float:
        return float(1 / (1 + np.exp(-np.clip(np.dot(self.logistic, self.features(found)), -500, 500))))


def held_out(doc_id):
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def training_texts(docs: DataFrame, labels: DataFrame, sample: int) -> tuple[DataFrame, dict[int, int]]:
    """(text, toxic) of at most `sample` labelled documents a class, none held out, and all such labels' counts.

    The sample is that of the least hashes of doc_id. Equal texts of one label count as one, so that
    many copies of a text do not count as many.
    """
    known = labels.where(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max("toxic").cast("int").alias("toxic")
    )
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    order = F.xxhash64("doc_id")
    chosen = [known.where(F.col("toxic") == t).orderBy(order, "doc_id").limit(sample) for t in (0, 1)]
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.join(F.broadcast(chosen[0].union(chosen[1])), "doc_id").where("text IS NOT NULL")
    return settle(texts.select("text", "toxic").distinct()), counts


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = (Counter(), Counter())
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
            words = {w for w in WORD.findall(text.lower()) if len(w) > 2}
            counts[toxic].update(words)
            counts[toxic].update({f"{w[:n]}*" for w in words for n in STEMS if len(w) > n})
        terms = list(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(terms, pa.string()), *(pa.array([c[t] for t in terms], pa.int64()) for c in counts)], names=["term", "clean", "toxic"]
        )


def _lexicon(terms: list[str]) -> list[str]:
    """All terms, the surest first, without word starts that begin with one taken before or are the start of a term taken before.

    A word stays beside a start that covers it, as its end may be misspelled, too.
    """
    taken: list[str] = []
    starts: set[str] = set()
    inner: set[str] = set()
    for term in terms:
        text = term.rstrip("*")
        if not term.endswith("*") or not (text in inner or any(text[:n] in starts for n in STEMS)):
            taken.append(term)
            inner.update(text[:n] for n in STEMS)
            if term.endswith("*"):
                starts.add(text)
    return taken


def _threes(flat: list[int]) -> list[tuple[int, int, int]]:
    """Hits from their numbers in a row."""
    return list(zip(*[iter(flat)] * 3, strict=True))


def _fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps, with a small ridge. A step that would raise the loss is halved until it does not."""
    def loss(w: np.ndarray) -> float:
        z = np.clip(x @ w, -500, 500)
        return float(weight @ (np.logaddexp(0, z) - y * z) + 0.05 * w @ w)

    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        slope = x.T @ (weight * (p - y)) + 0.1 * w
        curve = (x.T * (weight * np.maximum(p * (1 - p), 1e-6))) @ x + 0.1 * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        move, most = np.clip(step, -5, 5), loss(w) * (1 + 1e-9)
        while loss(w - move) > most and np.abs(step).max() >= 1e-6:
            step = move = step / 2
        w -= move
        if np.abs(step).max() < 1e-6:
            break
    return w


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learns lexicon and weights from labelled documents that are not held out.

    Entries are words, and starts of words, that are surely commoner in toxic documents (the lower
    bound of the log odds ratio), in `LEAST` toxic documents or more at any size of the sample; all
    of them are taken, so their number is bounded by the texts of the sample. Of the sample the
    driver gets counts of each entry and the features of each document. A misspelled hit weighs half as much as the entry, a quoted one nothing, unless the sample says
    otherwise.
    """
    texts, counts = training_texts(docs, labels, sample)
    terms = texts.mapInArrow(_terms, "term string, clean long, toxic long").groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    sizes = {r["toxic"]: r["count"] for r in texts.groupBy("toxic").count().collect()}
    clean, toxic = sizes.get(0, 0), sizes.get(1, 0)
    if not clean or not toxic:
        return Model([], np.zeros((0, 3)), np.array([-3.0 if not toxic else 3.0, 0, 0, 0]))
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1) / ((F.col("clean") + 0.5) / (clean + 1)))
    sure = odds - 1.64 * F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    rows = terms.where(F.col("toxic") >= LEAST).withColumn("sure", sure).where("sure > 2")
    # of a word and its starts that say the same, the word goes first
    order = [F.desc("sure"), F.col("term").endswith("*"), F.length("term").desc(), "term"]
    entries = _lexicon([r["term"] for r in rows.orderBy(*order).select("term").collect()])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(entries)
        for batch in batches:
            flat = [[x for hit in hits(t, automaton) for x in hit] for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(flat, pa.list_(pa.int32()))], names=["toxic", "hits"])

    # the exact hits of a word are told of the start that covers it, too
    number = {e: n for n, e in enumerate(entries)}
    covering = {n: number[f"{e[:k]}*"] for n, e in enumerate(entries) if not e.endswith("*") for k in STEMS if len(e) > k and f"{e[:k]}*" in number}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter = Counter()
            for label, flat in zip(batch.column("toxic").to_pylist(), batch.column("hits").to_pylist(), strict=True):
                pairs = {(e, k) for e, k, _ in _threes(flat)}
                pairs |= {(covering[e], k) for e, k in pairs if e in covering and k != MISSPELLED}
                counts.update((label, e, k) for e, k in pairs)
            columns = zip(*counts) if counts else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int32()) for c in columns), pa.array(list(counts.values()), pa.int64())], names=["toxic", "entry", "kind", "n"]
            )

    found = settle(texts.mapInArrow(find, "toxic int, hits array<int>"))
    seen = np.zeros((2, len(entries), 3))
    for r in found.mapInArrow(count, "toxic int, entry int, kind int, n long").groupBy("toxic", "entry", "kind").agg(F.sum("n").alias("n")).collect():
        seen[r["toxic"], r["entry"], r["kind"]] = r["n"]
    rate = (seen[1] + 0.5) / (toxic + 1) / ((seen[0] + 0.5) / (clean + 1))
    rate *= np.exp(-np.sqrt(1 / (seen[1] + 0.5) + 1 / (seen[0] + 0.5)))
    believed = np.stack([rate[:, PLAIN], np.sqrt(rate[:, PLAIN]), np.ones(len(entries))], axis=1)
    ratio = (seen[1] / toxic + believed / clean) / (seen[0] / clean + 1 / clean)
    weights = np.maximum(np.log(np.where(np.arange(3) == PLAIN, rate, ratio)), 0)
    model = Model(entries, weights, np.zeros(4))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.array([model.features(_threes(flat)) for flat in batch.column("hits").to_pylist()]).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays([batch.column("toxic").cast(pa.float64()), *(pa.array(c) for c in out.T)], names=["toxic", "one", "all", "log", "dense"])

    # sorted, so that sums of floats do not hang on the order in which tasks end
    table = np.array(sorted(found.mapInArrow(features, "toxic double, one double, all double, log double, dense double").collect()))
    x, y = table[:, 1:], table[:, 0]
    model.logistic = _fit(x, y, np.where(y == 1, counts[1] / toxic, counts[0] / clean))
    return model


def score(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """(doc_id, score, predicted, n_plain, n_misspelled, n_quoted) of every document, from its text alone.

    Whole texts are scored. A null or empty text, as any without hits, gets the base score. Repeated
    rows are scored each, a null doc_id is carried along, an empty table gives no rows, other columns
    are left out.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(model.entries)
        for batch in batches:
            out = []
            for text in batch.column("text"):
                found = hits(text.as_py() or "", automaton)
                kinds = Counter(kind for _, kind, _ in found)
                out.append((model.score(found), kinds[PLAIN], kinds[MISSPELLED], kinds[QUOTATION]))
            scores, *kinds = zip(*out, strict=True) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64()), *(pa.array(k, pa.int64()) for k in kinds)],
                names=["doc_id", "score", "n_plain", "n_misspelled", "n_quoted"],
            )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = texts.mapInArrow(run, "doc_id long, score double, n_plain long, n_misspelled long, n_quoted long")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def without_toxic(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """The rows of `docs`, all columns, whose text scores below `threshold`; null and empty texts get the base score."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(model.entries)
        for batch in batches:
            yield batch.filter(pa.array([model.score(hits(t.as_py() or "", automaton)) < threshold for t in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
