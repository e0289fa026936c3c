"""Secret scans: patterns, and literals that source or configuration assigns to sensitive names."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "named")
#: Documents that a task reads at a time.
SLICE = 256

# The base kinds. Each is matched leftmost and without overlap; a match that is too short is dropped.
ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
#: A text without any of these, in lower case, has no match of ASSIGN.
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

# Lexing. An assignment is found by its operator: the target ends before it, the value starts after it. No name or value has a largest length;
# possessive loops keep the time linear, as between two marks of a kind each character is read once.
OPERATOR = re.compile(r"(?::=|=>|[:=])(?![:=/~])")
# What stands before an operator, from right to left: a type annotation, a quotation mark, an index, the name.
TARGET = re.compile(r"""[ \t]*+(?:[\w.<>\[\]]++[ \t]*+:[ \t]*+)?(?:["']\\*+)?(?:\]["']([\w.-]+)["']\[)?([\w$.>-]*[A-Za-z_$])""", re.A)
# Further names of a tuple, from right to left, and what may stand before all of them.
FURTHER = re.compile(r"[ \t]*+,[ \t]*+([\w$.]+)", re.A)
DECLARED = re.compile(r"[ \t]*+(?:(?:rav|tel|tsnoc|lacol)[ \t]*+)?$")
SPACE = re.compile(r"[ \t]*+(?:\\\r?\n[ \t]*+)*+")
# What may stand around a quoted literal: a bracket, or a call that makes a string of it.
AROUND = re.compile(r"""(?:(?:new[ \t]+)?(?:String|SecureString|SecretStr|Secret|str|bytes))?\(\s*+(?=[rbuf]{0,2}["'`])""")
# Key material in PEM form may go over several lines, as text in three marks may.
QUOTED = re.compile(
    r"""[rbuf]{0,2}(?:"{3}((?:[^"\\]++|\\.|"(?!""))*+)"{3}|'{3}((?:[^'\\]++|\\.|'(?!''))*+)'{3}"""
    r'''|\\++"([^"\\\n]++)\\++"'''
    r"""|"((?:[^"\\\n]++|\\.)*+|\s*+-----BEGIN\x20(?:[^"\\]++|\\.)*+)"|'((?:[^'\\\n]++|\\.)*+|\s*+-----BEGIN\x20(?:[^'\\]++|\\.)*+)'"""
    r"""|`((?:[^`\\\n]++|\\.)*+|\s*+-----BEGIN\x20(?:[^`\\]++|\\.)*+)`)""", re.I | re.A | re.S,
)
NAME = re.compile(r"[A-Za-z_$][\w$]*+(?:\.[A-Za-z_]\w*+)*+(?![\w$.(\[/+=-])", re.A)
BARE = re.compile(r"""[^\s"'`,;(){}\[\]<>#|]++""")
JOIN = re.compile(r"[ \t]*+(?:\\?\r?\n[ \t]*+)?(?:\+|\.\.|\.)[ \t]*+(?:\\?\r?\n[ \t]*+)?(?=[\"'`A-Za-z_$])")
COMMA = re.compile(r"[ \t]*+,[ \t]*+")
# A value on the lines after its name: whole key material, or one line that is no assignment itself.
BELOW = re.compile(r"(?:[|>][-+0-9]*+[ \t]*+)?\r?\n[ \t]++")
LINE = re.compile(r"""(?![\w.-]++(?:=>|:=|[:=](?:[^=\s]|\s|$)))[^\s"'`,;(){}\[\]<>#|]++(?=[ \t]*+(?:\r?\n|$))""")
MATERIAL = re.compile(r"-----BEGIN\x20[A-Z0-9\x20]++-----(?:[^-]++|-(?!----))*+-----END\x20[A-Z0-9\x20]++-----")
# Assignments without an operator: arguments of a call, elements, attributes beside a name, options of a command.
ARGUMENT = re.compile(r"""\(\s*+\\*+["']([\w.-]++)\\*+["']\s*+,\s*+""", re.A)
ELEMENT = re.compile(r"""<([A-Za-z][\w.:-]*+)(?:\s[^<>]*+)?>\s*+["']?([^<>"'\s]++)["']?\s*+</""", re.A)
ATTRIBUTE = re.compile(r"""\b(?:key|name|id)\s*+=\s*+["']([\w.:-]++)["']\s++value\s*+=\s*+["']([^"'<>]++)["']""", re.A)
OPTION = re.compile(r"(?<![\w-])--([A-Za-z][\w-]*+)[ \t]++(?!-)", re.A)
#: How much the words of a target name tell of a secret.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "pw": 0.9, "secret": 1.0, "token": 0.9, "apikey": 1.0,
    "credential": 0.9, "credentials": 0.9, "privatekey": 1.0, "accesskey": 1.0, "secretkey": 1.0, "authkey": 0.9,
    "bearer": 0.9, "pass": 0.7, "auth": 0.6, "key": 0.6, "salt": 0.6, "signature": 0.5,
}
#: Pairs of words that tell more together.
PAIRS = {("api", "key"), ("access", "key"), ("private", "key"), ("secret", "key"), ("auth", "key"), ("encryption", "key"), ("signing", "key")}
#: Last words of names that hold something about a secret, or something public.
HARMLESS = {
    "count", "field", "file", "filename", "header", "hint", "id", "label", "length", "limit", "max", "min", "name", "path",
    "placeholder", "policy", "prompt", "public", "regex", "size", "type", "url",
}
#: Values that stand for a secret without being one: by how they begin, by what they mention, or as a whole.
BEGINS = re.compile(r"(?i)(?:your|my|some|the)[-_ ]|[<$%{]")
MENTIONS = re.compile(r"(?i)example|changeme|change[-_]me|placeholder|redacted")
STANDS = re.compile(r"(?i)(?:none|null|true|false|undefined|test|dummy|todo)$")
#: Characters at the ends of a value that are kept to judge joined values; no match of the patterns above is longer.
EDGE = 16
#: Sizes of joined values beyond this are kept in proportion, as a name joined to itself doubles.
LARGE = 1 << 60
#: The armour of key material, and the line breaks in it.
ARMOUR = re.compile(r"-----(?:BEGIN|END)\x20([A-Z0-9\x20]+)-----|\\[nr]|\s+")
#: What armour says of material that is no secret.
OPEN = ("PUBLIC", "CERTIFICATE", "PARAMETERS")
#: Characters other than blanks that a passphrase has, at least.
PHRASE = 12
#: What a name must tell at least for a value with blanks to be a passphrase; `key` and `auth` also name texts.
SURE = 0.9
#: Words of sentences about secrets, which are no secrets.
ABOUT = {"enter", "please", "invalid", "required", "must", "your", "forgot", "reset", "confirm", "is", "are", "cannot", "should"}
PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")


@dataclass(frozen=True)
class Look:
    """What tells whether a value is a secret. Looks of joined values come from those of their parts."""
    size: int
    counts: Counter  # of characters; in proportion beyond `LARGE`
    head: str
    tail: str
    mentions: bool
    armoured: bool = False
    about: bool = False

    @property
    def phrase(self) -> bool:
        """Whether it has blanks without being key material."""
        return not self.armoured and any(c.isspace() for c in self.counts)

    @staticmethod
    def of(value: str) -> Look:
        mentions, about = bool(MENTIONS.search(value)), False
        kinds = [m[1] for m in ARMOUR.finditer(value) if m[1]] if "-----" in value else []
        if kinds:  # what is left of public material is nothing
            value = "" if any(word in kind for kind in kinds for word in OPEN) else ARMOUR.sub("", value)
        elif any(c.isspace() for c in value):
            words = {w.lower() for w in PART.findall(value)}
            about = not words.isdisjoint(ABOUT) or not words.isdisjoint(SENSITIVE)
        return Look(len(value), Counter(value), value[:EDGE], value[-EDGE:], mentions, bool(kinds), about)


@dataclass(frozen=True, eq=False)
class Pair:
    """A literal, or literals joined, that an assignment gives to a name.

    Parts are spans of literals in the text, and pairs whose names stand there. These are referred
    to, never copied: a name that is joined to itself again and again stands for ever more spans.
    What name and value tell of a secret is settled here, so that looks need not be kept.
    """
    name: str
    parts: tuple[tuple[int, int] | Pair, ...]
    quoted: bool
    phrase: bool
    told: float
    score: float
    text: str = field(repr=False)

    @staticmethod
    def of(name: str, parts: list[tuple[int, int] | Pair], quoted: bool, look: Look, text: str) -> Pair:
        told = sensitivity(name)
        return Pair(name, tuple(parts), quoted, look.phrase, told, told and told * randomness(look, quoted), text)

    def leaves(self, seen: set[int] | None = None) -> Iterator[tuple[int, int]]:
        """Spans of literals in order; with `seen`, each pair once, those in it not at all."""
        todo = [self]
        while todo:
            part = todo.pop()
            if not isinstance(part, Pair):
                yield part
            elif seen is None or id(part) not in seen:
                if seen is not None:
                    seen.add(id(part))
                todo.extend(reversed(part.parts))

    @property
    def value(self) -> str:
        return "".join(self.text[start:end] for start, end in self.leaves())

    @property
    def spans(self) -> tuple[tuple[int, int], ...]:
        return tuple(dict.fromkeys(self.leaves(set())))


def joined(looks: list[Look]) -> Look:
    """The look of the values one after another."""
    if len(looks) == 1:
        return looks[0]
    times, by_id = Counter(map(id, looks)), {id(look): look for look in looks}
    counts: Counter = Counter()
    for key, n in times.items():
        for character, count in by_id[key].counts.items():
            counts[character] += n * count
    head, tail, mentions = "", "", False
    for look in looks:
        mentions = mentions or look.mentions or bool(MENTIONS.search(tail + look.head))
        head = (head + look.head)[:EDGE] if len(head) < EDGE else head
        tail = (tail + look.tail)[-EDGE:]
    armoured, about = any(look.armoured for look in looks), any(look.about for look in looks)
    size = sum(look.size for look in looks)
    if size > LARGE:
        counts, size = Counter({c: n * (LARGE / size) for c, n in counts.items()}), LARGE
    return Look(size, counts, head, tail, mentions, armoured, about)


def sensitivity(name: str) -> float:
    """0 to 1: how much a target name tells of a secret."""
    words = [w.lower() for w in PART.findall(name)]
    if not words or words[-1] in HARMLESS or "public" in words:
        return 0.0
    most = max((SENSITIVE.get(w, SENSITIVE.get(w.rstrip("s"), 0.0)) for w in words), default=0.0)
    return 1.0 if any(pair in PAIRS for pair in zip(words, words[1:], strict=False)) else most


def stands_in(look: Look) -> bool:
    """Whether a value stands for a secret without being one."""
    if look.mentions or BEGINS.match(look.head) or set(look.counts) <= {"x", "X"} or set(look.counts) in ({"*"}, {"."}):
        return True
    return look.size <= EDGE and bool(STANDS.match(look.head))


def randomness(look: Look, quoted: bool) -> float:
    """0 to 1: how much a literal looks like a secret, by its alphabet and the entropy of its characters.

    Key material is judged without its armour and line breaks. Of other quoted values with blanks, as
    passphrases are, the other characters are judged, of which there must be `PHRASE`; sentences
    about secrets are none.
    """
    counts, size, full = look.counts, look.size, 3.0
    if blank := sum(n for c, n in counts.items() if c.isspace()):
        counts = Counter({c: n for c, n in counts.items() if not c.isspace()})
        size -= blank
        if look.phrase:
            full = 3.5
            if not quoted or look.about or size < PHRASE:
                return 0.0
    if size < 6 or stands_in(look):
        return 0.0
    entropy = -sum(share * math.log2(share) for n in counts.values() if (share := n / size) > 0)
    classes = sum(any(test(c) for c in counts) for test in (str.isdigit, str.islower, str.isupper, lambda c: not c.isalnum()))
    if not quoted and classes < 2:
        return 0.0
    return min(1.0, entropy / full) * (0.6 if classes < 2 else 0.85 if classes < 3 else 1.0)


@dataclass
class Value:
    """Literals and known names that are read as one value."""
    parts: list[tuple[int, int] | Pair] = field(default_factory=list)
    looks: list[Look] = field(default_factory=list)
    quoted: bool = False
    bare: bool = False
    end: int = 0

    def add(self, text: str, span: tuple[int, int], end: int) -> None:
        self.parts.append(span)
        self.looks.append(Look.of(text[span[0] : span[1]]))
        self.end = end

    def __bool__(self) -> bool:
        return any(isinstance(part, Pair) or part[1] > part[0] for part in self.parts)


def _value(text: str, place: int, known: dict[str, tuple[Pair, Look]], bare: bool = True) -> Value:
    """The value that starts at a place; empty if there is none."""
    value = Value()
    if around := AROUND.match(text, place):
        place = around.end()
    while True:
        if m := QUOTED.match(text, place):
            value.add(text, m.span(m.lastindex), m.end())
            value.quoted = True
        elif (m := NAME.match(text, place)) and (source := known.get(m[0])):
            value.parts.append(source[0])
            value.looks.append(source[1])
            value.quoted |= source[0].quoted
            value.end = m.end()
        elif bare and not value.parts and (m := BARE.match(text, place)):
            value.add(text, m.span(), m.end())
            value.bare = True
        else:
            return value
        if not (value.quoted and (join := JOIN.match(text, value.end))):
            return value
        place = join.end()


def _below(text: str, place: int) -> Value:
    """The value on the lines below a name that ends with a colon."""
    value = Value()
    if m := MATERIAL.match(text, place):
        value.quoted = True
    else:
        m = LINE.match(text, place)
        value.bare = bool(m)
    if m:
        value.add(text, m.span(), m.end())
    return value


def _named(text: str) -> Iterator[tuple[str, Value]]:
    """Names and values that belong together without an operator between them."""
    for pattern, mark in ((ELEMENT, "</"), (ATTRIBUTE, "value")):
        for m in pattern.finditer(text) if mark in text else ():
            if sensitivity(m[1]):
                value = Value(quoted=pattern is ATTRIBUTE)
                value.add(text, m.span(2), m.end())
                yield m[1], value
    for pattern, mark in ((ARGUMENT, "("), (OPTION, "--")):
        for m in pattern.finditer(text) if mark in text else ():
            if sensitivity(m[1]):
                yield m[1], _value(text, m.end(), {}, bare=pattern is OPTION)


def pairs(text: str) -> list[Pair]:
    """Name-literal pairs: those of assignments in order, then those that have no operator.

    Lexed are targets with annotations, indices and quotation marks (escaped ones too), tuples of
    targets, quoted literals of one or three marks, bare configuration values, values on the next
    line after a backslash or a colon, literals joined by `+`, `.` or `..`, and names of earlier assignments,
    whose literals are propagated. Without an operator: elements, `key` or `name` beside `value`,
    two arguments of a call, options of a command. An operator within a bare value belongs to it.
    Names and literals of any length are read whole, and all parts of a join.
    """
    known: dict[str, tuple[Pair, Look]] = {}
    out: list[Pair] = []

    def keep(name: str, value: Value) -> None:
        if value:
            look = joined(value.looks)
            out.append(Pair.of(name, value.parts, value.quoted, look, text))
            known[name] = out[-1], look

    after, before, bare = 0, 0, 0  # ends of the last two operators, of the last bare value
    for operator in OPERATOR.finditer(text):
        at, reach = operator.start(), before
        before, after = after, operator.end()
        if at == 0 or at < bare or text[at - 1] in "=!<>:+-*/":
            continue
        begin = text.rfind("\n", reach, at) + 1
        ahead = text[begin or reach : at][::-1]  # a target reaches over one operator at most, that of its annotation
        target = TARGET.match(ahead)
        if not target:
            continue
        names, place = [(target[1] or target[2])[::-1].lstrip("0123456789.->")], target.end()
        while further := FURTHER.match(ahead, place):
            names.append(further[1][::-1])
            place = further.end()
        start = SPACE.match(text, after).end()
        value = _value(text, start, known)
        if len(names) > 1 and (begin or not reach) and DECLARED.match(ahead, place):
            values = [value]
            while len(values) < len(names) and values[-1] and (comma := COMMA.match(text, values[-1].end)):
                values.append(_value(text, comma.end(), known))
            if len(values) == len(names) and values[-1]:
                for name, each in zip(reversed(names), values, strict=True):
                    keep(name, each)
                continue
        if text[at] == ":" and (m := BELOW.match(text, start)) and sensitivity(names[0]):
            value = _below(text, m.end()) or _value(text, m.end(), known, bare=False)
        if value.bare:
            bare = value.end
        keep(names[0], value)
    known.clear()
    for name, value in _named(text):
        keep(name, value)
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base kinds."""
    out = []
    lower = text.lower()
    if any(word in lower for word in WORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def named_spans(text: str, threshold: float) -> list[tuple[int, int, int]]:
    """(start, kind, end) of literals whose name and look say that they are secrets."""
    seen: set[int] = set()
    return sorted({
        (start, 3, end) for pair in pairs(text)
        if pair.told >= (max(threshold, SURE) if pair.phrase else threshold) and pair.score >= threshold
        for start, end in pair.leaves(seen) if end > start
    })


_SPANS = "array<struct<kind:int,start:bigint,end:bigint>>"


def find_secrets(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """(doc_id, text, spans) of every document; spans are (kind, start, end) by start, then kind.

    Kinds are numbers in KINDS. Places are code points, ends exclusive. `assign`, `access` and `hex`
    match patterns. `named` are literals that the text assigns, directly or through other names, to a
    sensitive name; name and literal are scored and both must pass `threshold`. They add to the base
    kinds and may overlap them. Whole texts are read. A null or empty text has no spans; repeated
    rows are scanned each, a null doc_id is carried along, an empty table gives no rows, other
    columns are left out.
    """
    kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                out = []
                for value in batch.column("text"):
                    text = value.as_py() or ""
                    spans = sorted(base_spans(text) + named_spans(text, threshold))
                    out.append([{"kind": k, "start": s, "end": e} for s, k, e in spans])
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, kind)], names=["doc_id", "text", "spans"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, f"doc_id long, text string, spans {_SPANS}")


def hidden(text: str | None, threshold: float = 0.5, mark: str = "[SECRET]") -> str | None:
    """The text with its secrets replaced: the value of an assignment, the whole of other kinds."""
    if not text:
        return text
    spans = [(m.start(1), m.end(1)) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    spans += [(s, e) for s, k, e in base_spans(text) + named_spans(text, threshold) if k]
    out, at = [], 0
    for start, end in sorted(spans):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]]) if spans else text


def redact(docs: DataFrame, column: str = "text", threshold: float = 0.5) -> DataFrame:
    """The same rows and columns with secrets hidden in one column; null stays null."""
    at, schema = docs.columns.index(column), docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, SLICE):
                batch = whole.slice(start, SLICE)
                texts = pa.array([hidden(t.as_py(), threshold) for t in batch.column(at)], pa.string())
                yield pa.RecordBatch.from_arrays([*batch.columns[:at], texts, *batch.columns[at + 1 :]], names=batch.schema.names)

    return docs.mapInArrow(run, schema)


def digests(found: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_named): counts and spans in text form."""
    def joined(spans):
        return ",".join(f"{KINDS[s['kind']]}:{s['start']}:{s['end']}" for s in spans)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for spans in batch.column("spans").to_pylist():
                kinds = Counter(s["kind"] for s in spans)
                base = joined(s for s in spans if s["kind"] < 3)
                out.append((kinds[0], kinds[1], kinds[2], hashlib.sha256(base.encode()).hexdigest(), joined(spans), kinds[3]))
            columns = zip(*out, strict=True) if out else ((),) * 6
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_named"],
            )

    return found.select("doc_id", "spans").mapInArrow(
        run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_named long"
    )
