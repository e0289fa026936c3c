import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from wikicells.llm import alignment

BYTE, PIECE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(BYTE)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PIECE), alignment.byte_level(alignment.read_vocabulary(BYTE))


def tokens(text, libraries):
    """Ids and bytes of both tokenizations of a whole text, or none."""
    a, b, spelled = libraries
    raw = (" " + text).encode()
    ids_a, ids_b = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
    bytes_a = [spelled[i] for i in ids_a]
    bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    return (ids_a, ids_b, bytes_a, bytes_b) if b"".join(bytes_a) == raw == b"".join(bytes_b) else ([], [], [], [])


def brute(rows, libraries):
    """By ranges: all pairs of tokens are compared."""
    docs, counts = [], Counter()
    for doc_id, text in rows:
        ids_a, ids_b, bytes_a, bytes_b = tokens(text or "", libraries)
        ends = [np.cumsum([len(x) for x in of], dtype=int) for of in (bytes_a, bytes_b)]
        links = []
        for i, (x, end) in enumerate(zip(ids_a, ends[0], strict=True)):
            low = int(np.searchsorted(ends[1], end - len(bytes_a[i]), "right"))
            for k in range(low, len(ids_b)):
                if ends[1][k] - len(bytes_b[k]) >= end:
                    break
                links.append((x, ids_b[k]))
        both = sorted({*ends[0].tolist()} & {*ends[1].tolist()})
        groups = ["|".join(",".join(str(x) for x, e in zip(ids, end, strict=True) if low < e <= high) for ids, end in zip((ids_a, ids_b), ends, strict=True))
                  for low, high in zip([0, *both], both, strict=False)]
        docs.append((doc_id, len(ids_a), len(ids_b), groups, links))
        counts.update(set(links))
    most = defaultdict(int)
    for (x, _), n in counts.items():
        most[x] = max(most[x], n)
    return sorted(
        ((i, a, b, len(g), len(links), sum(counts[p] == most[p[0]] for p in links), sum(counts[p] for p in links),
          hashlib.sha256(";".join(g).encode()).hexdigest() if g else "") for i, a, b, g, links in docs), key=str)


def found(df):
    return sorted(map(tuple, alignment.align(df, BYTE, PIECE).collect()), key=str)


def test_whole_texts(spark, small, libraries):
    rows = [(r.doc_id, r.text) for r in small.orderBy("doc_id").limit(80).collect() if len(r.text) < 5000]
    rows += [(900, rows[0][1]), (901, "<|endoftext|> <s> x</s> <0x41> <unk>"), (902, "▁a b"), (903, " a"), (904, "a  b \n c   d e\x1cf \x1f g")]
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows, libraries)


def test_odd_rows(spark, odd, nothing, libraries):
    rows = [(r.doc_id, r.text[:3000] if r.text else r.text) for r in odd.collect()]
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows, libraries)
    by_id = {r.doc_id: r for r in alignment.align(odd, BYTE, PIECE).collect()}
    assert by_id[7].n_groups == 30_001 and (by_id[2].n_a, by_id[2].groups_sha256) == (0, "")
    assert alignment.align(nothing, BYTE, PIECE).collect() == []


def test_parts_and_blocks_change_nothing(spark, small, libraries, monkeypatch):
    """Texts in small parts, whose postings are OR-merged, and in blocks of 16 documents."""
    monkeypatch.setattr(alignment, "PART", 40)
    monkeypatch.setattr(alignment, "BLOCK", 16)
    monkeypatch.setattr(alignment, "REMEMBERED", 50)
    rows = [(r.doc_id, r.text[:900]) for r in small.orderBy("doc_id").limit(50).collect()]
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows, libraries)


def test_cuts_are_token_ends(libraries):
    """Pieces by themselves have the tokens that they have in the whole text."""
    rng, letters = random.Random(5), [*map(chr, range(260)), *"  　 ​﻿٣½Ⅰ日\U0001f600'", "́", "'s", "᠎", "▁"]
    with open(BYTE, "rb") as one, open(PIECE, "rb") as other:
        aligner = alignment.Aligner(one.read(), other.read())
    for _ in range(1500):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(1, 30)))
        ids_a, ids_b, *_ = tokens(text, libraries)
        counts, digest, _ = aligner.text(text)
        assert counts[:2].tolist() == [len(ids_a), len(ids_b)], text
        assert (digest == "") == (not ids_a)


def test_bitmaps():
    rng = np.random.default_rng(1)
    runs = [np.sort(rng.choice(alignment.BLOCK, n, replace=False)) for n in (1, 255, 256, 257, 3000, alignment.BLOCK, 7)]
    starts = np.cumsum([0, *map(len, runs[:-1])])
    bitmaps = alignment.packed(np.concatenate(runs), starts)
    assert [len(x.as_py()) for x in bitmaps] == [2, 510, 512, 512, 512, 512, 14]
    owner, slot = alignment.unpacked(bitmaps.slice(1, 5))
    assert all(sorted(slot[owner == i].tolist()) == runs[i + 1].tolist() for i in range(5))
    assert alignment.unpacked(pa.array([], pa.binary()))[0].tolist() == []


def test_pair_scores(spark, libraries):
    """Documents by popcounts, links by planes."""
    rows = [(1, "the the the the the dog"), (2, "the cat"), (None, "the"), (4, None)]
    _, postings = alignment.index(spark.createDataFrame(rows, "doc_id long, text string"), BYTE, PIECE)
    a, b, _ = libraries
    the = (a.encode(" the", add_special_tokens=False).ids[0], b.encode("the")[0])
    scores = {(r.a, r.b): (r.documents, r.links, r.best) for r in alignment.pair_scores(postings).collect()}
    assert scores[the] == (3, 7, True) and len(scores) >= 3


def test_known_pieces_are_not_aligned_again(monkeypatch):
    """Groups and links of a piece are remembered, not only its tokens."""
    with open(BYTE, "rb") as one, open(PIECE, "rb") as other:
        aligner = alignment.Aligner(one.read(), other.read())
    first, turned = aligner.text("the quick, brown foxes jumped"), aligner.text("jumped foxes brown quick, the")

    def none(*_):
        raise AssertionError("aligned again")

    monkeypatch.setattr(aligner, "align", none)
    for text, (counts, digest, parts) in (("the quick, brown foxes jumped", first), ("jumped foxes brown quick, the", turned)):
        again = aligner.text(text)
        assert again[0].tolist() == counts.tolist() and again[1] == digest
        assert [[x.tolist() for x in part] for part in again[2]] == [[x.tolist() for x in part] for part in parts]
