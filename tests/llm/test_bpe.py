import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from wikicells.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(PATH)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def test_words_that_the_dictionary_lacks(ranks, library):
    rng = random.Random(3)
    letters = [*map(chr, range(260)), *"    　​﻿́٣½Ⅰ日😀", "<|endoftext|>"]
    to_ids, to_bytes = bpe.encoder(ranks, {}, PATTERN), bpe.decoder(ranks)
    for _ in range(800):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
        ids = to_ids(text)
        assert np.frombuffer(ids, "<u4").tolist() == library(text)
        assert to_bytes(ids) == text.encode()


def test_folded_dictionary(spark, small, ranks, library):
    """Higher-order functions fold words as the library does; the most frequent words are in."""
    known = bpe.dictionary(small, ranks, PATTERN, size=400)
    assert 200 < len(known) <= 400 and " the" in known
    assert all(np.frombuffer(ids, "<u4").tolist() == library(word) for word, ids in known.items())
    assert bpe.dictionary(small.limit(0), ranks, PATTERN) == {}


@pytest.mark.parametrize("size", [0, 300, 1 << 17])
def test_round_trip(small, odd, library, size):
    for docs in (small, odd):
        rows = [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]
        expected = []
        for doc_id, text in rows:
            ids = np.array(library(text), "<u4")
            expected.append((doc_id, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
        assert sorted(map(tuple, bpe.round_trip(docs, PATH, PATTERN, size).collect()), key=str) == sorted(expected, key=str)


def test_encode_and_decode(odd, nothing):
    encoded = bpe.encode(odd, PATH, PATTERN)
    assert encoded.columns == ["doc_id", "ids"]
    decoded = sorted(bytes(r["bytes"]) for r in bpe.decode(encoded, PATH).collect())
    assert decoded == sorted((r.text or "").encode() for r in odd.collect())
    assert bpe.round_trip(nothing, PATH, PATTERN).collect() == []


def test_plans_do_not_print_the_vocabulary(small, ranks, monkeypatch):
    """The driver keeps the text of every plan; that of a literal vocabulary has megabytes."""
    frame, plans = type(small), []
    monkeypatch.setattr(frame, "toArrow", lambda self, read=frame.toArrow: plans.append(self._jdf.queryExecution().toString()) or read(self))
    assert " the" in bpe.dictionary(small, ranks, PATTERN, size=400)
    assert len(plans) == 1 and len(plans[0]) < 50_000
