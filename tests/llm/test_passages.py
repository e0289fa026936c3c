import random
import re
from collections import Counter

import pytest

from wikicells.llm import passages


def brute(rows, window=50):
    texts = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    first = {}
    for i, words in texts:
        if i is not None:
            for k in range(len(words) - window + 1):
                key = tuple(words[k : k + window])
                first[key] = min(i, first.get(key, i))
    out = []
    for i, words in texts:
        gone = [False] * len(words)
        for k in range(len(words) - window + 1 if i is not None else 0):
            if first[tuple(words[k : k + window])] < i:
                gone[k : k + window] = [True] * window
        out.append((i, len(words), sum(gone), " ".join(w for w, g in zip(words, gone, strict=True) if not g)))
    return sorted(out, key=str)


def found(spark, rows, window=50):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return sorted(map(tuple, passages.without_passages(df, window).collect()), key=str)


def edited(rng, words, n):
    """n random words changed, cut off or put in."""
    words = list(words)
    for _ in range(n):
        k = rng.randrange(len(words))
        words[k : k + rng.randint(0, 2)] = [str(rng.randrange(10**6))] * rng.randint(0, 2)
    return words


@pytest.fixture(scope="module")
def planted(small):
    """Whole texts, near copies, shared passages inside and beside others, and repeats within one text."""
    rng = random.Random(11)
    rows = [(r.doc_id, r.text) for r in small.orderBy("doc_id").limit(70).collect()]
    words = [t.split() for _, t in rows]
    long = max(words, key=len)
    for k in range(40):
        base = rng.choice(words + [long] * 20)
        low = rng.randrange(max(1, len(base) - 120))
        rows.append((1000 + k, "\t ".join(rng.choice(words)[:80] + edited(rng, base[low : low + rng.randint(40, 200)] or ["x"], rng.randint(0, 2)) + rng.choice(words)[:40])))
    passage = " ".join(str(k) for k in range(50))
    rows += [(2000 + k, f"left{k} {passage} right{k}") for k in range(30)]
    rows += [(3000, f"{passage} {passage} {passage}"), (3001, " ".join(str(k) for k in range(49))), (-5, rows[4][1]), (None, rows[4][1]), (None, passage)]
    rng.shuffle(rows)
    return rows


def test_brute_force(spark, planted):
    expected = brute(planted)
    assert found(spark, planted) == expected and sum(r[2] > 0 for r in expected) > 60


@pytest.mark.parametrize(("window", "chunk", "shard", "hot"), [(50, 23, 1, 3), (16, 1 << 20, 5, 1), (9, 64, 4096, 2)])
def test_chunks_shards_and_copies_change_nothing(spark, planted, monkeypatch, window, chunk, shard, hot):
    monkeypatch.setattr(passages, "CHUNK", chunk)
    monkeypatch.setattr(passages, "PART", 31)
    monkeypatch.setattr(passages, "SHARD", shard)
    monkeypatch.setattr(passages, "HOT", hot)
    assert found(spark, planted, window) == brute(planted, window)


def test_repeated_rows(spark):
    """A row that is there many times is searched once."""
    text = " ".join(str(k * k % 97) for k in range(200))
    rows = [(1, text)] * 40 + [(2, text)] * 40 + [(2, "other " + text)] + [(3, text[: len(text) // 2])]
    assert found(spark, rows) == brute(rows)
    spans = passages.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert max(Counter((r.doc, r.print, r.start, r.end) for r in spans).values()) == 1


def test_odd_rows(spark, odd, nothing):
    rows = [(r.doc_id, r.text[:3000] if r.text else r.text) for r in odd.collect()]
    assert found(spark, rows) == brute(rows)
    by_id = {r.doc_id: r for r in passages.without_passages(odd).collect()}
    assert (by_id[7].n_words, by_id[7].n_removed, by_id[2].kept) == (30_000, 0, "")
    assert passages.without_passages(nothing).collect() == []


def test_automaton():
    automaton = passages.Automaton(2)
    assert automaton.locate([b"a"], 9) == []
    automaton = passages.Automaton(2)
    automaton.add([b"x", b"a", b"b", b"c"], [{"at": 1, "until": 2, "first": 4}])
    automaton.add([b"a", b"b", b"y"], [{"at": 0, "until": 0, "first": 1}])
    text = b"a b c q a b".split()
    assert automaton.locate(text, 9) == [(0, 3), (4, 6)]
    assert automaton.locate(text, 3) == [(0, 2), (4, 6)]
    assert automaton.locate(text, 1) == []
