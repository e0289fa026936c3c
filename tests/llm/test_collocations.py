import re
from collections import Counter, defaultdict

import pytest

from wikicells.llm import collocations as mining


def brute(rows, top=2000, least=10, share=50):
    counts, words = defaultdict(Counter), Counter()
    lower = {c: c + 32 for c in range(65, 91)}
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            run = tuple(re.findall(r"[^\x20\x09]+", piece))
            words[lang] += len(run)
            for k in (1, 2, 3):
                counts[lang].update(run[i : i + k] for i in range(len(run) - k + 1))
    out = []
    for lang, f in counts.items():
        longer = [(p, a) for p, a in f.items() if len(p) == 3 and a >= least]
        within = defaultdict(int)
        for p, a in longer:
            for pair in (p[:2], p[1:]):
                within[pair] = max(within[pair], a)
        found = []
        for p, a in f.items():
            if len(p) > 1 and a >= least and not (len(p) == 2 and p in within and 100 * within[p] >= share * a):
                score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, words[lang], -score))
    return sorted(out)


def found(df, **kwargs):
    return sorted(map(tuple, mining.collocations(df, **kwargs).collect()))


@pytest.fixture(scope="module")
def rows(spark):
    return [(r.lang, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]


def test_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    assert found(df) == brute(rows) and len(brute(rows)) > 500


@pytest.mark.parametrize("top", [1, 7, 40])
def test_rounds_that_settle_early(spark, rows, top):
    """Few phrases are wanted, so that the frontier is not expanded whole."""
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    assert found(df, top=top, least=4) == brute(rows, top=top, least=4)


def test_chunks_and_parts_change_nothing(spark, rows, monkeypatch):
    monkeypatch.setattr(mining, "CHUNK", 37)
    monkeypatch.setattr(mining, "PART", 50)
    some = rows[:60]
    assert found(spark.createDataFrame(some, "lang string, text string"), least=3) == brute(some, least=3)


def test_crowded_bitmaps_change_nothing(spark, rows, monkeypatch):
    """So few bits that almost everything hits by chance."""
    monkeypatch.setattr(mining, "BITS", 1 << 15)
    assert found(spark.createDataFrame(rows[:300], "lang string, text string"), top=20, least=3) == brute(rows[:300], top=20, least=3)


def test_swallowed_pairs_and_ties(spark):
    rows = [("en", "big red house. " * 9 + "Big red car, big\tred\nhouse"), ("en", "a a a a a a"), (None, "x y " * 6), ("und", "x y"), ("de", ""), ("fr", None)]
    got = found(spark.createDataFrame(rows, "lang string, text string"), least=4, share=90)
    assert got == brute(rows, least=4, share=90)
    assert {r[2] for r in got if r[0] == "en"} >= {"big red house", "a a"} and not any(r[2] == "red house" for r in got)
    assert {r[0] for r in got} == {"en", "und"}


def test_large_counts(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(10**14, 10**14 + 7, 10**14 + 3)], "a long, f1 long, f2 long")
    assert df.select(mining._score("a", "f1", "f2").alias("s")).first().s == 10**34 // ((10**14 + 7) * (10**14 + 3))
    assert df.select(F.lit(1)).count() == 1


def test_odd_rows(spark, odd, nothing):
    rows = [(r.lang, r.text) for r in odd.collect()]
    assert found(odd) == brute(rows)
    assert mining.collocations(nothing).collect() == []
