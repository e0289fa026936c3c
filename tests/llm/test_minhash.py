from collections import defaultdict

import pytest

from wikicells.llm import minhash
from wikicells.llm.components import components


def shingles(text, n):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\x0b", " ").replace("\x0c", " ")
    for white in "\t\n\r":
        words = words.replace(white, " ")
    words = [w for w in words.split(" ") if w]
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else {tuple(words)} if words else set()


def reachable(links, ids):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def brute(rows, n, percent):
    sets = [(i, shingles(t, n)) for i, t in rows]
    links = [
        (i, j) for k, (i, a) in enumerate(sets) for j, b in sets[:k]
        if a and b and None not in (i, j) and 100 * len(a & b) >= percent * len(a | b)
    ]
    return reachable(links, [i for i, _ in sets if i is not None]), {(i, len(s)) for i, s in sets}


def test_components(spark):
    chain = [(i, i + 1) for i in range(1, 40)]
    star = [(100, i) for i in range(101, 400)]
    links = [*chain, *star, (500, 500), (7, 7), (600, 601), (601, 600), (None, 3)]
    df = spark.createDataFrame(links, "a long, b long")
    expected = reachable([x for x in links if x[0] and x[0] != x[1]], {i for x in links if x[0] and x[0] != x[1] for i in x})
    assert {r.id: r.component for r in components(df).collect()} == expected
    assert components(df.limit(0)).collect() == []


@pytest.mark.parametrize(("words", "percent"), [(3, 85), (5, 80)])
def test_brute_force(spark, small, words, percent):
    rows = [(r.doc_id, r.text) for r in small.select("doc_id", "text").collect()]
    base = [f"w{i}" for i in range(120)]
    for k in range(60):  # a group in which some pairs are linked and others are not
        edited = list(base)
        for e in range(k % 6):
            edited[(k * 37 + e * 17) % 120] = f"edit{k}x{e}"
        rows.append((5000 + k, " ".join(edited)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    expected, sizes = brute(rows, words, percent)
    found = minhash.near_duplicates(df, words, percent).collect()
    assert {r.doc_id: r.component_id for r in found} == expected
    assert {(r.doc_id, r.n_shingles) for r in found} == sizes
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_blocks_give_the_same(spark, monkeypatch):
    rows = [(k, " ".join(f"w{i if (i * 7 + k) % 61 else (k, i)}" for i in range(200))) for k in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    expected, _ = brute(rows, 3, 85)
    monkeypatch.setattr(minhash, "BLOCK", 1000)
    monkeypatch.setattr(minhash, "COLUMNS", 64)
    assert {r.doc_id: r.component_id for r in minhash.near_duplicates(df, 3, 85).collect()} == expected


def test_odd_rows(odd, nothing):
    found = defaultdict(list)
    for r in minhash.near_duplicates(odd, 3, 85).collect():
        found[r.doc_id].append((r.n_shingles, r.component_id, r.kept))
    assert found[None] == [(2, None, True)] * 2 or sorted(found[None]) == [(0, None, True), (2, None, True), (2, None, True)]
    assert found[1] == [(0, 1, True)] and found[3] == [(0, 3, True)]
    assert found[4] == [(1, 4, True)] and len(found[5]) == 3 and {c for _, c, _ in found[5]} == {5}
    assert found[7] == [(1, 7, True)]
    assert minhash.near_duplicates(nothing).collect() == []


def test_one_of_each(odd):
    out = minhash.one_of_each(odd)
    assert out.columns == odd.columns
    assert sorted(str(r.doc_id) for r in out.collect()) == sorted([*"123456789", "None", "None", "None"])
