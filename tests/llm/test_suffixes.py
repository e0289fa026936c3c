import hashlib
from collections import Counter

import pytest

from wikicells.llm import suffixes
from wikicells.llm.queries import suffix_dedup


def brute(rows, threshold):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(t[k : k + threshold] for _, t in texts for k in range(len(t) - threshold + 1))
    out = []
    for i, t in texts:
        gone = bytearray(len(t) + 1)
        for k in range(len(t) - threshold + 1):
            if seen[t[k : k + threshold]] > 1:
                gone[k : k + threshold] = b"\1" * threshold
        runs = sum(gone[k] and not gone[k - 1] for k in range(len(t)))
        out.append((i, len(t), sum(gone), runs, bytes(c for c, g in zip(t, gone, strict=False) if not g)))
    return sorted(out, key=str)


def found(df, threshold):
    return sorted(((*r[:4], bytes(r[4])) for r in suffixes.without_repeats(df, threshold).collect()), key=str)


@pytest.mark.parametrize("crowd", [4096, 2])
def test_brute_force(spark, small, monkeypatch, crowd):
    """With few classes a gram in a task, windows are counted by Spark; results are the same."""
    monkeypatch.setattr(suffixes, "CROWD", crowd)
    rows = [(r.doc_id, r.text) for r in small.orderBy("doc_id").limit(40).collect()]
    first = rows[0][1]
    rows += [(900, first), (901, "Q" + first[50:]), (902, "ab" * 400), (903, "ab" * 401), (None, rows[5][1][100:900]), (904, rows[7][1][:350] + "Q" + rows[7][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(df, 200) == brute(rows, 200)


def test_odd_rows(spark, odd, nothing):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    rows = [(i, t[:3000] if t else t) for i, t in rows]
    assert found(spark.createDataFrame(rows, "doc_id long, text string"), 200) == brute(rows, 200)
    by_id = {r.doc_id: r for r in suffixes.without_repeats(odd, 200).collect()}
    assert (by_id[7].n_removed, by_id[7].n_spans, by_id[8].n_removed) == (150_000, 1, 60_000)
    assert suffixes.without_repeats(nothing, 200).collect() == []


def test_no_window_is_repeated(spark):
    """Texts that share a gram of every window, but no window."""
    rows = [(i, "".join(chr(97 + (i + k) % 7) for k in range(90)) + "common " * 5 + "".join(chr(107 + (i * k) % 11) for k in range(90))) for i in range(1, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(df, 200) == brute(rows, 200) and all(r[2] == 0 for r in found(df, 200))


def test_long_texts_are_read_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "CHUNK", 300)
    rows = [(1, "".join(chr(97 + i * i % 23 + i % 3) for i in range(1500))), (2, "".join(chr(97 + i * i % 23 + i % 3) for i in range(700, 1400)))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(df, 200) == brute(rows, 200)


def test_digest(spark):
    row = suffix_dedup(spark, "/root/testdata/sf0.001").where("n_removed = 0").first()
    text = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where(f"doc_id = {row.doc_id}").first().text
    assert row.kept_sha256 == hashlib.sha256(text.encode()).hexdigest() and row.n_bytes == len(text.encode())


def test_equal_rows_of_one_id(spark, small):
    texts = [r.text for r in small.orderBy("doc_id").limit(6).collect()]
    texts[0] = (texts[0] * 3)[:1500]
    rows = [(1, texts[0])] * 50 + [(1, texts[1])] * 2 + [(2, "Q" + texts[0][200:700]), (3, "short"), (3, "short"), (4, texts[4]), (None, texts[5]), (None, texts[5])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(df, 200) == brute(rows, 200)
    end = len(texts[0].encode())
    assert end > 1000 and suffixes.repeated_spans(df, 200).where(f"doc = 1 AND start = 0 AND end = {end}").count() >= 1
    # as many rows as would take hours if each met each
    many = df.where("doc_id = 2").union(df.where("doc_id = 1").limit(1).join(spark.range(10_000).withColumnRenamed("id", "n"), how="cross").select("doc_id", "text"))
    rows = suffixes.without_repeats(many, 200).groupBy("doc_id", "n_bytes", "n_removed", "n_spans").count().collect()
    assert {r.doc_id: r["count"] for r in rows} == {1: 10_000, 2: 1} and all(r.n_spans == 1 for r in rows)
