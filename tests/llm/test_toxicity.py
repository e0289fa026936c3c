import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from wikicells.llm import toxicity
from wikicells.llm.toxicity import Automaton, Model, hits, learn, score, without_toxic

INSULTS = ["grubber", "snollygoster", "fopdoodle", "scobber", "dalcop"]


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def test_automaton_against_distances():
    rng = random.Random(7)
    automaton = Automaton([*INSULTS, "oaf", "grub*"])
    for _ in range(4000):
        word = list(rng.choice(INSULTS + ["oaf", "plain", "grubworm"]))
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(word) + 1)
            word[at : at + rng.randint(0, 1)] = rng.choice(["", "a", "o", "z", "é"])
        word = "".join(word)
        near = [(edits(word, e), n) for n, e in enumerate(automaton.entries[:6]) if edits(word, e) <= toxicity.allowed(e)]
        expected = min(near, default=None)
        if word.startswith("grub") and (expected is None or expected[0]):
            expected = (0, 6)
        assert automaton.match(word) == expected, word


def test_memory_of_the_automaton_is_bounded(monkeypatch):
    monkeypatch.setattr(toxicity, "REMEMBERED", 50)
    automaton = Automaton(INSULTS)
    for i in range(500):
        automaton.match(f"grub{i}ber")
    assert len(automaton.known) <= 50 and automaton.match("grubbr") == (1, 0)


def test_quotation():
    automaton = Automaton(INSULTS)
    found = hits('You grubber! She said "what a fopdoodle" and left, dalcopp.\n> scobber', automaton)
    assert [(e, k) for e, k, _ in found] == [(0, toxicity.PLAIN), (2, toxicity.QUOTATION), (4, toxicity.MISSPELLED), (3, toxicity.QUOTATION)]


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(1)
    words = [f"{a}{b}{c}" for a in ("mo", "ta", "ri", "lun") for b in ("ne", "ska", "vi") for c in ("do", "pel", "m", "")]
    rows, labels = [], []
    for i in range(900):
        text = [rng.choice(words) for _ in range(rng.randint(30, 90))]
        toxic = i % 5 == 0
        for _ in range(rng.randint(2, 4) if toxic else 0):
            text.insert(rng.randrange(len(text)), rng.choice(INSULTS) if rng.random() < 0.8 else "vexu" + rng.choice(words))
        rows.append((i, " ".join(text), 1.0))
        labels.append((i, int(toxic), None))
    return spark.createDataFrame(rows, "doc_id long, text string, score double"), spark.createDataFrame(labels, "doc_id long, toxic int, quality int")


def test_held_out_accuracy(corpus):
    docs, labels = corpus
    model = learn(docs, labels)
    assert set(INSULTS) <= set(model.entries) and any(e.startswith("vex") and e.endswith("*") for e in model.entries)
    rows = score(docs, model).join(labels, "doc_id").where(toxicity.held_out(F.col("doc_id"))).collect()
    right = [r.predicted == r.toxic for r in rows]
    assert len(rows) > 200 and sum(right) / len(right) > 0.97
    assert all(r.predicted == 0 for r in rows if not r.toxic)


def test_held_out_labels_are_not_learned(corpus):
    docs, labels = corpus
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = learn(docs, labels), learn(docs, turned)
    assert a.entries == b.entries and a.logistic.tolist() == b.logistic.tolist()


def test_only_copies_of_one_label_are_left_out(spark):
    head, tail = "from the archive of the town hall , page", "all rights reserved by the town hall archive ."
    texts = [f"{head} {body} {tail}" for body in ("you grubber", "you grubber", "a quiet walk", "two fopdoodles met", "a fine day")]
    ids = [i for i in range(100) if zlib.crc32(str(i).encode()) % 3 != 1][:6]
    docs = spark.createDataFrame(list(zip(ids, [*texts, texts[2]], strict=True)), "doc_id long, text string")
    labels = spark.createDataFrame(list(zip(ids, [1, 1, 0, 1, 0, 1], strict=True)), "doc_id long, toxic int")
    found, counts = toxicity.training_texts(docs, labels, 100)
    expected = [(texts[0], 1), (texts[2], 0), (texts[2], 1), (texts[3], 1), (texts[4], 0)]
    assert sorted(map(tuple, found.collect())) == sorted(expected) and counts == {0: 2, 1: 4}


def test_rare_terms_of_large_samples_are_learned(spark):
    # 8 toxic documents of 1,600 hold the term, no clean one of 16,000
    ids = [i for i in range(30_000) if zlib.crc32(str(i).encode()) % 3 != 1][:17_600]
    rows = [(i, f"plain text {n}" + (" zounderkite" if n < 8 else " grubber" if n < 1600 else ""), int(n < 1600)) for n, i in enumerate(ids)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = learn(df.select("doc_id", "text"), df.select("doc_id", "toxic"), sample=20_000)
    assert {"zounderkite", "grubber"} <= set(model.entries)


def test_words_stay_beside_their_start(spark):
    assert toxicity._lexicon(["idiot*", "idiots", "idiotic*", "idio*", "idiot"]) == ["idiot*", "idiots", "idiot"]
    ids = [i for i in range(2000) if zlib.crc32(str(i).encode()) % 3 != 1][:1000]
    forms = ["idiotic", "idiots", "idiotism"]
    rows = [(i, f"plain text {n} " + (forms[n % 3] if n < 90 else ""), int(n < 90)) for n, i in enumerate(ids)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = learn(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    start = next(e for e in model.entries if e.endswith("*"))
    assert {*forms} <= set(model.entries) and "idiotic".startswith(start[:-1])
    automaton = Automaton(model.entries)
    assert [automaton.match(w) for w in ("idiots", "id1ots", start[:-1] + "zzzzzz")] == [
        (0, model.entries.index("idiots")), (1, model.entries.index("idiots")), (0, model.entries.index(start))
    ]
    # a start weighs what all words that it covers say
    weights = model.weights[:, toxicity.PLAIN]
    assert weights[model.entries.index(start)] >= weights[model.entries.index("idiots")] > 2


def test_misspelled_and_quoted(spark, corpus):
    model = learn(*corpus)
    texts = ["you grubber and snollygoster", "you grubbar, you snolygoster, fopdoddle and scober", 'he wrote "grubber" and "snollygoster"', None, ""]
    rows = {r.doc_id: r for r in score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()}
    assert [rows[i].predicted for i in range(5)] == [1, 1, 0, 0, 0]
    assert rows[1].n_misspelled == 4 and rows[2].n_quoted == 2 and rows[3].score == rows[4].score


def test_odd_rows(spark, corpus, odd, nothing):
    model = learn(*corpus)
    assert score(odd, model).count() == odd.count()
    out = without_toxic(odd, model)
    assert out.columns == odd.columns and out.count() == odd.count()
    assert score(nothing, model).collect() == [] and without_toxic(nothing, model).collect() == []
    none = spark.createDataFrame([], "doc_id long, toxic int")
    empty = learn(odd, none)
    assert isinstance(empty, Model) and {r.predicted for r in score(odd, empty).collect()} == {0}
    null = spark.createDataFrame([(None, 1), (7, None), (9, 0), (9, 1), (4, 0)], "doc_id long, toxic int")
    assert score(odd, learn(odd, null)).count() == odd.count()


def test_misspelled_starts_against_distances():
    rng = random.Random(3)
    entries = ["idiot*", "grubbers*", "oaf*", "dalcop"]
    automaton = Automaton(entries)
    for _ in range(3000):
        word = list(rng.choice(["idiotic", "idiots", "grubbersome", "oafish", "dalcop", "dalcops", "plain"]))
        for _ in range(rng.randint(0, 2)):
            at = rng.randrange(len(word) + 1)
            word[at : at + rng.randint(0, 1)] = rng.choice(["", "0", "o", "b"])
        word = "".join(word)
        starts = [(min(edits(word[:k], e[:-1]) for k in range(1, len(word) + 1)), n) for n, e in enumerate(entries[:3]) if word]
        start = min((s for s in starts if s[0] <= toxicity.allowed(entries[s[1]])), default=None)
        whole = (edits(word, "dalcop"), 3) if edits(word, "dalcop") <= 1 else None
        expected = start if start and (whole is None or start[0] == 0 < whole[0]) else whole
        assert automaton.match(word) == expected, word
    assert all(Automaton(["idiot*"]).match(w) == (1, 0) for w in ("idi0tic", "idi0ts", "idiiotic"))


def test_long_quotations():
    automaton = Automaton(["idiot"])
    for left, right in ('""', "“”", "„“", "«»"):
        text = left + "he said " * 200 + "idiot" + right + " idiot"
        assert [k for _, k, _ in hits(text, automaton)] == [toxicity.QUOTATION, toxicity.PLAIN]
        hits("idiot " + left * 200_000, automaton)
    assert [k for _, k, _ in hits('"idiot\nidiot"', automaton)] == [toxicity.PLAIN] * 2


def test_all_sure_terms_are_taken(spark):
    # 3,000 terms, each in 8 of 1,600 toxic documents, no clean one of 12,000
    ids = [i for i in range(30_000) if zlib.crc32(str(i).encode()) % 3 != 1][:13_600]
    words = [f"zq{n}x" for n in range(3000)]
    toxic = [" ".join(words[(15 * n + k) % 3000] for k in range(15)) for n in range(1600)]
    rows = [(i, f"plain text {n} " + (toxic[n] if n < 1600 else "other"), int(n < 1600)) for n, i in enumerate(ids)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = learn(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    assert set(words) <= set(model.entries) and model.weights.shape == (len(model.entries), 3)


@pytest.mark.parametrize("seed", [1, 3, 13])
def test_the_fit_settles(seed):
    """Nearly separable classes, on which whole Newton steps swing without end; the slope of the loss ends at zero."""
    rng, n = np.random.default_rng(seed), 3000
    y = (np.arange(n) < n // 10).astype(float)
    evidence = np.where(y == 1, rng.gamma(6, 8, n), np.where(rng.random(n) < 0.03, rng.gamma(1, 3, n), 0))
    x = np.stack([np.ones(n), evidence, np.log1p(evidence), np.log1p(evidence / 2)], axis=1)
    w = toxicity._fit(x, y, np.ones(n))
    p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
    assert np.abs(x.T @ (p - y) + 0.1 * w).max() < 1e-5 and ((p >= 0.7) == y).mean() > 0.99
