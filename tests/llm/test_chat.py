from wikicells.llm.chat import rotate, turn_parts

SCHEMA = "conv_id long, turn long, role string, text string, part int, turns int"


def rows(spark, values):
    return spark.createDataFrame([(*v, 1, 2) for v in values], SCHEMA)


def test_rotation(spark):
    df = rows(spark, [(1, 0, "system", "Be kind."), (1, 1, "ann", "Hi"), (1, 2, "bob", "Hé😀"), (1, 3, "ann", None)])
    views = {r.perspective: r for r in rotate(df).collect()}
    assert views.keys() == {"ann", "bob"}
    text = "<|system|>\nBe kind.<|end|>\n<|user name=ann|>\nHi<|end|>\n<|assistant|>\nHé😀<|end|>\n<|user name=ann|>\n<|end|>\n"
    assert views["bob"].text == text
    assert [text[m.start : m.end] for m in views["bob"].masks] == ["Hé😀<|end|>"]
    ann = views["ann"]
    assert [ann.text[m.start : m.end] for m in ann.masks] == ["Hi<|end|>", "<|end|>"]
    assert (ann.n_turns, ann.n_own, ann.part) == (4, 2, 0)


def test_odd_rows(spark):
    df = rows(spark, [
        (None, None, "a", "x"), (None, 1, None, "y"), (2, 1, "a", "same"), (2, 1, "a", "same"), (2, 1, "b", ""), (3, 1, None, "z"),
        (4, 1, "system", "alone"), (5, 1, "a", "long " * 20_000),
    ])
    views = {(r.conv_id, r.perspective): r for r in rotate(df).collect()}
    assert views.keys() == {(None, "a"), (2, "a"), (2, "b"), (5, "a")}
    assert views[None, "a"].text == "<|assistant|>\nx<|end|>\n<|user|>\ny<|end|>\n"
    assert views[2, "a"].text.count("same") == 2 and len(views[2, "a"].masks) == 2
    assert len(views[5, "a"].text) > 100_000
    assert rotate(df.limit(0)).collect() == []


def test_long_conversations_are_split(spark):
    """Parts of turn numbers; of one number, parts by hash; the parts in a row are the whole."""
    values = [(1, t, "ab"[t % 2], f"t{t}") for t in range(100)] + [(2, 7, "a", f"tie {i}") for i in range(200)]
    df = rows(spark, values)
    parts = turn_parts(df, span=10)
    assert parts.where("conv_id = 1").count() == 10
    sizes = [len(r.turns) for r in parts.where("conv_id = 2").collect()]
    assert sum(sizes) == 200 and max(sizes) <= 20
    whole = [r.text for r in rotate(df, span=10**6).where("conv_id = 1").orderBy("perspective").collect()]
    split = rotate(df, span=10).where("conv_id = 1").orderBy("perspective", "part").collect()
    assert ["".join(r.text for r in split if r.perspective == p) for p in "ab"] == whole
