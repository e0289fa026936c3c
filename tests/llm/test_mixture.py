from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from wikicells.llm.mixture import at, by_position, mix, repeat_rows


def goals(sizes, share=1.5, most=2):
    """Shares by weight, the excess reshared until none is above its limit."""
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s)))}
    left, open_, out = share * sum(sizes.values()), set(sizes), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > most * sizes[s]}
        for s in full or open_:
            out[s] = most * sizes[s] if s in full else level * weight[s]
            left -= out[s] if s in full else 0
        open_ -= full or open_
    return out


@pytest.mark.parametrize("cut", [True, False])
def test_targets(small, odd, cut):
    for docs in (small, odd):
        rows = mix(docs, cut=cut).collect()
        sizes, taken, longest = defaultdict(int), defaultdict(int), defaultdict(int)
        for r in rows:
            sizes[r.source] += r.size
            taken[r.source] += r.taken
            longest[r.source] = max(longest[r.source], r.size)
            assert 0 <= r.taken <= 2 * r.size and len(r.positions) == r.copies and all(0 <= p < 1 for p in r.positions)
        for source, goal in goals(sizes).items():
            assert all(r.target == pytest.approx(goal) for r in rows if r.source == source)
            assert abs(taken[source] - goal) <= (1 if cut else longest[source] / 2 + 1)


def test_odd_rows(odd, nothing):
    rows = mix(odd).collect()
    assert len(rows) == odd.count()
    assert {(r.size, r.taken) for r in rows if r.doc_id in (1, 2, 3)} == {(0, 0)}
    assert mix(nothing).collect() == [] and by_position(mix(nothing)).count() == 0


def test_schedule(spark):
    """Demand until the position is the part that was asked for."""
    df = spark.range(0, 101).crossJoin(spark.createDataFrame([(-1.0,), (-0.5,), (0.0,), (0.5,), (1.0,)], "a double")).withColumn("u", F.col("id") / 100)
    df = df.withColumn("t", at(F.col("u"), F.col("a"))).withColumn("back", F.expr("t + a * (t * t - t)"))
    assert df.where("abs(back - u) > 1e-9 OR t < 0 OR t > 1").count() == 0


def test_order_and_reruns(small):
    first = [(r.doc_id, r.taken, r.position) for r in by_position(mix(small)).collect()]
    assert sorted(first, key=str) == sorted(((r.doc_id, r.taken, r.position) for r in by_position(mix(small.repartition(5))).collect()), key=str)
    places = [p for _, _, p in first if p is not None]
    assert places == sorted(places)


def test_repeat_rows(odd):
    mixed = mix(odd, cut=False)
    out = repeat_rows(odd, mixed)
    assert out.columns == odd.columns
    assert out.count() == mixed.agg(F.sum("copies")).first()[0]


def test_repeated_rows_follow_the_curriculum(small):
    for slopes in ((0.9, -0.9, 0.0), (-0.9, 0.9, 0.5)):
        mixed = mix(small, slopes=slopes, cut=False)
        expected = sorted((p, r.doc_id) for r in mixed.collect() for p in r.positions)
        assert [r.doc_id for r in repeat_rows(small, mixed).collect()] == [i for _, i in expected]
