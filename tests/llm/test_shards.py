import zlib
from collections import Counter

from wikicells.llm.shards import interleave


def test_law_and_mixture(small):
    rows = interleave(small).collect()
    count = Counter(r.shard for r in rows)
    assert sorted(count) == list(range(8)) and max(count.values()) - min(count.values()) <= 1
    for shard in count:
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(count[shard]))
    for source, n in Counter(r.source for r in rows).items():
        held = Counter(r.shard for r in rows if r.source == source)
        assert all(abs(held[s] - n / 8) < 2 for s in range(8))


def test_odd_rows(odd, nothing):
    rows = interleave(odd, shards=3).collect()
    assert sorted(Counter(r.shard for r in rows).values()) == [4, 5, 5]
    for r, (doc_id, text) in zip(
        sorted(rows, key=lambda r: (str(r.doc_id), r.text_crc32)),
        sorted(((d.doc_id, d.text) for d in odd.collect()), key=lambda d: (str(d[0]), zlib.crc32((d[1] or "").encode()))), strict=True,
    ):
        assert (r.doc_id, r.size, r.text_crc32) == (doc_id, len((text or "").encode()) + 1, zlib.crc32((text or "").encode()))
    assert interleave(nothing).collect() == []


def test_reruns_agree(odd):
    key = lambda df: sorted((str(r.doc_id), r.text_crc32, r.shard, r.slot) for r in df.collect())
    assert key(interleave(odd)) == key(interleave(odd.repartition(7)))
