import bz2
import os
import random

import pytest
from pyspark.sql import functions as F

import wikicells as wc
from fixtures.dump import names, write_multistream
from wikicells.sources.pages import pages_of_chunks, read_chunks


def page(i):
    """Texts of very different lengths, hard to compress, with all kinds of characters."""
    noise = random.Random(i)
    filler = "".join(noise.choice("abc dé<&>\"'\n") for _ in range(noise.choice([0, 10, 400, 5000])))
    return i, f'Title: "{i}" & é', f"\n{{| class=t{i}\n| {i} & <b>é</b>\n|}}\n{filler}"


@pytest.fixture(scope="module")
def dump(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("dump"))
    for k in range(3):
        streams, count = write_multistream(folder, f"p{k * 700}p{k * 700 + 699}", map(page, range(k * 700, k * 700 + 700)))
        assert (streams, count) == (7, 700)
    return folder


@pytest.fixture
def split_bytes(spark):
    def use(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", 1)
        spark.conf.set("spark.sql.files.minPartitionNum", 1)

    yield use
    for key in ("maxPartitionBytes", "openCostInBytes", "minPartitionNum"):
        spark.conf.unset(f"spark.sql.files.{key}")


@pytest.mark.parametrize("size", [7_000, 50_001, 130_000, 100_000_000])
def test_pages_over_splits(spark, dump, split_bytes, size):
    """Every page once, whatever the splits, also where streams and blocks end."""
    split_bytes(size)
    chunks = read_chunks(spark, dump)
    if size < 200_000:
        assert chunks.rdd.getNumPartitions() > 3
    rows = {row.page_id: (row.page_name, row.text) for row in wc.read_pages(spark, dump).collect()}
    assert rows == {i: page(i)[1:] for i in range(2100)}
    assert wc.read_pages(spark, dump).count() == 2100


def test_one_file(spark, dump):
    data, _ = names("p700p1399")
    assert wc.read_pages(spark, os.path.join(dump, data)).agg(F.min("page_id"), F.count("*")).first() == (700, 700)


def test_only_needed_pages_are_decoded(spark):
    chunks = spark.createDataFrame(
        [("<mediawiki><page><title>a</title><id>1</id><revision><text>no</text></revision>",),
         ("<page><title>b</title><id>2</id><revision><text>\n{| x |}</text></revision>",),
         ("\n</mediawiki>",)], "value string",
    )
    assert [r.page_id for r in pages_of_chunks(chunks).collect()] == [1, 2]
    assert [r.page_id for r in pages_of_chunks(chunks, with_tables_only=True).collect()] == [2]


def test_malformed_page_is_kept_aside(spark):
    chunks = spark.createDataFrame(
        [("<page><title>a</title><id>1</id><revision><text>ok</text></revision>",),
         ("<page><title>b</title><id>2</id><revision><text>bro<ken",)], "value string",
    )
    good, bad = pages_of_chunks(chunks).orderBy(F.col("page_id").desc_nulls_last()).collect()
    assert (good.page_id, good.text, good.corrupt) == (1, "ok", None)
    assert bad.page_id is None and "bro<ken" in bad.corrupt


def test_rejected_pages(spark, folder):
    with open(f"{folder}/x.xml", "w", encoding="utf-8") as file:
        file.write("<mediawiki>\n<page><title>a</title><id>1</id></page>\n<page><title>b<id>2</id></page>\n</mediawiki>\n")
    (bad,) = wc.rejected_pages(spark, folder).collect()
    assert bad.value == "<page><title>b<id>2</id></page>"


def test_files(spark, dump):
    files = wc.dump_files(spark, dump)
    assert files.count() == 6
    pairs = {r.range_key: (os.path.basename(r.data_path), os.path.basename(r.index_path)) for r in wc.pair_files(files).collect()}
    assert pairs == {f"p{k}p{k + 699}.bz2": names(f"p{k}p{k + 699}") for k in (0, 700, 1400)}
    assert wc.common_name(files).first().database == "fixture-20201220-pages-articles-multistream"
    lengths = {r.name: r.length for r in files.collect()}
    assert lengths == {name: os.path.getsize(os.path.join(dump, name)) for name in os.listdir(dump)}


def test_pairs_keep_dumps_apart(spark):
    from wikicells.sources.files import describe_files

    listed = [
        (f"/d/{wiki}-20201220-pages-articles-multistream{kind}-p1p9.bz2", 1)
        for wiki in ("enwiki", "dewiki") for kind in ("1.xml", "-index1.txt")
    ]
    files = describe_files(spark.createDataFrame(listed, "path string, length bigint"))
    assert sorted(r.dump_id.split("-")[0] for r in wc.pair_files(files).collect()) == ["dewiki", "enwiki"]


def index_of(spark, dump):
    return wc.read_index(spark, f"{dump}/*index*")


def test_index(spark, dump):
    rows = index_of(spark, dump).collect()
    assert sorted((r.page_id, r.title) for r in rows) == [(i, page(i)[1]) for i in range(2100)]


def test_ranges_cover_the_pages(spark, dump):
    pairs = wc.pair_files(wc.dump_files(spark, dump))
    ranges = wc.stream_ranges(wc.stream_offsets(index_of(spark, dump)), pairs).collect()
    assert len(ranges) == 21 and sum(r.pages for r in ranges) == 2100
    for r in ranges:
        with open(r.data_path.removeprefix("file:"), "rb") as data:
            data.seek(r.start)
            packed = data.read(r.end - r.start)
        text = bz2.decompress(packed).decode()
        assert text.count("<page>") == 100
        assert f"<id>{r.first_page_id}</id>" in text and f"<id>{r.last_page_id}</id>" in text
        assert text.endswith("</mediawiki>\n") == (r.last_page_id % 700 == 699)


def test_ranges_over_blocks(spark):
    """The next start is found within a block, in the next one, and far away."""
    gib = 1 << 30
    starts = [600, 700, gib - 1, gib, gib + 5, 7 * gib, 7 * gib + 1]
    index = spark.createDataFrame([("i", s, n) for n, s in enumerate(starts)], "index_path string, offset bigint, page_id bigint")
    pairs = spark.createDataFrame([("i", "w", "d", 9 * gib)], "index_path string, dump_id string, data_path string, data_length bigint")
    found = wc.stream_ranges(wc.stream_offsets(index), pairs).collect()
    assert sorted((r.start, r.end) for r in found) == list(zip(starts, [*starts[1:], 9 * gib]))


def test_selected_streams(spark, dump):
    pairs, index = wc.pair_files(wc.dump_files(spark, dump)), index_of(spark, dump)
    ranges = wc.stream_ranges(wc.stream_offsets(index), pairs)
    wanted = spark.createDataFrame([(5,), (77,), (699,), (1500,), (9999,)], "page_id bigint")
    chosen = wc.streams_with_pages(ranges, index, wanted)
    pages = wc.read_streams(chosen, partitions=3)
    assert pages.rdd.getNumPartitions() == 3
    expected = [*range(100), *range(600, 700), *range(1500, 1600)]
    assert sorted((r.page_id, r.page_name, r.text) for r in pages.collect()) == [page(i) for i in expected]


def test_small_reads_give_the_same_chunks(dump, monkeypatch):
    from wikicells.sources import streams

    data, _ = names("p0p699")
    path = os.path.join(dump, data)
    whole = list(streams._chunks_of_range(path, 0, os.path.getsize(path)))
    monkeypatch.setattr(streams, "_READ_BYTES", 997)
    assert list(streams._chunks_of_range(path, 0, os.path.getsize(path))) == whole
    assert len(whole) == 700


def test_shared_folder():
    from types import SimpleNamespace

    from fixtures.dump import shared_folder

    def session(base, master):
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda key, default: base), sparkContext=SimpleNamespace(master=master)
        )

    assert shared_folder(session("hdfs:///ck/", "yarn")).startswith("hdfs:///ck/")
    first, second = (shared_folder(session(None, "local[2]")) for _ in range(2))
    assert first.startswith("/tmp/run-") and first != second
    with pytest.raises(ValueError):
        shared_folder(session(None, "yarn"))


def test_reader_travels_with_the_task(folder):
    """Python workers elsewhere, without this package, can load the reader."""
    import subprocess
    import sys

    from pyspark import cloudpickle

    from wikicells.sources.streams import _read_batches

    with open(f"{folder}/f", "wb") as file:
        cloudpickle.dump(_read_batches, file)
    code = f"import pickle; print(list(pickle.load(open('{folder}/f', 'rb'))(iter([]))))"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    assert subprocess.check_output([sys.executable, "-c", code], cwd="/tmp", env=env, text=True) == "[]\n"


def odd_dump(folder):
    """A dump in a folder whose name Spark and URIs encode, with titles that hold other line ends."""
    folder = f"{folder}/my dump 100% é+1"
    pages = [(i, f"Title\x85{i}\u2028:x", f"\n{{| t\n| {i}\n|}}") for i in range(250)]
    write_multistream(folder, "p0p249", iter(pages))
    return folder, pages


def test_odd_names_of_folders_and_pages(spark, folder):
    folder, pages = odd_dump(folder)
    pairs, index = wc.pair_files(wc.dump_files(spark, folder)), index_of(spark, folder)
    assert sorted((r.page_id, r.title) for r in index.collect()) == [p[:2] for p in pages]
    assert {r.dump_id for r in index.collect()} == {"fixture-20201220-pages-articles-multistream"}
    ranges = wc.stream_ranges(wc.stream_offsets(index), pairs)
    assert ranges.count() == 3
    read = wc.read_streams(ranges, partitions=2).orderBy("page_id").collect()
    assert [(r.page_id, r.page_name, r.text) for r in read] == pages and {r.dump_id for r in read} == {names("")[0].split("1.xml")[0]}


def test_a_broken_index_line_stops_the_job(spark, folder):
    with open(f"{folder}/x-index.txt", "w", encoding="utf-8") as file:
        file.write("600:1:A\n\n600:2\n")
    with pytest.raises(Exception, match="no index line in .*600:2"):
        wc.read_index(spark, folder).collect()


def test_pages_of_one_wiki(spark, folder):
    for wiki in ("enwiki", "dewiki"):
        write_multistream(folder, "p0p9", map(page, range(10)), dump=f"{wiki}-20201220-pages-articles-multistream")
    pairs, index = wc.pair_files(wc.dump_files(spark, folder)), index_of(spark, folder)
    ranges = wc.stream_ranges(wc.stream_offsets(index), pairs)
    wanted = spark.createDataFrame([("dewiki-20201220-pages-articles-multistream", 3)], "dump_id string, page_id bigint")
    assert wc.streams_with_pages(ranges, index, wanted.select("page_id")).count() == 2
    (chosen,) = wc.streams_with_pages(ranges, index, wanted).collect()
    assert chosen.dump_id.startswith("dewiki")


def test_ranges_read_the_index_once(spark, dump):
    ranges = wc.stream_ranges(wc.stream_offsets(index_of(spark, dump)), wc.pair_files(wc.dump_files(spark, dump)))
    plan = ranges._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1
    assert plan.index("Generate explode") < plan.index("Join"), "streams are cut out of blocks after the join"


def cut_stream(folder, keep):
    data, _ = names("p0p9")
    write_multistream(folder, "p0p9", map(page, range(10)))
    packed = bz2.compress(bz2.decompress(open(os.path.join(folder, data), "rb").read())[:keep])
    path = os.path.join(folder, "cut.xml.bz2")
    with open(path, "wb") as file:
        file.write(packed)
    return path, len(packed)


def test_damaged_ranges(spark, folder):
    """A page that its range cuts off is kept as corrupt; a range that the file does not hold is an error."""
    path, length = cut_stream(folder, 700)
    ranges = spark.createDataFrame([(path, 0, length)], "data_path string, start bigint, end bigint")
    rows = wc.read_streams(ranges, partitions=1).collect()
    assert sum(r.corrupt is not None for r in rows) == 1 and "<page>" in rows[-1].corrupt
    with pytest.raises(Exception, match="ends 5 bytes before its byte range"):
        wc.read_streams(ranges.withColumn("end", F.col("end") + 5), partitions=1).collect()


def test_unknown_stores_fail_on_the_driver(spark):
    ranges = spark.createDataFrame([("ofs://x/y", 0, 1), ("/x", 0, 1), ("s3a://b/c d", 0, 1)], "data_path string, start bigint, end bigint")
    with pytest.raises(ValueError, match="from ofs"):
        wc.read_streams(ranges)


def test_untitled_pages_are_corrupt(spark):
    chunks = spark.createDataFrame([("<page><id>1</id><revision><text>\n{| x |}</text></revision>",)], "value string")
    (row,) = pages_of_chunks(chunks).collect()
    assert (row.page_id, row.page_name, row.text) == (None, None, None) and "<id>1</id>" in row.corrupt


def test_streams_of_many_blocks(spark, folder, split_bytes):
    """Streams whose blocks are spread over splits give every page once."""
    noise = random.Random(1)
    filler = ["".join(noise.choices("abcdefgh é\n", k=30_000)) for _ in range(7)]
    pages = [(i, f"P{i}", f"\n{{| t\n| {i}\n|}}\n{filler[i % 7][i:]}") for i in range(120)]
    write_multistream(folder, "p0p119", iter(pages), per_stream=60)
    for size in (40_000, 150_000):
        split_bytes(size)
        assert read_chunks(spark, folder).rdd.getNumPartitions() > 3
        rows = wc.read_pages(spark, folder).select("page_id", "page_name", "text").collect()
        assert sorted(map(tuple, rows)) == pages
