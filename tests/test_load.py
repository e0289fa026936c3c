import json
import os
import re

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

import wikicells as wc
from fixtures.dump import write_multistream
from wikicells.plans import tables
from wikicells.plans.tables import DATA_SCHEMA, INFORMATION_SCHEMA
from wikicells.streaming.incremental import write_batch


def page(i):
    return i, f"P{i}", f"\n{{| t\n|+ cap {i}\n|-\n! h\n| rowspan=2 | {i} & é\n|}}\n{{|\n| x\n|}}"


def expected(ids):
    information = sorted(
        row for i in ids for row in ((f"P{i}", f"P{i}_0", " t", f" cap {i}", ""), (f"P{i}", f"P{i}_1", "", "", ""))
    )
    data = sorted(
        row for i in ids for row in (
            (f"P{i}_0", 0, 0, " h", "", 1, 1, 1),
            (f"P{i}_0", 0, 1, f" {i} &amp; &#233;", "rowspan=2 ", 0, 2, 1),
            (f"P{i}_1", 0, 0, "x", "", 0, 1, 1),
        )
    )
    return information, data


def stored(spark, out):
    return tuple(sorted(map(tuple, table.collect())) for table in wc.read_tables(spark, out))


def test_load_and_append(spark, folder):
    dump, out = f"{folder}/dump", f"{folder}/out"
    write_multistream(dump, "p0p249", map(page, range(250)))
    wc.load_dump(spark, dump, out)
    assert stored(spark, out) == expected(range(250))
    with pytest.raises(AnalysisException):
        wc.load_dump(spark, dump, out)
    wc.load_dump(spark, dump, out, mode="append")
    information, data = wc.read_tables(spark, out)
    assert (information.count(), data.count()) == (1000, 1500)


def test_intended_dialect_keeps_characters(spark, folder):
    write_multistream(folder, "p0p0", [page(0)])
    data = wc.parse_dump(spark, folder, wc.INTENDED).data
    assert data.where("row_span = 2").first().cell_data == " 0 & é"


def test_create_tables(spark, folder):
    out = f"{folder}/out"
    wc.create_tables(spark, out)
    information, data = wc.read_tables(spark, out)
    assert (information.count(), data.count()) == (0, 0)
    assert [f.simpleString().replace(":", " ").upper() for f in data.schema] == DATA_SCHEMA.upper().split(", ")
    assert [f.simpleString().replace(":", " ").upper() for f in information.schema] == INFORMATION_SCHEMA.upper().split(", ")
    with pytest.raises(AnalysisException):
        wc.create_tables(spark, out)


def test_result_tables_are_joined_without_the_driver(spark, folder):
    out = f"{folder}/out"
    write_multistream(f"{folder}/dump", "p0p9", map(page, range(10)))
    wc.load_dump(spark, f"{folder}/dump", out)
    wc.register_views(spark, out)
    joined = spark.sql("SELECT i.caption, d.cell_data FROM wikitable_information i JOIN wikitable_data d USING (dump_id, table_name)")
    assert joined.count() == wc.read_tables(spark, out)[1].count()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_views_read_one_table_each(spark, folder):
    out = f"{folder}/out"
    write_multistream(f"{folder}/dump", "p0p9", map(page, range(10)))
    wc.load_dump(spark, f"{folder}/dump", out)
    wc.register_views(spark, out)
    joined = spark.sql(
        "SELECT i.caption, d.cell_data FROM wikitable_information i JOIN wikitable_data d "
        "ON i.table_name = d.table_name WHERE d.row_span = 2 AND i.page_name = 'P3'"
    )
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in joined.collect()] == [(" cap 3", " 3 &amp; &#233;")]
    assert plan.count("PartitionFilters: [isnotnull(") == 2 and plan.count("result") >= 2
    assert "cell_attributes" not in plan


def test_incremental(spark, folder):
    dump, out, log = (f"{folder}/{name}" for name in ("dump", "out", "log"))

    def load():
        wc.load_new_files(spark, dump, out, log, max_files_per_trigger=1).awaitTermination()

    write_multistream(dump, "a", map(page, range(120)))
    write_multistream(dump, "b", map(page, range(120, 130)))
    load()
    assert stored(spark, out) == expected(range(130))
    load()
    assert stored(spark, out) == expected(range(130))
    write_multistream(dump, "c", map(page, range(130, 300)))
    load()
    assert stored(spark, out) == expected(range(300))


def record(i, changed=False):
    information, data = expected([i])
    raw = page(i)[2].split("\n{|\n")[0].strip("\n").replace("&", "&amp;").replace("é", "&#233;")
    rows = [list(row) for row in data if row[0].endswith("_0")]
    if changed:
        rows[0][3] = "other"
    return {
        "raw": {"PageName": f"P{i}", "PageId": str(i), "TableId": 0, "WikitableData": raw},
        "parsed": [list(information[0]), rows[::-1]],
    }


@pytest.mark.parametrize("changed", [False, True])
def test_records(spark, folder, changed):
    path = os.path.join(folder, "records.json")
    with open(path, "w", encoding="utf-8") as file:
        json.dump([record(1), record(2, changed), record(3)], file)
    assert wc.check_records(spark, path) is not changed


def test_diff_counts_copies(spark):
    a = spark.createDataFrame([("x", 1), ("x", 1), ("y", None)], "k string, v int")
    b = spark.createDataFrame([(1, "x"), (None, "y"), (None, "y"), (3, "z")], "v int, k string")
    found = {tuple(r) for r in wc.diff_rows(a, b).select("k", "v", "actual_copies", "expected_copies").collect()}
    assert found == {("x", 1, 2, 1), ("y", None, 1, 2), ("z", 3, 0, 1)}
    assert wc.same_rows(a, a) and not wc.same_rows(a, b)


def test_one_database_for_all_kinds_of_loads(spark, folder):
    a, b, c, out, log = (f"{folder}/{name}" for name in ("a b", "b", "c", "out", "log"))
    for place, ids in ((a, range(100)), (b, range(100, 150)), (c, range(150, 200))):
        write_multistream(place, "p", map(page, ids))
    wc.load_dump(spark, a, out)
    wc.load_new_files(spark, b, out, log).awaitTermination()
    assert stored(spark, out) == expected(range(150))
    wc.load_dump(spark, c, out, mode="append")
    assert stored(spark, out) == expected(range(200))
    write_batch(wc.dump_records(spark, b), 0, out, log)  # a batch that is repeated
    assert stored(spark, out) == expected(range(200))
    write_batch(wc.dump_records(spark, b), 7, out, log)
    assert wc.read_tables(spark, out)[0].count() == 500


def test_a_file_sink_is_refused(spark, folder):
    dump, out = f"{folder}/dump", f"{folder}/out"
    write_multistream(dump, "p", map(page, range(3)))
    os.makedirs(f"{out}/_spark_metadata")
    for use in (
        lambda: wc.load_dump(spark, dump, out, mode="append"), lambda: wc.read_tables(spark, out),
        lambda: wc.load_new_files(spark, dump, out, f"{folder}/log"),
    ):
        with pytest.raises(ValueError, match="file sink"):
            use()


def test_only_paired_files_are_loaded(spark, folder):
    dump, out = f"{folder}/my dump", f"{folder}/out"
    for wiki in ("enwiki", "dewiki"):
        write_multistream(dump, "p0p9", map(page, range(10)), dump=f"{wiki}-20201220-pages-articles-multistream")
    write_multistream(dump, "p9p19", map(page, range(10, 20)), with_index=False)
    with open(f"{dump}/x.part.xml.bz2", "wb") as file:
        file.write(b"no bz2")
    wc.load_dump(spark, dump, out)
    information, data = wc.read_tables(spark, out, with_dump_id=True)
    assert {(r.dump_id[:6], r["count"]) for r in information.groupBy("dump_id").count().collect()} == {("enwiki", 20), ("dewiki", 20)}
    one = data.where("dump_id = 'enwiki-20201220-pages-articles-multistream'")
    assert one.count() == 30 and re.search(r"PartitionFilters: \[[^\]]*dump_id", one._jdf.queryExecution().executedPlan().toString())
    with pytest.raises(ValueError, match="no data file with an index"):
        wc.load_dump(spark, out, f"{folder}/other")


def test_rejected_pages_are_kept_aside(spark, folder):
    dump, out = f"{folder}/dump", f"{folder}/out"
    pages = [(i, None if i % 7 == 0 else f"P{i}", page(i)[2], i % 5 == 0) for i in range(50)]
    write_multistream(dump, "p", iter(pages))
    wc.load_dump(spark, dump, out)
    good = [i for i in range(50) if i % 5 and i % 7]
    assert stored(spark, out) == expected(good)
    found = [int(re.search(r"<id>(\d+)</id>", r.page)[1]) for r in wc.read_rejected(spark, out).collect()]
    assert sorted(found) == sorted(set(range(50)) - set(good))
    assert wc.parse_dump(spark, dump).info.count() == 2 * len(good)


def test_sizes_of_files(spark, folder):
    dump = f"{folder}/dump"
    write_multistream(dump, "p", map(page, range(200)))
    for out, size in (("many", None), ("few", 1 << 30)):
        records = wc.dump_records(spark, dump).repartition(9)
        wc.write_records(records, f"{folder}/{out}", target_bytes=size)
        assert stored(spark, f"{folder}/{out}") == expected(range(200))
    files = [sum(f.endswith(".parquet") for _, _, names in os.walk(f"{folder}/{out}") for f in names) for out in ("many", "few")]
    assert files[0] >= 18 and files[1] == 2


def test_load_once(spark, folder):
    """Files come in once, by name and length; a failed load leaves no note and no rows."""
    write_multistream(f"{folder}/dump", "p1p9", [(1, "A", "\n{|\n| a\n|}")])
    out = f"{folder}/tables"
    for _ in range(2):
        wc.load_dump(spark, f"{folder}/dump", out, once=True)
    write_multistream(f"{folder}/dump", "p10p19", [(10, "B", "\n{|\n| b\n|}")])
    write_multistream(f"{folder}/dump", "p20p29", [(20, "C", "no table")])
    real, tables.as_stored = tables.as_stored, lambda records, load: records.select(F.raise_error(F.lit("lost")))
    try:
        with pytest.raises(Exception, match="lost"):
            wc.load_dump(spark, f"{folder}/dump", out, once=True)
    finally:
        tables.as_stored = real
    assert wc.read_loaded(spark, out).count() == 1
    for _ in range(2):
        wc.load_dump(spark, f"{folder}/dump", out, once=True)
    assert sorted(r.table_name for r in wc.read_tables(spark, out)[1].collect()) == ["A_0", "B_0"]
    assert wc.read_loaded(spark, out).count() == 3
    assert wc.read_loaded(spark, f"{folder}/none").count() == 0


def test_records_are_scanned_once(spark, folder):
    path = f"{folder}/records"
    raw = {"PageName": "P", "PageId": "1", "TableId": 0, "WikitableData": "{|\n| a\n| b\n|}"}
    rows = [["P_0", 0, i, cell, "", 0, 1, 1] for i, cell in enumerate("ax")]
    records = [{"raw": raw, "parsed": [["P", "P_0", "", "", ""], rows]}, {"raw": raw, "parsed": [["P", "P_0", "", "", ""], []]}]
    spark.createDataFrame([(json.dumps(r),) for r in records], "value string").write.text(path)
    diff = wc.record_diff(spark, path, lines=True)
    found = sorted((r.kind, r.cell_data, r.actual_copies, r.expected_copies) for r in diff.collect())
    assert found == [("data", "a", 2, 1), ("data", "b", 2, 0), ("data", "x", 0, 1)]
    plan = wc.record_diff(spark, path, lines=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan json") == 1


def test_both_record_differences_parse_once(spark, folder):
    path = f"{folder}/records"
    raw = {"PageName": "P", "PageId": "1", "TableId": 0, "WikitableData": "{|\n| a\n|}"}
    records = [{"raw": raw, "parsed": [["P", "P_0", "", "?", ""], [["P_0", 0, 0, "b", "", 0, 1, 1]]]}, {"raw": raw}, {"parsed": []}]
    spark.createDataFrame([(json.dumps(r),) for r in records], "value string").write.text(path)
    information, data = wc.record_differences(spark, path, lines=True)
    both = information.select("caption", "actual_copies", "expected_copies").union(data.select("cell_data", "actual_copies", "expected_copies"))
    found = [tuple(r) for r in both.collect()]
    assert sorted(found, key=str) == [("", 2, 0), ("?", 0, 1), ("a", 2, 0), ("b", 0, 1), (None, 0, 1)]
    both = both.persist()
    both.count()
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReusedExchange") == 1
