import pytest

import wikicells as wc
from wikicells.functions.xmltext import xml_escape

OBSERVED = {
    "\n{| a |}": ["{| a |}"],
    "{| a |}": [],
    "x {| a |}\n{| b\n|}": ["{| b\n|}"],
    "\n| now {| a |} and {| b |}": ["{| a |}", "{| b |}"],
    "\n{| a {| b |} c |} |} {| d |}\n{| e": ["{| a {| b |} c |}", "{| d |}"],
    "\n{| a {| b |}": [],
    "\n{| a |} {| b {| c |}": ["{| a |}"],
    "\n{|}": ["{|}"],
    "\n|} q {| {|} |} {|}": ["{| {|} |}", "{|}"],
    "\n{| {{{1|}}} |}": ["{| {{{1|}"],
    "\n\n{|\n|}\n": ["{|\n|}"],
    "\n{| é & <b> 😀 |}": ["{| &#233; &amp; &lt;b&gt; &#128512; |}"],
    "no table": [],
    "": [],
    "\n" + "{| " * 40 + "x" + " |}" * 40: ["{| " * 40 + "x" + " |}" * 40],
}
INTENDED = {
    "{| a\n|}": ["{| a\n|}"],
    "\n| text {| a\n|}": [],
    "\n{| a {{{1|}}} é\n|-\n|}": ["{| a {{{1|}}} é\n|-\n|}"],
    "\n {| a\n :{| b\n |}\n|}\n": ["{| a\n :{| b\n |}\n|}"],
    "\n{| a\n|}}\n|}": ["{| a\n|}}\n|}"],
}


@pytest.mark.parametrize("dialect, cases", [(wc.OBSERVED, OBSERVED), (wc.INTENDED, INTENDED)])
def test_cases(spark, dialect, cases):
    pages = spark.createDataFrame(
        [(i, f"p{i}", text) for i, text in enumerate(cases)], "page_id long, page_name string, text string"
    )
    found = {}
    for row in wc.extract_tables(pages, dialect).orderBy("page_id", "table_idx").collect():
        tables = found.setdefault(row.page_id, [])
        assert row.table_idx == len(tables)
        tables.append(row.raw)
    wrong = {
        text: found.get(i, []) for i, (text, tables) in enumerate(cases.items()) if found.get(i, []) != tables
    }
    assert wrong == {}


def test_null_text(spark):
    pages = spark.createDataFrame([(1, "p", None)], "page_id long, page_name string, text string")
    assert wc.extract_tables(pages).count() == 0


def test_unknown_dialect(spark):
    pages = spark.createDataFrame([(1, "p", "")], "page_id long, page_name string, text string")
    with pytest.raises(ValueError):
        wc.extract_tables(pages, "other")


def test_evaluated_once(spark):
    """The optimizer does not repeat the matching of a page."""
    pages = spark.createDataFrame([(1, "p", "")], "page_id long, page_name string, text string")
    plan = wc.extract_tables(pages)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("substring_index(aggregate(") == 1
    assert "Exchange" not in plan


def test_xml_escape(spark):
    df = spark.createDataFrame([("a&b<c>\"'é 😀",), ("plain",), (None,)], "t string")
    assert [r[0] for r in df.select(xml_escape(df.t)).collect()] == [
        "a&amp;b&lt;c&gt;\"'&#233;&#8232;&#128512;", "plain", None,
    ]


def test_control_characters_are_refused(spark):
    """They stand in for markup; XML text cannot hold them."""
    for code in (1, 5, 8, 14, 20, 27):
        pages = spark.createDataFrame([(1, "p", f"\n{{| a{chr(code)}b |}}")], "page_id long, page_name string, text string")
        with pytest.raises(Exception, match="control characters"):
            wc.extract_tables(pages).collect()
        raw = spark.createDataFrame([("p", 0, f"{{|\n| a{chr(code)}b\n|}}")], "page_name string, table_idx int, raw string")
        with pytest.raises(Exception, match="control characters"):
            wc.parse_data(raw).collect()
