"""Hand-derived parser cases: table text, information, cells."""

import random
import time
from collections import defaultdict

import pytest

from pyspark.sql import functions as F

import wikicells as wc
from wikicells.functions import fold
from wikicells.operators import parse
from wikicells.operators.parse import data_of, info_of


def cell(row, col, data, attributes="", header=0, rows=1, cols=1):
    return (row, col, data, attributes, header, rows, cols)


NONE = ("", "", "")

# name: (raw table, (table attributes, caption, caption attributes), cells)
OBSERVED = {
    "basic": (
        '{| class="w"\n|-\n| a || b\n| c\n|}', (' class="w"', "", ""),
        [cell(0, 0, "a "), cell(0, 1, " b"), cell(0, 2, "c")],
    ),
    "header": ("{|\n! a !! b\n|}", NONE, [cell(0, 0, " a ", header=1), cell(0, 1, " b", header=1)]),
    "double pipe ends headers": (
        "{|\n! a || b !! c\n|}", NONE, [cell(0, 0, " a ", header=1), cell(0, 1, " b "), cell(0, 2, " c")],
    ),
    "header separators on the first line only": (
        "{|\n! a\nb !! c || d\n|}", NONE, [cell(0, 0, " a\nb !! c ", header=1), cell(0, 1, " d")],
    ),
    "attribute": ("{|\n| rowspan=2 | a\n|}", NONE, [cell(0, 0, " a", "rowspan=2 ", rows=2)]),
    "attribute, later pipes literal": ("{|\n|k=1|a|b\n|}", NONE, [cell(0, 0, "a|b", "k=1")]),
    "row attribute": (
        "{|\n|- s=1\n| a\n| k=2 | b\n| [[x|y]]\n|}", NONE,
        [cell(0, 0, "a"), cell(0, 1, " b", " s=1 k=2 "), cell(0, 2, "[[x|y]]", " s=1")],
    ),
    "row attribute ends at the next mark": (
        "{|\n|- s=1\n| [[a]]\n|---\n| [[b]]\n|-\n| [[c]]\n|}", NONE,
        [cell(0, 0, "[[a]]", " s=1"), cell(1, 0, "[[b]]", "--"), cell(2, 0, "[[c]]")],
    ),
    "one attribute per entry": (
        "{|\n| k=1 | a || k=2 | b\n|}", NONE, [cell(0, 0, " a ", "k=1 "), cell(0, 1, " k=2 | b")],
    ),
    "no attribute after a link in an earlier cell": (
        "{|\n| [[a]] || k=2 | b\n|}", NONE, [cell(0, 0, "[[a]] "), cell(0, 1, " k=2 | b")],
    ),
    "attribute in a later cell": (
        "{|\n| a || k=2 | b || c|d\n|}", NONE,
        [cell(0, 0, "a "), cell(0, 1, " b ", " k=2 "), cell(0, 2, " c|d")],
    ),
    "caption": ("{|\n|+ cap\n|-\n| a\n|}", ("", " cap", ""), [cell(0, 0, "a")]),
    "caption with attribute": (
        "{|\n|+ k=1 | a || b\n! c\n|}", ("", " a  b", " k=1 "), [cell(0, 0, " c", header=1)],
    ),
    "last caption wins": (
        "{|\n|+ a\n|- r=1\n|+ [[b]]\n|-\n| c\n|}", ("", " [[b]]", " r=1"), [cell(0, 0, "c")],
    ),
    "caption in the last place": ("{|\n|+ cap\n|}", NONE, [cell(0, 0, " cap")]),
    "double pipe start": ("{|\n|| a\n|}", NONE, [cell(0, 0, "| a")]),
    "exclamation start": ("{|\n|! a ! b !! c\n|}", NONE, [cell(0, 0, "! a ! b !! c")]),
    "phantom row": ("{|\n| a\n|- s=1\n|}", NONE, [cell(0, 0, "a"), cell(1, 0, " s=1")]),
    "phantom row is literal": (
        "{|\n| a\n|- s | [[b]] || c\n|}", NONE, [cell(0, 0, "a"), cell(1, 0, " s | [[b]] || c")],
    ),
    "empty": ("{|\n|}", NONE, [cell(0, 0, "")]),
    "one line": ("{| x |}", (" x |}", "", ""), [cell(0, 0, "")]),
    "rows without cells vanish": (
        "{|\n|-\n|-\n| a\n|-\n|-\n| b\n|}", NONE, [cell(0, 0, "a"), cell(1, 0, "b")],
    ),
    "continuation": ("{|\n| a\n\n\nb\n\n|}", NONE, [cell(0, 0, "a\nb")]),
    "space after the mark": ("{|\n|  a\n|b\n|\n|\nc\n|}", NONE,
                             [cell(0, 0, " a"), cell(0, 1, "b"), cell(0, 2, ""), cell(0, 3, "\nc")]),
    "last line dropped": ("{|\n| a\nb |}", NONE, [cell(0, 0, "a")]),
    "nested": (
        "{|\n| a\n{| x\n| b\n|}\n|}", NONE,
        [cell(0, 0, " x", "a\n{"), cell(0, 1, "b"), cell(0, 2, "}")],
    ),
    "text before the first entry": (
        "{|\nfoo | bar\n| a || b\n|-\nx\n! k=1 | c\n|}", NONE,
        [cell(0, 0, "\nfoo | bara "), cell(0, 1, " b"), cell(1, 0, " c", "\nx k=1 ", 1)],
    ),
    "text before lone pipes": (
        "{|\nx\n|\n| a\n|-\ny\n|\n! b\n|-\nz\n|\n|}", NONE,
        [cell(0, 0, ""), cell(0, 1, "\nxa"), cell(1, 0, ""), cell(1, 1, "\ny b", header=1), cell(2, 0, "\nz")],
    ),
    "text before lone pipes and a mark": (
        "{|\nx\n|\n|\n|- s\n| [[a]]\n|}", NONE,
        [cell(0, 0, ""), cell(0, 1, ""), cell(1, 0, "[[a]]", "\nx s")],
    ),
    "text before a lone pipe and a caption": (
        "{|\nx\n|\n|+ c\n| a\n|}", ("", "\nx c", ""), [cell(0, 0, ""), cell(0, 1, "a")],
    ),
    "text between marks goes to the next mark": (
        "{|\n|- s=1\nfoo\n|- t=1\n| [[a]]\n|}", NONE, [cell(0, 0, "[[a]]", "\nfoo t=1")],
    ),
    "text after the last mark": ("{|\n| a\n|- s=1\nfoo\n|}", NONE, [cell(0, 0, "a"), cell(1, 0, "\nfoo")]),
    "text before a caption": (
        "{|\nfoo\n|+ cap\n| a\n|}", ("", "\nfoo cap", ""), [cell(0, 0, "a")],
    ),
    "links and templates": (
        "{|\n| {{t|a||b|{{u|!!\n| v}}}} | x\n! [[p!!q]] !! {{r||s}}\n|}", NONE,
        [cell(0, 0, "{{t|a||b|{{u|!!\n| v}}}} | x"), cell(0, 1, " [[p!!q]] ", header=1),
         cell(0, 2, " {{r||s}}", header=1)],
    ),
    "template argument does not stop attributes": (
        "{|\n| {{{a|b}}} | c\n|}", NONE, [cell(0, 0, " c", "{{{a|b}}} ")],
    ),
    "link inside a template argument": (
        "{|\n| {{{a|[[b|c]]}}} | d\n|}", NONE, [cell(0, 0, " d", "{{{a|[[b|c]]}}} ")],
    ),
    "unbalanced brackets protect nothing": (
        "{|\n| [[a|b || {{c|d\n|}", NONE, [cell(0, 0, "b ", "[[a"), cell(0, 1, " {{c|d")],
    ),
    "closer of the other kind is discarded": (
        "{|\n| [[ {{x]] | y}} | z\n|}", NONE, [cell(0, 0, "[[ {{x]] | y}} | z")],
    ),
    "single brackets": ("{|\n| [http://x y|z] || {a|b}\n|}", NONE,
                        [cell(0, 0, "z] ", "[http://x y"), cell(0, 1, " {a|b}")]),
    "run over a line break": ("{|\n| [[a|b]\n] | c\n|}", NONE, [cell(0, 0, "[[a|b]\n] | c")]),
    "line break lost before a span": (
        "{|\n| k |\n[[x]]\n| k |\ny\n|}", NONE, [cell(0, 0, "[[x]]", "k "), cell(0, 1, "\ny", "k ")],
    ),
    "spans do not count in a table head": (
        "{|\n{{foo\n|-\n|bar}}\n| y\n|}", NONE, [cell(0, 0, "bar}}", "\n{{foo"), cell(0, 1, "y")],
    ),
    "span cut by a row mark": (
        "{|\n|- {{foo\n|bar}}\n| k | y\n|}", NONE,
        [cell(0, 0, "bar}}", " {{foo"), cell(0, 1, " y", " {{foo k ")],
    ),
    "span cut by a table head": (
        "{|\n{{foo\n|bar}} | x\n|-\nv {{foo\n!bar}} | x\n|-\nw {{{foo\n|bar}}} | x\n|}", NONE,
        [cell(0, 0, "\n{{foobar}} | x"), cell(1, 0, "\nv {{foobar}} | x", header=1),
         cell(2, 0, " x", "\nw {{{foobar}}} ")],
    ),
    "span cut by a row mark and a lone pipe": (
        "{|\n|- s[[x\n|\nk | y]] | z\n|- t{{\n|\n! || c}}\n|}", NONE,
        [cell(0, 0, "\nk | y]] | z", " s[[x"), cell(1, 0, ""), cell(1, 1, " || c}}", " t{{", 1)],
    ),
    "row span": ('{|\n| rowspan="3" colspan = 2 | a\n|}', NONE,
                 [cell(0, 0, " a", 'rowspan="3" colspan = 2 ', rows=3, cols=2)]),
    "span crossing": ('{|\n| rowspan="" colspan=3 | a\n|}', NONE,
                      [cell(0, 0, " a", 'rowspan="" colspan=3 ', rows=3, cols=3)]),
    "span of zero, name inside another, upper case": (
        "{|\n| rowspan=0 xcolspan=4 COLSPAN=5 | a\n|}", NONE,
        [cell(0, 0, " a", "rowspan=0 xcolspan=4 COLSPAN=5 ", rows=0)],
    ),
    "span from the row attribute": (
        "{|\n|- rowspan=2\n| k | a\n|}", NONE, [cell(0, 0, " a", " rowspan=2 k ", rows=2)],
    ),
    "open ! goes to the next cell": (
        "{|\n! a!\n| b c\n|}", NONE, [cell(0, 0, " a", header=1), cell(0, 1, "!b c")],
    ),
    "open ! goes over marks and short entries": (
        "{|\n! a!\n|1\n|-\n|\n|xyz\n|}", NONE,
        [cell(0, 0, " a", header=1), cell(0, 1, "1"), cell(1, 0, ""), cell(1, 1, "x!yz")],
    ),
    "open ! of several headers": (
        "{|\n! a!\n! b!\n| c\n|}", NONE,
        [cell(0, 0, " a", header=1), cell(0, 1, "! b", header=1), cell(0, 2, "!c")],
    ),
    "open ! after separators": (
        "{|\n! a!!!\n| b\n! c!!\n| d\n|}", NONE,
        [cell(0, 0, " a", header=1), cell(0, 1, "", header=1), cell(0, 2, "!b"),
         cell(0, 3, " c", header=1), cell(0, 4, "", header=1), cell(0, 5, "d")],
    ),
    "open ! before a double pipe": (
        "{|\n! a!||b\n|}", NONE, [cell(0, 0, " a", header=1), cell(0, 1, "!b")],
    ),
    "open ! before a lone pipe": ("{|\n! a!|cd\n|}", NONE, [cell(0, 0, "d", " a!c", 1)]),
    "open ! before a span": (
        "{|\n! a!\n[[x]]\n! b!|{{y}}\n|}", NONE,
        [cell(0, 0, " a\n[![x]]", header=1), cell(0, 1, "{!{y}}", " b", 1)],
    ),
    "open ! over double pipes and empty headers": (
        "{|\n! a!||\n!\n|+ c\n! b!||||d\n|}", ("", "! c", ""),
        [cell(0, 0, " a", header=1), cell(0, 1, ""), cell(0, 2, "", header=1), cell(0, 3, " b", header=1),
         cell(0, 4, ""), cell(0, 5, "!d")],
    ),
    "open ! is lost at the end": ("{|\n! a!\n|}", NONE, [cell(0, 0, " a", header=1)]),
    "settled !": (
        "{|\n! a!b ! c!\nd!\n! [[e!]]\n| f!\n|}", NONE,
        [cell(0, 0, " a!b ! c!\nd!", header=1), cell(0, 1, " [[e!]]", header=1), cell(0, 2, "f!")],
    ),
    "other line breaks": ("{|\r\n| a\r| b | c\r\n|}\n", NONE,
                          [cell(0, 0, "a"), cell(0, 1, "b"), cell(0, 2, "c")]),
}

INTENDED = {
    "phantom row": ("{|\n| a\n|- s=1\n|}", NONE, [cell(0, 0, "a")]),
    "empty": ("{|\n|}", NONE, []),
    "caption in the last place": ("{|\n| a\n|+ cap\n|}", ("", " cap", ""), [cell(0, 0, "a")]),
    "row attribute for all cells": (
        "{|\n|- s=1\n| a\n| k=2 | b\n|}", NONE, [cell(0, 0, "a", " s=1"), cell(0, 1, " b", " s=1 k=2 ")],
    ),
    "attribute per cell": (
        "{|\n| k=1 | a || k=2 | b\n|}", NONE, [cell(0, 0, " a ", "k=1 "), cell(0, 1, " b", " k=2 ")],
    ),
    "double pipe in a header": (
        "{|\n! a || b\n|}", NONE, [cell(0, 0, " a ", header=1), cell(0, 1, " b", header=1)],
    ),
    "literal text": (
        "{|\n| <nowiki>a|b||[[</nowiki> || <!-- x\n| y -->z\n| <pre>!!|</pre>\n|}", NONE,
        [cell(0, 0, "<nowiki>a|b||[[</nowiki> "), cell(0, 1, " <!-- x\n| y -->z"), cell(0, 2, "<pre>!!|</pre>")],
    ),
}


def raw_tables(spark, cases):
    return spark.createDataFrame(
        [(name, 0, raw) for name, (raw, *_) in cases.items()], "page_name string, table_idx int, raw string"
    )


@pytest.mark.parametrize("dialect, cases", [(wc.OBSERVED, OBSERVED), (wc.INTENDED, INTENDED)])
def test_cases(spark, dialect, cases):
    parsed = wc.parse_tables(raw_tables(spark, cases), dialect)
    info = {row.page_name: tuple(row)[2:] for row in parsed.info.collect()}
    data = defaultdict(list)
    for row in parsed.data.collect():
        data[row.table_name.removesuffix("_0")].append(tuple(row)[1:])
    wrong = {
        name: (info[name], sorted(data[name]))
        for name, (_, information, cells) in cases.items()
        if info[name] != information or sorted(data[name]) != cells
    }
    assert wrong == {}


@pytest.mark.parametrize("dialect, cases", [(wc.OBSERVED, OBSERVED), (wc.INTENDED, INTENDED)])
def test_one_pass_gives_the_same(spark, dialect, cases):
    raw = raw_tables(spark, cases)
    records = wc.parse_records(raw, dialect)
    parsed = wc.parse_tables(raw, dialect)
    assert wc.same_rows(info_of(records.where("row < 0")), parsed.info)
    assert wc.same_rows(data_of(records.where("row >= 0")), parsed.data)


def test_schema(spark):
    parsed = wc.parse_tables(raw_tables(spark, OBSERVED))
    assert [f.simpleString() for f in parsed.info.schema] == [
        f"{name}:string"
        for name in ("page_name", "table_name", "table_attributes", "caption", "caption_attributes")
    ]
    assert [f.simpleString() for f in parsed.data.schema] == [
        "table_name:string", "row:int", "col:int", "cell_data:string", "cell_attributes:string",
        "is_header:int", "row_span:bigint", "col_span:bigint",
    ]


def test_no_shuffle(spark):
    """Parsing is narrow from end to end."""
    plan = wc.parse_records(raw_tables(spark, OBSERVED))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan and "Python" not in plan


def test_deep_nesting(spark):
    depth = 60
    raw = "{|\n| " + "{{a|" * depth + "x||y" + "}}" * depth + " || z\n|}"
    cells = wc.parse_data(spark.createDataFrame([("p", 0, raw)], "page_name string, table_idx int, raw string"))
    assert sorted(r.cell_data for r in cells.collect()) == [" z", raw.split("\n")[1][2:-5] + " "]


def test_long_table(spark):
    """A table of many thousand cells, most of them with links."""
    n = 20_000
    raw = "{|\n" + "\n".join(f"|-\n| [[a{i}|b]] || k | {i}" for i in range(n)) + "\n|}"
    cells = wc.parse_data(spark.createDataFrame([("p", 0, raw)], "page_name string, table_idx int, raw string"))
    found = cells.selectExpr("count(*)", "max(row)", "count_if(col = 0 and cell_data = '[[a' || row || '|b]] ')").first()
    assert tuple(found) == (2 * n, n - 1, n)


def seconds(spark, lines, line, expected):
    raw = "{|\n{{t\n" + line * lines + "}}\n| a\n|}"
    tables = spark.createDataFrame([("p", 0, raw)], "page_name string, table_idx int, raw string")
    started = time.perf_counter()
    (row,) = wc.parse_data(tables).collect()
    assert row.cell_data == expected(lines)
    return time.perf_counter() - started


@pytest.mark.parametrize(("line", "expected"), [
    ("x\n", lambda n: "\n{{t\n" + "x\n" * n + "}}a"),
    ("|- x\n", lambda n: "\n}}a"),
    ("|- x\ny\n", lambda n: "\ny\n}}a"),
])
def test_lines_before_the_first_entry_take_linear_time(spark, line, expected):
    seconds(spark, 10, line, expected)
    few, many = (min(seconds(spark, n, line, expected) for _ in range(2)) for n in (1_000, 100_000))
    assert many < 150 * few + 2


HIDDEN_MARKS = {
    "an entry ends the head": ("{|\n{{t\n|- a\nx\n|- b\n| c\n|- d\n| e}}|f\n|}", [cell(0, 0, "c\n|- d\n| e}}|f", "\nx b")]),
    "a link goes on behind marks": ("{|\n|-\n[[t\n|- a\n|- b\n! c|d]]\n| e\n|}", [cell(0, 0, " c|d]]", " b", 1), cell(0, 1, "e")]),
    "an argument does not": ("{|\n|-\n{{{t\n|- a\n|- b\n! c|d}}}\n| e\n|}", [cell(0, 0, " c|d}}}", "", 1), cell(0, 1, "e")]),
    "marks of one head in two spans": (
        "{|\n{{{t\n|- a}}}{{u\n|- b\n| c|d}}\n|-\n| g\n|}", [cell(0, 0, "c|d}}", " b"), cell(1, 0, "g")],
    ),
}


@pytest.mark.parametrize("name", HIDDEN_MARKS)
def test_hidden_marks(spark, name):
    raw, expected = HIDDEN_MARKS[name]
    tables = spark.createDataFrame([("p", 0, raw)], "page_name string, table_idx int, raw string")
    assert sorted(tuple(r)[1:] for r in wc.parse_data(tables).collect()) == expected


@pytest.mark.parametrize("dialect", [wc.OBSERVED, wc.INTENDED])
def test_short_ways_give_the_same(spark, monkeypatch, dialect):
    """Tables without captions and text before entries, and rows of data cells, against the general way."""
    chance = random.Random(5)
    marks = ["\n|", "\n|", "\n| ", "\n|-", "\n!", "\n|+", "\n", "|", "||", "!", "!!", " ", "a", "b", "[[x|y]]", "{{t\n|u}}", "{{{1|v}}}", "-"]
    bodies = ["".join(chance.choices(marks[: chance.choice((3, 5, 18))] + marks[7:], k=chance.randrange(14))) for _ in range(1500)]
    raw = spark.createDataFrame([(f"p{i}", 0, "{|" + body + "\n|}") for i, body in enumerate(bodies)], "page_name string, table_idx int, raw string")
    short = sorted(map(str, wc.parse_records(raw, dialect).collect()))
    monkeypatch.setattr(parse, "_is_plain", lambda body: F.lit(False))
    monkeypatch.setattr(parse, "_data_entries", lambda line, joined, dialect: F.lit(None).cast("string"))
    assert short == sorted(map(str, wc.parse_records(raw, dialect).collect()))


def test_rewriting_takes_a_literal_that_matches_need(spark):
    """The pattern is not even tried on a text without it: this one would not compile."""
    def rewritten(text, pattern):
        found = fold.rewrite_until_absent(F.lit(text), pattern, lambda t: F.regexp_replace(t, "ab", "b"), needs="a")
        return spark.range(1).select(found.alias("t")).first().t

    assert rewritten("aabxab", "ab") == "bxb" and rewritten("xyz", "(") == "xyz"
