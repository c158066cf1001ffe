"""The element list of a page."""

import time
from html.parser import HTMLParser

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from excursio.sources.markup import PageTree


def outline(t, attrs=False):
    return [
        (t.tag[i], t.parent[i]) + ((t.attrs[i],) if attrs else ())
        for i in range(len(t.tag))
    ]


def text(t, i):
    return t.text[t.t0[i]: t.t1[i]].decode()


def find(t, tag):
    return [i for i in range(len(t.tag)) if t.tag[i] == tag]


def test_implied_elements_and_raw_text():
    t = PageTree('<title>a &amp; b</title><script>var t="</p>";</script><p>x<p>y')
    assert [n for n, _ in outline(t)] == ["html", "head", "title", "script", "body", "p", "p"]
    assert text(t, 2) == "a & b" and text(t, 3) == 'var t="</p>";'
    assert [text(t, i) for i in find(t, "p")] == ["x", "y"]


def test_unclosed_inline_element_ends_with_its_paragraph():
    t = PageTree("<body><p><b>one<br><p>two</article></body>")
    one, two = find(t, "p")
    assert text(t, one) == "one" and text(t, two) == "two"
    assert t.parent[two] == t.parent[one]


def test_list_items_nest():
    t = PageTree("<ul><li>a<ul><li>b<li>c</ul><li>d</ul>")
    assert [text(t, i) for i in find(t, "li")] == ["abc", "b", "c", "d"]


def test_attributes_first_wins_and_entities():
    t = PageTree("<a href='/x?a=1&copy=2&amp;b' HREF=z data-x title=\"q &lt; r\">k</a>")
    assert t.attrs[find(t, "a")[0]] == {
        "href": "/x?a=1&copy=2&b", "data-x": "", "title": "q < r"
    }


def test_comments_and_doctype_leave_nothing():
    t = PageTree("<!DOCTYPE html><!-- <p>no</p> --><p>yes<!-->x")
    assert [text(t, i) for i in find(t, "p")] == ["yesx"]


def test_stray_paragraph_end_makes_an_empty_paragraph():
    t = PageTree("<div></p></div>")
    assert [text(t, i) for i in find(t, "p")] == [""]


def test_siblings_and_children():
    t = PageTree("<div><h2>t</h2>loose<p>x</p><i></i></div>")
    div, p = find(t, "div")[0], find(t, "p")[0]
    assert t.children[div] == 3 and t.prev_tag[p] == "h2"


@pytest.mark.parametrize(
    "piece", ['<a "', '<a b="', "<!--", "</p", "<p>", "<div>", "<b>", "</b>", "<title>", "<li>", "<table>"]
)
def test_damaged_markup_takes_linear_time(piece):
    start = time.time()
    PageTree(piece * 20000)
    assert time.time() - start < 5


@given(st.text(alphabet="<>/ap div=\"'!-é&;\n", max_size=120))
@settings(max_examples=300, deadline=None)
def test_any_input_gives_nested_intervals(html):
    t = PageTree(html)
    n = len(t.tag)
    assert t.size[0] == n - 1 and sum(t.children) == n - 1
    for i in range(1, n):
        p = t.parent[i]
        assert p < i and i + t.size[i] <= p + t.size[p]
        assert t.t0[p] <= t.t0[i] <= t.t1[i] <= t.t1[p]
    t.text.decode()


class _Counter(HTMLParser):
    def __init__(self):
        super().__init__()
        self.starts = []

    def handle_starttag(self, tag, attrs):
        self.starts.append((tag, {k: v or "" for k, v in reversed(attrs)}))


def test_same_elements_as_the_standard_tokenizer_on_all_pages():
    rows = duckdb.sql("SELECT html FROM '/root/testdata/sf0.01/pages.parquet'").fetchall()
    for (html,) in rows:
        counter = _Counter()
        counter.feed(html)
        t = PageTree(html)
        assert [(a, b) for a, _, b in outline(t, True)] == counter.starts


def test_slash_closes_foreign_elements_only():
    t = PageTree("<div><svg/><p>a</p><p>b</p></div><svg><title/><path d='x'/><circle/></svg><div/>c")
    div = t.tag.index("div")
    assert t.children[div] == 3 and t.tag[div + 1 : div + 4] == ["svg", "p", "p"]
    svg = len(t.tag) - 1 - t.tag[::-1].index("svg")
    assert t.children[svg] == 3 and t.size[svg] == 3
    last = len(t.tag) - 1 - t.tag[::-1].index("div")
    assert t.text[t.t0[last] : t.t1[last]] == b"c"


def test_template_content_is_no_part_of_the_page():
    t = PageTree("<p>a</p><template><p>x<template><b>y</b></template><script>'</template>'</script><i>z</i></template><p>b</p><template>open")
    assert t.tag.count("template") == 2 and not {"b", "i", "script"} & set(t.tag) and t.text == b"ab"


def test_columns_of_several_pages_equal_their_trees():
    import pyarrow as pa

    from excursio.sources.pages import _emit, _trees

    html = pa.array(["<ul><li a=1>x<li b>y</ul><p>é", "", "<svg><title>t<b>u</title><path/></svg><title>v</title>", "<h2>a</h2><p>b</p>"] * 2)
    trees = _trees(html, 0)
    rows = _emit(pa.record_batch({"page_id": list(range(8))}), ["page_id"], trees).to_pylist()
    for t, row in zip(trees, rows):
        names = {"size": t.size, "parent": t.parent, "depth": t.depth, "n_children": t.children, "prev_tag": t.prev_tag, "tag": t.tag,
                 "t0": t.t0, "t1": t.t1, "pre": list(range(len(t.tag)))}
        assert {k: [n[k] for n in row["nodes"]] for k in names} == names
        assert [dict(n["attrs"]) for n in row["nodes"]] == t.attrs and row["page_text"] == t.text


def test_no_search_for_cycles_while_pages_are_read():
    import gc

    import pyarrow as pa

    from excursio.sources.pages import _trees

    runs = []
    gc.callbacks.append(lambda phase, info: runs.append(phase))
    try:
        _trees(pa.array(["<p a=1 b=2 c=3>x</p>" * 3000]), 0)
    finally:
        gc.callbacks.pop()
    assert not runs and gc.isenabled()


@pytest.mark.parametrize("html", ["<svg><title/><style/><p>a</svg><title>b<i></title><p>c", "<svg><title>x<b>y</b></title></svg>z", "<textarea/>a</textarea>b",
                                  "a < b </ c> d </\n e <p>f", "a</\n>b<p x='>", "<template><svg></template><title>t</title>", "<script>a</SCRIPT x>b</script >c"])
def test_raw_text_ends_where_it_should(html):
    t = PageTree(html)
    said = {"<svg><title/>": "ab<i>c", "<svg><title>x": "xyz", "<textarea/>a": "ab", "a < b": "a < b  d f", "a</": "ab", "<template>": "t", "<script>": "abc"}
    assert t.text.decode() == next(v for k, v in said.items() if html.startswith(k))


def test_raw_elements_in_any_case_hold_no_elements():
    from excursio.sources.markup import RAW

    for name in RAW:
        for tag in (name, name.upper(), name.title(), name[0].upper() + name[1:]):
            t = PageTree(f"<body><{tag} a=1 A=2><b>x</b></{name}><i b='&amp;' b=2 c='&'>y</i><{tag}s>")
            assert t.tag[3:] == [name, "i", f"{name}s"] and t.text == b"<b>x</b>y" and t.size[3] == 0
            assert t.attrs[3:5] == [{"a": "1"}, {"b": "&", "c": "&"}]
