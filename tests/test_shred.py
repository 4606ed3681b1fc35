"""The parsing stage: the quick path for bare tags changes nothing, batches are exact."""

import re

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from pagetables.operators import shred as stage


class Plain(stage._Events):
    """The same events by the standard parser's own reading of the whole document."""

    def read(self, markup):
        self.feed(markup)
        self.close()
        self._end_text()
        while self.path:
            self._pop()


def nodes(events_class, markup):
    events = events_class()
    events.read(markup)
    whole = b"".join(events.texts)
    return [
        (last, tag, cls, whole[start:end].decode(), head, start, end)
        for last, (head, tag, cls), start, end in zip(events.last, events.nodes, events.start, events.end)
    ]


PIECES = st.sampled_from(
    ["<table>", "</table>", "<tr>", "</tr>", "<td>", "</td>", "<TH>", "</Th>", "<td class='x'>", "<br>", "<br/>",
     "<div class=\"row Cell\">", "</div>", "<td/>", "<p>", "</p>", "<h1>", "</h1>", "<!-- c -->", "<script>",
     "</script>", "<style>", "</style>", "<textarea>", "</textarea>", "a", " b ", "&amp;", "&#65;", "&copy", "&copy;", "&#x;", "& ", "<",
     ">", "</", "<x", "<!DOCTYPE html>", "<?pi?>", "</td x>", "< td>", "<td\n>", "<div title='>' class=a>", "<!-->", "<!--", "-->", "</script >", "<SCRIPT>", "&", "'", '"', "<title>", "</title>"]
)


@settings(max_examples=3000, deadline=None)
@given(st.lists(PIECES, max_size=40))
def test_documents_are_read_as_the_parser_reads_them(pieces):
    markup = "".join(pieces)
    assert nodes(stage._Events, markup) == nodes(Plain, markup)


@settings(max_examples=200, deadline=None)
@given(st.lists(PIECES, max_size=40))
def test_spans_are_nested(pieces):
    found = nodes(stage._Events, "".join(pieces))
    for i, (last, *_, start, end) in enumerate(found):
        assert i <= last < len(found) and start <= end
        for j in range(i + 1, last + 1):
            assert found[j][0] <= last and start <= found[j][-2] <= found[j][-1] <= end


GRID = st.integers(1, 4).flatmap(
    lambda width: st.lists(
        st.lists(st.text(st.characters(codec="utf-8", exclude_categories=["Cs"]), max_size=8), min_size=width, max_size=width),
        min_size=1, max_size=5,
    )
)


def escaped(text):
    return text.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")


@settings(max_examples=200, deadline=None)
@given(GRID)
def test_rendered_grids_come_back(grid):
    html = "<table>" + "".join(
        "<tr>" + "".join(f"<td>{escaped(c)}</td>" for c in row) + "</tr>" for row in grid
    ) + "</table>"
    found = nodes(stage._Events, html)
    texts = [text for _, tag, _, text, *_ in found if tag == "td"]
    assert texts == [c.strip() for row in grid for c in row]


def test_batch_keeps_documents_apart():
    lists, texts, errors = stage.shred_batch(pa.array(["<td>a", None, "<h1>b</h1>", "x"]))
    assert [len(v) for v in lists.to_pylist()] == [1, 0, 1, 0]
    assert texts.to_pylist() == [b"a", None, b"b", b""]
    assert lists.to_pylist()[2][0]["id"] == 0 and errors.null_count == 4


def test_decoding():
    xml = '<?xml version="1.0" encoding="iso-8859-1"?><h1>é</h1>'.encode("latin-1")
    assert "é" in stage.decode_markup(xml)
    latin = '<meta charset="iso-8859-1"><h1>é</h1>'.encode("latin-1")
    for content in (latin, "\ufeff<h1>é</h1>".encode(), "<h1>é</h1>".encode(),
                    "\ufeff<h1>é</h1>".encode("utf-16-le"), "<h1>é</h1>".encode("cp1252")):
        assert "é" in re.sub("^\ufeff", "", stage.decode_markup(content))


def test_bare_tags_are_read_without_a_call_each(monkeypatch):
    calls = []
    for name in ("handle_starttag", "handle_endtag"):
        monkeypatch.setattr(stage._Events, name, lambda self, *args: calls.append(args))
    events = stage._Events()
    events.read("<h1>Title</h1><table>" + "<tr><th>a</th><td> b </td><td><b>c</b>d</td></tr>" * 9 + "</table>")
    assert not calls
    assert [tag for _, tag, _ in events.nodes] == ["h1", "table"] + ["tr", "th", "td", "td"] * 9
    assert b"".join(events.texts) == b"Title" + b"abcd" * 9
    assert events.last[:2] == [0, 37] and events.end[1] == len(b"Title") + 36


LEAVES = st.sampled_from(
    ["<td>w</td>", "<TD>é</td>", "<td>w</TD>", "<td></td>", "<td> w", "<b>w</b>", "<br>x</br>", "<rt>x</rt>", "<script>a</script>",
     "<template>", "</template>", "<h1>T</h1>", "<h2>U</h2>", "<caption> c </caption>", "<tr>", "</tr>", "<table>", "</table>", "&amp;", "&", " ", "w",
     "<div class=cell>", "</div>", "<p>", "</p>", "<!-- c -->", "<td>a&lt;b</td>", "<td><td>x</td></td>", "<title>t</title>"]
)


@settings(max_examples=1000, deadline=None)
@given(st.lists(LEAVES, max_size=30))
def test_elements_of_text_alone_are_read_as_the_parser_reads_them(pieces):
    markup = "".join(pieces)
    assert nodes(stage._Events, markup) == nodes(Plain, markup)


def test_cells_next_to_each_other_are_read_as_one():
    rows = "<tr><th>a</th><th> é </th></tr>" + "<tr><td>1</td><td></td></tr>" * 3
    tokens = [m.lastindex for m in stage._BARE.finditer(f'<table>{rows}<td>x</td><td>y</td><div class="Row"><b>z</b></div>')]
    assert tokens == [6, *[stage._ROW] * 4, stage._RUN, stage._CLASS, stage._LEAF, stage._CLOSING]


RUNS = st.sampled_from(
    ["<tr><td>a</td><td> é </td></tr>", "<tr><th>x</th></tr>", "<tr><td>a</td><th>b</th></tr>", "<td>p</td><td></td>", "<th>\xa0q</th>", "<tr>", "</tr>",
     "<td>", "</td>", "<TD>u</TD>", '<div class="Row  odd">', '<div class="my-cell">v</div>', '<div class="">', "</div>", '<td class="cell">', '<td class="a">w</td>',
     '<p class="cell">', "</p>", '<br class="x">', '<br class="x">t</br>', '<script class="x">', "</script>", '<title class="x">t</title>', '<h1 class="x">h</h1>', "<h2>i</h2>",
     "<template>", '<template class="x">', "</template>", "<table>", "</table>", "&amp;", "s", " ", '<div class="a&amp;b">', '<div class="c"/>', "<caption>c</caption>"]
)


@settings(max_examples=2000, deadline=None)
@given(st.lists(RUNS, max_size=30))
def test_runs_of_cells_and_classes_are_read_as_the_parser_reads_them(pieces):
    markup = "".join(pieces)
    assert nodes(stage._Events, markup) == nodes(Plain, markup)


WRAPS = st.sampled_from(
    ["<table>%s</table>", "<tr>%s</tr>", "<td>%s</td>", "<TH>%s</th>", "<b>%s</b>", "<h1>%s</h1>", "<h2> %s</h2>", "<h3>%s</h3>",
     "<caption>%s</caption>", "<thead>%s</thead>", "<div>%s</div>", "<td> é%s\xa0</td>", "<br>%s</br>", "%s<hr>", "<title>t</title>%s",
     "<!DOCTYPE html>%s", "x %s\n", "%s", "<td>%s", "%s&amp;", "<td class='a'>%s</td>", "<b>%s</i>", "%s>", "<title>%s", "</!doctype>%s"]
)
TREES = st.recursive(
    st.sampled_from(["", " ", "w", "é", "  y z "]),
    lambda inner: st.builds(lambda wrap, parts: wrap.replace("%s", "".join(parts)), WRAPS, st.lists(inner, max_size=4)),
    max_leaves=20,
)


@settings(max_examples=1000, deadline=None)
@given(st.lists(st.one_of(st.none(), TREES, st.lists(PIECES, max_size=8).map("".join)), min_size=1, max_size=12))
def test_pages_read_at_once_are_read_as_one_by_one(pages):
    markup = pa.array(pages, pa.string())
    assert [c.to_pylist() for c in stage.shred_batch(markup)] == [c.to_pylist() for c in stage.parsed(markup)]


def test_plain_pages_are_read_without_a_parser_each(monkeypatch):
    plain = "<!DOCTYPE html><title>t</title><h1>T</h1><table><tr><th>a</th><th> é </th></tr><tr><td>1<br>2</td><td></td></tr></table>"
    want = [c.to_pylist() for c in stage.parsed(pa.array([plain] * 3))]
    monkeypatch.setattr(stage, "parsed", None)
    assert [c.to_pylist() for c in stage.shred_batch(pa.array([plain] * 3))] == want
    monkeypatch.undo()
    assert stage.plain_pages(pa.array([plain, None, plain + "&", "<td>"]), 99).plain.tolist() == [True, False, False, False]


def test_cells_that_repeat_too_much_are_not_plain(monkeypatch):
    markup = pa.array(["<td>" * 9 + "x" * 50 + "</td>" * 9, "<td>y</td>"])
    monkeypatch.setattr(stage, "MOST_CELL_BYTES", 400)
    _, texts, errors = stage.shred_batch(markup)
    assert texts.to_pylist() == [None, b"y"]
    assert errors.to_pylist() == ["Error: Cells left open repeat 450 bytes of text", None]


def test_places_are_ids_by_tag():
    pages = ["<table><tr><td>a</td><td><table><tr><th>b</th></tr></table></td></tr></table>", None, "<td>c</td><tr></tr>"]
    nodes, places = stage.placed(stage.shred_batch(pa.array(["<tr>", *pages]))[0].slice(1))
    assert [p["tr"] for p in places.to_pylist()] == [[1, 5], [], [1]]
    assert [p["th"] for p in places.to_pylist()] == [[6], [], []]
    assert [[n["cells"] for n in page] for page in nodes.to_pylist()] == [[3, 3, 0, 1, 1, 1, 0], [], [0, 0]]
