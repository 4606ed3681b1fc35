"""Extraction on small markup with results worked out by hand."""

import time


def table(*rows):
    return "<table>" + "".join(f"<tr>{r}</tr>" for r in rows) + "</table>"


def cells(*texts, tag="td"):
    return "".join(f"<{tag}>{t}</{tag}>" for t in texts)


PEOPLE = [cells("Name", "Age", "City", tag="th"), cells("John", "30", "New York"), cells("Jane", "25", "Chicago")]


def test_statuses(extract):
    big = "<table>" + "x" * 400
    found = extract(
        "<h1>People</h1>" + table(*PEOPLE), "<h1>a</h1><p>b</p>", None, big, max_mb=0.0003
    )
    assert [f["status"] for f in found[:3]] == ["Success", "No tables found", "No tables found"]
    assert found[3]["status"] == "Error: File size (0.00 MB) exceeds maximum (0.0003 MB)"
    assert [f["tables_count"] for f in found] == [1, 0, 0, 0]
    first = found[0]["tables"][0]
    assert first["headers"] == ["Name", "Age", "City"]
    assert first["rows"] == [["John", "30", "New York"], ["Jane", "25", "Chicago"]]
    assert (first["caption"], first["column_count"], first["row_count"]) == ("People", 3, 2)


def one(extract, html, **options):
    return extract(html, **options)[0]["tables"][0]


def test_headers(extract):
    cases = {
        table(cells("a", "a", "a_1", "a", tag="th")): ["a", "a_1", "a_1", "a_2"],
        "<table><thead><tr><td>p</td><td>q</td><td>r</td></tr></thead><tr><td>1</td></tr></table>": ["p", "q", "r"],
        "<table><thead></thead><tr><td>x</td><td>y</td><td>z</td></tr></table>": ["x", "y", "z"],
        table(cells("", "", "", tag="th"), cells("1", "2", "3")): ["", "_1", "_2"],
        table("", cells("1", "2", "3")): [],
    }
    found = extract(*cases)
    assert [f["tables"][0]["headers"] for f in found] == list(cases.values())


def test_rows(extract):
    only_header = one(extract, table(cells("Name", "Age", "City", tag="th")))
    assert only_header["headers"] == only_header["rows"][0] == ["Name", "Age", "City"]
    blank = one(
        extract,
        table(PEOPLE[0], PEOPLE[1], cells("", " ", "&nbsp;"), "", *[cells(str(i), "x", "y") for i in range(5)]),
    )
    assert [r[0] for r in blank["rows"]] == ["John", "0", "1"]
    headless = one(extract, table(cells("x", "y", "z"), cells("1", "2", "3")))
    assert headless["headers"] == ["x", "y", "z"] and headless["rows"] == [["1", "2", "3"]]
    two = one(extract, table(*PEOPLE, cells("Bob", "40", "Boston")), sample=2)
    assert len(two["rows"]) == 2


def test_texts(extract):
    text = {
        "New <b>York</b>": "NewYork",
        "x<!-- c --> y": "xy",
        "&copy;&#150;&#x41;&foo; &amp;lt;": "©–A&foo; &lt;",
        "a<script>b</script><style>c</style><template><i>d</i></template>e": "ae",
        "a<br>b<br/>c</br>d": "abcd",
        "a</p>b": "ab",
        "<![CDATA[raw]]>": "raw",
        "a < b": "a < b",
        "\xa0\u2003x\u3000": "x",
    }
    found = one(extract, table(*[cells("r", t, "z") for t in ("head", *text)]), sample=50)
    # A section that is not closed as the parser expects may differ by its version.
    got = [r[1] for r in found["rows"]]
    want = list(text.values())
    assert [g for g, t in zip(got, text) if "CDATA" not in t and "&foo" not in t] == [
        w for w, t in zip(want, text) if "CDATA" not in t and "&foo" not in t
    ]
    assert got[2].startswith("©–A&foo")


def test_tree_without_repair(extract):
    unclosed = one(extract, "<table><tr><td>a<td>b</tr><tr><td>1<td>2<td>3</tr></table>")
    assert unclosed["headers"] == ["ab", "b"] and unclosed["rows"] == [["123", "23", "3"]]
    stray = one(extract, "<table></div><tr><td>a</td><td>b</td><td>c</td></tr></table>")
    assert stray["headers"] == ["a", "b", "c"]
    open_page = one(extract, "<table><tr><th>a<th>b")
    assert open_page["headers"] == ["ab", "b"]
    closed_early = one(extract, "<table><tr><td><b>x</td><td>y</td></tr></b></table>")
    assert closed_early["headers"] == ["x", "y"]
    self_closed = one(extract, "<table><tr><td/><td>y</td><td>z</td></tr></table>")
    assert self_closed["headers"] == ["", "y", "z"]


def test_unclosed_cells_take_linear_time(extract):
    """Pages next to each other: one with a megabyte of open cells in closed rows, one whose
    cells would repeat gigabytes, and a good one."""
    closed = "<table>" + "".join(f"<tr><td>a{i}<td>b<td>c</tr>" for i in range(45_000)) + "</table>"
    endless = "<table><tr>" + "<td>x" * 200_000
    small = "<table><tr>" + "<td>xy" * 8_000
    assert len(closed) > 1_000_000 and len(endless) == 1_000_011
    begin = time.perf_counter()
    found = extract(closed, endless, small, "<h1>People</h1>" + table(*PEOPLE))
    assert time.perf_counter() - begin < 60
    assert found[0]["tables"][0]["headers"] == ["a0bc", "bc", "c"]
    assert [r[0] for r in found[0]["tables"][0]["rows"]] == [f"a{i}bc" for i in range(1, 6)]
    assert found[1]["status"].startswith("Error: Cells left open repeat") and found[1]["tables"] == []
    headers = found[2]["tables"][0]["headers"]
    assert len(headers) == 8_000 and headers[0] == "xy" * 8_000 and headers[-1] == "xy"
    assert found[3]["tables"][0]["rows"] == [["John", "30", "New York"], ["Jane", "25", "Chicago"]]


def test_all_rows_without_a_limit(extract):
    found = one(extract, table(*[cells("r", str(i), "x") for i in range(300)]), sample=None)
    assert [r[1] for r in found["rows"]] == [str(i) for i in range(1, 300)]
    assert len(one(extract, DIVS.replace("</div></div></div>", "</div></div>" + '<div class="row"><div class="cell">z</div></div>' * 20 + "</div>"), sample=None)["rows"]) == 21


def test_large_pages_are_read(extract):
    html = "<table>" + "".join(f"<tr><td>{i}</td><td>{'x' * 100_000}</td><td>y</td></tr>" for i in range(110)) + "</table>"
    assert len(html) > 10 * 1024 * 1024 and extract(html)[0]["status"] == "Success"


def test_nested_tables(extract):
    inner = table(cells("i1"), cells("i2"))
    found = extract("<h2>far</h2><h3>near</h3>" + table(cells("o", inner)))[0]["tables"]
    assert [t["table_id"] for t in found] == [0, 1]
    assert found[0]["headers"] == ["o", "i1i2", "i1", "i2"]
    assert found[0]["rows"] == [["i1"], ["i2"]] and found[1]["rows"] == [["i2"]]
    assert {t["caption"] for t in found} == {"far"}


def test_captions(extract):
    body = table(*PEOPLE)
    with_caption = body.replace("<table>", "<table><caption> own <i>text</i></caption>")
    cases = {
        "<h1>one</h1><h2>two</h2>" + body: "one",
        "<h2>two</h2><h3>three</h3>" + body: "two",
        "<h3>three</h3>" + with_caption: "three",
        with_caption + "<h1>after</h1>": "owntext",
        "<h1></h1><h2>two</h2>" + body: "",
        "<h1>a</h1><h1>b</h1>" + body: "b",
        body: "",
    }
    assert [f["tables"][0]["caption"] for f in extract(*cases)] == list(cases.values())


DIVS = (
    '<div class="Data-Table x"><div class="header">H1</div><div class="header">H2</div>'
    '<div class="row"><div class="cell">1</div><div class="col-x">2</div></div>'
    '<div class="ROW"><div class="cell"> </div></div></div>'
)


def test_div_tables(extract):
    found = extract(
        DIVS, DIVS + table(*PEOPLE), DIVS.replace("Data-Table", "&#100;ata-t&#97;ble"),
        '<div class="gr">x</div>',
    )
    assert [f["tables_count"] for f in found] == [1, 1, 1, 0]
    assert found[0]["tables"][0]["kind"] == "div" and found[1]["tables"][0]["kind"] == "table"
    assert found[0]["tables"][0]["headers"] == ["H1", "H2"]
    assert found[0]["tables"][0]["rows"] == found[2]["tables"][0]["rows"] == [["1", "2"]]
    for off in ({"implicit": False}, {"div_classes": False}):
        assert extract(DIVS, **off)[0]["status"] == "No tables found"
    nested = "<table>" + DIVS + "</table>"
    assert one(extract, nested)["rows"] == [["1", "2"]]
    assert one(extract, nested, div_classes=False)["rows"] == []


def test_vertical(extract):
    pairs = [cells("Name:", "X"), cells("Type :", "Y"), cells("Rows", "5")]
    found = one(extract, table(*pairs))
    assert found["is_vertical"] and found["headers"] == ["Name", "Type", "Rows"]
    assert found["rows"] == [["X", "Y", "5"]] and found["row_count"] == 1
    head = cells("Name", "Age", tag="th")
    people = [cells(n, "1") for n in ("a", "b", "c", "d")]
    assert one(extract, table(head, *people[:2]))["is_vertical"]
    assert not one(extract, table(head, *people))["is_vertical"]
    assert not one(extract, table(*pairs), vertical=False)["is_vertical"]
    long_name = cells("n" * 29 + ":", "1")
    assert not one(extract, table(long_name, long_name))["is_vertical"]
    seven = one(extract, table(*[cells(f"k{i}:", str(i)) for i in range(7)]))
    assert seven["rows"] == [[str(i) for i in range(7)]]


def test_a_cell_does_not_copy_the_page(spark):
    """A binary column named inside a ``transform`` is copied whole for every element."""
    from pagetables.operators.extract import extract_tables, find_captions, texts_of
    from pagetables.operators.shred import shred

    dom = shred(spark.createDataFrame([(1, "<h1>a</h1><table><tr><td>b</td></tr></table>")], "doc_id int, html string"))
    for frame in (extract_tables(dom), find_captions(dom), texts_of(dom, "td")):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert "page_text" in plan and "substring(page_text" not in plan
    assert [r.text for r in texts_of(dom, "h1", "td").collect()] == ["a", "b"]


def test_bound_values_are_not_copied(spark):
    """``transform`` copies what its body returns, a table with its cells at every level."""
    from pyspark.sql import functions as F

    from pagetables.functions.text import bind

    frame = spark.createDataFrame([(1, ["a"]), (None, None)], "n int, names array<string>")
    nested = bind(F.col("n") + 1, lambda n: F.transform("names", lambda w: bind(w, lambda v: F.concat(v, n.cast("string")))))
    found = frame.select(nested.alias("x"), bind(F.col("n"), lambda n: F.coalesce(n, F.lit(-1))).alias("y"))
    assert "transform(array(" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r.y, r.x) for r in found.collect()) == [(-1, None), (1, ["a2"])]
