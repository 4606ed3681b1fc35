"""Operators on pages, calls and vectors, components, and the pipeline."""

import json
import random
import time
import tracemalloc
from collections import Counter, defaultdict
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pagetables.llm import extraction, queries, toolcalls, topk, urlfilter
from pagetables.llm.blocks import BLOCK, HIDDEN, VOID, leaf_blocks
from pagetables.llm.components import components


# Components


@pytest.mark.parametrize("seed", range(3))
def test_components_against_union_find(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    edges += [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2001 + i) for i in range(80)] + [(5, 5), (None, 3), (7, None)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    found = components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {r["node"]: r["component"] for r in found} == {x: find(x) for x in parent}
    assert len(found) == len(parent)
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# URL filters


def brute_rule(url, rules):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min((path.find(c) for c in "?#" if c in path), default=len(path))]
    fits = [(len(h + p), v == "allow", h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, None, None))
    return host, path, best[2], best[3]


URLS = [
    "http://www.example.com/en/1", "https://a.Example.COM/en/x?q#f", "https://example.com/en", "http://com", "http://com/",
    "http://xcom/", "https://m.net/es/1", "https://m.net/es", "net/es/", None, "", "://", "://net/fr/", "HTTP://EXAMPLE.com?x/en/",
    "http://example.org/\nen/#://com/", "a://b://c/d", "http://www.example.com/en/1",
]


def test_rules_against_brute_force(spark):
    pages = spark.createDataFrame([(i, u, None, "own") for i, u in enumerate(URLS)], "page_id bigint, url string, html string, rule string")
    pages = pages.withColumn("node", F.lit("own")).withColumn("a", F.lit("own"))
    rules = urlfilter.rule_table(spark)
    rows = urlfilter.judge(pages, rules).collect()
    assert len(rows) == len(URLS)
    for r in rows:
        host, path, rule, verdict = brute_rule(r["url"], urlfilter.RULES)
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, rule, verdict or "allow"), r["url"]
        assert r["node"] == r["a"] == "own"
    assert urlfilter.judge(pages.limit(0), rules).count() == 0


def test_block_decisions_reach_aliases(spark):
    canonical = '<head><LINK href="{}" rel="canonical"></head>'
    pages = spark.createDataFrame(
        [
            (1, "http://spam.net/fr/1", None),  # blocked by a rule
            (2, "http://alias.org/1", canonical.format("http://spam.net/fr/1")),
            (3, "http://far.org/1#part", "<meta http-equiv=refresh content='0; url=http://alias.org/1'>"),
            (4, "http://far.org/1", ""),  # the same without its fragment
            (5, "http://good.com/", canonical.format("http://spam.net/fr/1").replace("spam", "spam2")),
            (6, "http://both.org/", "<link rel='canonical' href='http://good.com/'>"),
            (7, "http://both.org/2", "<link rel='canonical' href='http://spam2.net/fr/1'>"),
            (8, "http://spam2.net/fr/1", None),  # ruled itself, whatever its aliases
            (9, "http://local.org/a?x", canonical.format("/b")),
            (10, "http://local.org/b", canonical.format("")),
            (11, "http://hop.org/", None),
        ],
        "page_id bigint, url string, html string",
    )
    redirects = spark.createDataFrame([("http://hop.org/", "http://hop2.org/"), ("http://hop2.org/", "http://local.org/b"), ("http://local.org/a?x", "http://x.net/es/")], "a string, b string")
    got = {r["page_id"]: r["verdict"] for r in urlfilter.judge(pages, urlfilter.rule_table(spark), redirects).collect()}
    assert got == {1: "block", 2: "block", 3: "block", 4: "block", 5: "allow", 6: "allow", 7: "allow", 8: "block", 9: "block", 10: "block", 11: "block"}


def test_links_resolve_as_urllib_does(spark):
    from urllib.parse import urljoin

    links = ["next.html", "../x", "./x", "..", ".", "a/./b/../c/", "../../../up", "?page=2", "/b/../c?u=http://spam.net/../x", "x?u=a://b#f",
             "/login?next=http://spam.net/fr/", "//other.org/x", "HTTP://Abs.org/y", "https://abs.org", "/", "#part"]
    bases = ["http://a.org/d/e/f.html?q=1#z", "https://a.org/d/", "http://a.org/d"]
    rows = spark.createDataFrame([(b, l) for b in bases for l in links], "base string, link string")
    got = rows.select("base", "link", urlfilter.node_of(urlfilter.resolved(F.col("base"), F.col("link"))).alias("node")).collect()
    want = rows.sparkSession.createDataFrame([(b, l, urljoin(b, l)) for b in bases for l in links], "base string, link string, url string")
    nodes = {(r["base"], r["link"]): r["node"] for r in want.select("base", "link", urlfilter.node_of(F.col("url")).alias("node")).collect()}
    assert {(r["base"], r["link"]): r["node"] for r in got} == nodes
    rows = spark.createDataFrame([("http://a.org", "?p=2"), ("http://a.org", "x"), ("http://a.org/", "mailto:x@y"), ("http://a.org/", "data:a://b"), ("a.org", "/x?u=a://b"), ("http://a.org/d", "a//b")], "base string, link string")
    assert [r[0] for r in rows.select(urlfilter.node_of(urlfilter.resolved(F.col("base"), F.col("link")))).collect()] == ["http://a.org/?p=2", "http://a.org/x", None, None, None, "http://a.org/a//b"]


def test_relative_and_repeated_links_reach_aliases(spark):
    canonical, refresh = "<link rel=canonical href='{}'>", "<meta http-equiv='refresh' content='0;url={}'>"
    pages = spark.createDataFrame(
        [
            (1, "http://l.org/d/a.html", refresh.format("next.html")),
            (2, "http://l.org/d/next.html", canonical.format("../x")),
            (3, "http://l.org/x", canonical.format("?page=2")),
            (4, "http://l.org/x?page=2", canonical.format("http://spam.net/fr/")),
            (5, "http://m.org/", refresh.format("/login?next=http://spam.net/fr/")),  # stays on its own host
            (6, "http://n.org/1", canonical.format("http://n.org/0") + canonical.format("http://spam.net/fr/")),
            (7, "http://n.org/2", refresh.format("/0") + refresh.format("http://spam.net/es/")),
            (8, "http://o.org/", "<base href='http://spam.net/fr/'>" + canonical.format("1")),
            (9, "http://p.org/", None),
        ],
        "page_id bigint, url string, html string",
    )
    redirects = spark.createDataFrame([("http://p.org/", "../q?u=http://good.com/"), ("http://p.org/q?u=http://good.com/", "http://spam.net/fr/")], "a string, b string")
    got = {r["page_id"]: r["verdict"] for r in urlfilter.judge(pages, urlfilter.rule_table(spark), redirects).collect()}
    assert got == {i: "allow" if i == 5 else "block" for i in range(1, 10)}


# Tool calls


TOOLS = {"add": [
    {"name": "x", "type": "number", "required": True, "least": 0.0, "most": 10.0},
    {"name": "how", "type": "string", "required": False, "most_length": 5, "choices": ["plain", "fast", "too long"]},
    {"name": "deep", "type": "object", "required": False},
]}
CALLS = "conv_id bigint, call_id string, parent_id string, turn bigint, name string, arguments string"
RESULTS = "conv_id bigint, call_id string, turn bigint, content string"


def linked(spark, calls, results):
    rows = toolcalls.link(
        spark.createDataFrame(calls, CALLS).withColumn("depth", F.lit("own")), spark.createDataFrame(results, RESULTS),
        toolcalls.schema_table(spark, TOOLS),
    ).collect()
    return {(r["conv_id"], r["call_id"]): r.asDict() for r in rows}


def test_links_orders_and_validates(spark):
    calls = [
        (1, "c", "b", 9, "add", '{"x": 3}'), (1, "b", "a", 5, "add", '{"how":"fast", "x":1.50, "deep":{"z":1,"a":[1, 2]}}'),
        (1, "a", "nowhere", 7, "add", '{"x": 11, "how": "slowly", "more": null}'), (1, "d", None, 1, "add", '{"x": "3"}'),
        (2, "a", "b", 1, "add", '{"x":1}'), (2, "b", "a", 2, "add", '{"x":1}'), (2, "e", "a", 3, "add", '{"x":1}'),
        (3, "a", None, 4, "none", "{}"), (3, "b", None, 5, "add", "not json"), (3, "n", None, 5, "add", None), (3, "l", None, 5, "add", "[1]"),
        (3, "m", None, 6, "add", "{}"), (3, "late", None, 6, "add", '{"x":1}'),
        (4, "a", None, 8, "add", '{"x":2}'), (4, "a", None, 2, "add", '{"x":1}'), (4, "a", None, 2, "add", '{"x":1}'),
        (None, "a", None, 1, "add", '{"x":1}'), (5, None, None, 1, "add", '{"x":1}'), (5, None, None, 1, "add", '{"x":1}'),
    ]
    results = [(c, i, t + 100, f"r{i}") for c, i, _, t, _, _ in calls if i != "late"] + [(6, "x", 1, "lost"), (6, "x", 2, "again")]
    calls_frame_rows = linked(spark, calls, results)
    status = {k: v["status"] for k, v in calls_frame_rows.items()}
    assert status == {
        (1, "a"): "invalid", (1, "b"): "ok", (1, "c"): "ok", (1, "d"): "invalid", (2, "a"): "cycle", (2, "b"): "cycle", (2, "e"): "cycle",
        (3, "a"): "unknown_tool", (3, "b"): "bad_json", (3, "n"): "bad_json", (3, "l"): "bad_json", (3, "m"): "invalid", (3, "late"): "no_result",
        (4, "a"): "ok", (None, "a"): "no_result", (5, None): "no_result", (6, "x"): "no_call",
    }
    assert [calls_frame_rows[1, i]["depth"] for i in "abcd"] == [0, 1, 2, 0]
    assert calls_frame_rows[1, "a"]["errors"] == "how: too long; more: not a field; x: too large"
    assert calls_frame_rows[1, "d"]["errors"] == "x: string instead of number"
    assert calls_frame_rows[3, "m"]["errors"] == "x: missing"
    assert calls_frame_rows[1, "b"]["arguments"].startswith('{"deep":{"a":[1,2],"z":1},"how":"fast","x":1.5')
    assert json.loads(calls_frame_rows[1, "b"]["call_json"]) == {"arguments": {"deep": {"a": [1, 2], "z": 1}, "how": "fast", "x": 1.5}, "id": "b", "name": "add", "result": "rb"}
    first = calls_frame_rows[4, "a"]
    assert (first["turn"], first["copies"], first["result_copies"], first["arguments"]) == (2, 3, 3, '{"x":1}')
    assert calls_frame_rows[6, "x"]["content"] == "lost" and calls_frame_rows[6, "x"]["result_copies"] == 2


def test_results_without_an_identifier_keep_their_rows(spark):
    calls = spark.createDataFrame([(1, "a", None, 1, "add", '{"x":1}'), (5, None, None, 1, "add", '{"x":1}'), (None, "a", None, 1, "add", '{"x":1}')], CALLS)
    results = [(1, "a", 2, "ra"), (5, None, 2, "one"), (5, None, 2, "one"), (None, "a", 3, "two"), (None, None, None, None)]
    rows = toolcalls.link(calls, spark.createDataFrame(results, RESULTS), toolcalls.schema_table(spark, TOOLS)).collect()
    names = ("conv_id", "call_id", "turn", "result_turn", "result_copies", "status", "content")
    assert Counter(tuple(r[n] for n in names) for r in rows) == Counter([
        (1, "a", 1, 2, 1, "ok", "ra"), (5, None, 1, None, None, "no_result", None), (None, "a", 1, None, None, "no_result", None),
        (5, None, None, 2, 1, "no_call", "one"), (5, None, None, 2, 1, "no_call", "one"), (None, "a", None, 3, 1, "no_call", "two"),
        (None, None, None, None, 1, "no_call", None),
    ])


def test_every_turn_has_its_row(spark, tmp_path):
    said = [(1, 0, None, "a b c d e"), (1, 1, "assistant", "yes"), (1, 2, "user", "a b c d e"), (None, 1, "assistant", "lost"), (2, None, "assistant", "too"), (3, None, None, "x")]
    spark.createDataFrame(said, "conv_id bigint, turn int, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    rows = queries.op3_tool_calls(spark, str(tmp_path)).collect()
    assert Counter((r["conv_id"], r["call_id"], r["name"], r["status"], r["content"]) for r in rows) == Counter([
        (1, "t0", "instruct", "invalid", "yes"), (1, "t2", "ask", "no_result", None), (None, "t0", None, "no_call", "lost"),
        (2, None, None, "no_call", "too"), (3, None, "instruct", "no_result", None),
    ])


def test_long_chains_and_empty_tables(spark):
    n = 300
    calls = [(1, f"c{i}", f"c{i - 1}", n - i, "add", '{"x":1}') for i in range(n)]
    rows = linked(spark, calls, [])
    assert all(rows[1, f"c{i}"]["depth"] == i for i in range(n))
    assert linked(spark, [], []) == {}


def test_no_python_in_the_plan(spark):
    frame = toolcalls.link(spark.createDataFrame([], CALLS), spark.createDataFrame([], RESULTS), toolcalls.schema_table(spark, TOOLS))
    plan = frame._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


# Top-k


def brute_nearest(rows, k):
    out = []
    for i, (q, a) in enumerate(rows):
        if q % 50 == 0:
            scored = sorted((-int(np.dot(a, b)), v) for j, (v, b) in enumerate(rows) if j != i and len(a) == len(b))
            out += [(q, r, v, -s) for r, (s, v) in enumerate(scored[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("seed", range(2))
def test_nearest_against_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    vectors = [(i, rng.integers(-200, 200, 8).tolist()) for i in range(700)]
    vectors += [(700 + i, vectors[i % 3][1]) for i in range(200)]  # many copies, many ties
    vectors += [(1000 + i, [0] * 8) for i in range(60)] + [(2000 + 25 * i, [int(x) for x in rng.integers(-9, 9, 3)]) for i in range(9)]
    vectors += [(3000, []), (3001, []), (3050, [5])]
    frame = spark.createDataFrame(vectors, "vec_id bigint, v array<bigint>").withColumn("row", F.lit("own"))
    found = topk.nearest(frame, F.col("vec_id") % 50 == 0, 5, block_rows=100, query_rows=7)
    assert sorted(tuple(r) for r in found.collect()) == brute_nearest(vectors, 5)


def test_nearest_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, -0.001]), (1, [1.0, 1.0]), (1, [1.0, 1.0]), (2, None), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (None, [1.0, 1.0]), (50, [1.0]), (100, [0.25, 0.0]), (100, [0.25, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").filter(topk.usable(F.col("embedding")))
    vectors = frame.select("vec_id", topk.integers(F.col("embedding")).alias("v"))
    got = sorted(tuple(r) for r in topk.nearest(vectors, F.col("vec_id") % 50 == 0, 5).collect())
    assert got == sorted(
        [(0, 1, 1, 128 * 256 - 256), (0, 2, 1, 128 * 256 - 256), (0, 3, 100, 128 * 64), (0, 4, 100, 128 * 64)]
        + 2 * [(100, 1, 1, 64 * 256), (100, 2, 1, 64 * 256), (100, 3, 0, 64 * 128), (100, 4, 100, 64 * 64)]
    )
    assert topk.nearest(vectors.limit(0), F.col("vec_id") % 50 == 0, 5).count() == 0


def test_flat_queries_keep_k_rows_of_a_block():
    rng, n, k = np.random.default_rng(3), 5000, 5
    vectors = rng.integers(-4096, 4096, (n, 8)).astype(float)
    grid = {8: (vectors.min(axis=0), np.full(8, 128.0))}
    cells = ((vectors - grid[8][0]) // grid[8][1]).astype(np.uint8)
    ids = rng.permutation(n)
    block = pa.table({"row": np.arange(n), "id": ids, "cells": [c.tobytes() for c in cells]})
    queries_ = pa.table({"q_row": [n, 7], "n": [8, 8], "v": [[0] * 8, [0] * 8]})
    found = topk._scan(grid, k)((0,), queries_, block).to_pydict()
    for q, left in ((n, range(n)), (7, [i for i in range(n) if i != 7])):
        rows = [r for a, r in zip(found["q_row"], found["row"]) if a == q]
        assert sorted(ids[rows]) == sorted(ids[i] for i in left)[:k]


# Main text


def test_blocks():
    html = """<!DOCTYPE html><HTML><head><title>no</title><style>p{}</style></head><body><!-- <p>no</p> -->
    <nav><ul><li><a href="/">Home</a><li>Two &amp; three</ul></nav><p>One<br>line <b>bold</b>
    and&nbsp;more<p>Next &lt;x&gt;<div class="ad big">Buy</div><script>"<p>no</p>"</script><table><tr><td>a<td>b<tr><td>c</table>tail"""
    blocks = leaf_blocks(html)
    assert [b.text for b in blocks] == ["Home", "Two & three", "One line bold and more", "Next <x>", "Buy", "a", "b", "c", "tail"]
    assert blocks[0].tags == ("html", "body", "nav", "ul", "li") and blocks[0].linked == 4 and blocks[1].linked == 0
    assert blocks[4].names == {"ad", "big"} and blocks[7].tags[-2:] == ("tr", "td") and blocks[8].tags == ("html", "body")
    assert leaf_blocks("") == [] and [b.text for b in leaf_blocks("<p>a</div></b>b<p")] == ["a", "b"]


def test_open_heads_and_self_closed_drawings_hide_no_text():
    article = "<article><h1>T</h1><p>A b.</p></article>"
    for head in (
        "<head><meta charset=utf-8><title>no</title><link rel=x><script>no</script><style>p{}</style><template><p>no</p></template>",
        "<HEAD>\n<title>no</title>\n", "<head></head>",
    ):
        for start in ("<body>", "<BODY class=x>", ""):
            blocks = leaf_blocks(f"<!DOCTYPE html><html>{head}{start}{article}")
            assert [b.text for b in blocks] == ["T", "A b."], (head, start)
            assert "head" not in blocks[0].tags and blocks[0].tags[-2:] == ("article", "h1")
    assert [b.text for b in leaf_blocks("<head><title>no</title>plain <b>text</b></head><p>next")] == ["plain text", "next"]
    assert [b.text for b in leaf_blocks("<head><meta charset=x><a href=/>link</a><img src=x>after")] == ["linkafter"]
    for drawing in ("<svg/>", "<svg class='icon' />", '<SVG viewBox="0 0 1 1"/>', "<svg width=1/>", "<svg><title/><g><path d=x /></g><style/></svg>", "<svg><svg/><text>no</text></svg>"):
        blocks = leaf_blocks(f"<body><div>{drawing}{article}</div><p>end")
        assert [b.text for b in blocks] == ["T", "A b.", "end"] and blocks[0].tags == ("body", "div", "article", "h1"), drawing


def test_running_text_keeps_its_block():
    page = "<p>See <svg/> this <button>x</button> now <my-tag>word</my-tag> end <script>no</script> tail<svg><text>no</text></svg>!</p><p>b"
    assert [(b.text, b.own) for b in leaf_blocks(page)] == [("See this x now word end tail!", "p"), ("b", "p")]
    assert extraction.main_text(f"<article><h1>T</h1>{page}</article>", extraction.default_field()) == "T\nSee this x now word end tail!\nb"


UNCLOSED = ["<td>x", "<div>x", "<div class=content>x", "<tr>x", "<li>x<ul>", "<dt>x", "<div><tr>", "<a ", "<a b='", '<a "', "<", "</div", "<!--", "<svg>", "<b>x", "</section>x"]


@pytest.mark.parametrize("bit", UNCLOSED)
def test_broken_pages_take_linear_time_and_memory(bit):
    page = bit * (200_000 // len(bit)) + '"'
    field = extraction.default_field()
    begin = time.process_time()
    blocks = leaf_blocks("<section>" + page, field.known)
    field.decode(blocks)
    assert time.process_time() - begin < 5
    tracemalloc.start()
    leaf_blocks("<section>" + page, field.known)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100e6
    if bit == "<div>x":
        assert len(blocks) == len(page) // len(bit) and blocks[-1].above == {"section", "div"}


class _Plain(HTMLParser):
    """Blocks by Python's own parser, for pages whose tags are all closed."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack, self.held, self.blocks = [], [], []

    def flush(self):
        text = " ".join("".join(self.held).split())
        if text:
            self.blocks.append((text, tuple(t for t in self.stack if t in BLOCK)))
        self.held = []

    def handle_starttag(self, tag, attributes):
        if tag in BLOCK:
            self.flush()
        if tag == "br":
            self.held.append(" ")
        elif tag not in VOID:
            self.stack.append(tag)

    def handle_endtag(self, tag):
        if tag in BLOCK:
            self.flush()
        if tag in self.stack:
            self.stack.pop()

    def handle_data(self, data):
        if not set(self.stack) & HIDDEN:
            self.held.append(data)


def test_blocks_of_closed_pages_equal_the_standard_parser():
    rng = random.Random(11)

    def part(depth):
        kind = rng.random()
        if depth == 0 or kind < 0.4:
            return rng.choice(["x", " y ", "&lt;a&gt; ", "é\n", "<br>", "<!-- <p>no</p> -->", "<script>if (a<b) '<p>'</script>", "1 < 2 "])
        tag = rng.choice(["div", "section", "ul", "table", "b", "my-tag", "button", "span", "svg", "blockquote", "h2", "article"])
        value = rng.choice(["", " class='a>b'", ' id="x y"', " hidden"])
        return f"<{tag}{value}>" + "".join(part(depth - 1) for _ in range(rng.randrange(4))) + f"</{tag}>"

    for _ in range(300):
        page = "".join(part(5) for _ in range(4))
        plain = _Plain()
        plain.feed(page)
        plain.close()
        plain.flush()
        assert [(b.text, b.tags) for b in leaf_blocks(page)] == plain.blocks, page


def test_field_prefers_and_decodes_as_brute_force():
    rng = np.random.default_rng(2)
    turns = rng.standard_normal((2, 2))
    scores = rng.standard_normal((7, 2))
    every = {labels: sum(scores[i, l] for i, l in enumerate(labels)) + sum(turns[a, b] for a, b in zip(labels, labels[1:]))
             for labels in np.ndindex(*(2,) * 7)}
    best = max(every, key=every.get)

    class Given(extraction.Field):
        def scores(self, blocks):
            return scores

    assert Given({}, turns).decode([None] * 7) == [bool(x) for x in best]
    total = np.logaddexp.reduce(list(every.values()))
    value, wanted, turned = extraction.likelihood(scores, turns, np.array(best))
    assert abs(value - (every[best] - total)) < 1e-9
    step = 1e-5
    scores2 = scores.copy()
    scores2[3, 1] += step
    assert abs((extraction.likelihood(scores2, turns, np.array(best))[0] - value) / step - wanted[3, 1]) < 1e-3
    turns2 = turns.copy()
    turns2[1, 0] += step
    assert abs((extraction.likelihood(scores, turns2, np.array(best))[0] - value) / step - turned[1, 0]) < 1e-3


def test_held_out_labelled_pages():
    field = extraction.default_field()
    pages = extraction.labelled_pages(100, seed=77)
    wrong = sum(a != b for blocks, labels in pages for a, b in zip(field.decode(blocks), labels))
    assert wrong <= 0.02 * sum(len(labels) for _, labels in pages)


def test_extraction_defined_cases(spark):
    article = "<html><body><nav><a>m</a></nav><article><h1>T</h1><p>A b.</p></article><footer>&copy; x</footer></body></html>"
    long = "<article>" + "<p>Ein langer Absatz mit Worten.</p>" * 20_000 + "</article>"
    pages = spark.createDataFrame([(1, article, "own"), (1, article, "own"), (2, None, "own"), (3, "", "own"), (4, "<nav>x</nav>", "own"), (5, long, "own")], "page_id bigint, html string, names string")
    rows = defaultdict(list)
    for r in extraction.extract(pages).collect():
        rows[r["page_id"]].append((r["text"], r["n_chars"], r["names"]))
    assert rows[1] == 2 * [("T\nA b.", 6, "own")] and rows[2] == rows[3] == [("", 0, "own")] and rows[4] == [("", 0, "own")]
    assert rows[5][0][0].count("\n") == 19_999
    assert extraction.extract(pages.limit(0)).count() == 0


def test_given_pages_are_extracted_whole(spark):
    """In the given pages all of an article is main text, and nothing else is."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    for r in extraction.extract(pages).collect():
        article = [b.text for b in leaf_blocks(r["html"]) if "article" in b.tags]
        assert r["text"] == "\n".join(article)


# The pipeline


def test_pipeline_stages_follow_each_other(spark, tmp_path):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        out.write.parquet(str(tmp_path / name))
        seen[name] = [r.asDict() for r in spark.read.parquet(str(tmp_path / name)).collect()]
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == columns or name == "pack_sequences"
    texts = Counter(r["text"] for r in seen["language_id"])
    assert Counter(r["text"] for r in seen["exact_dedup"]) == Counter(set(texts))
    assert {r["doc_id"] for r in seen["near_dedup"]} < {r["doc_id"] for r in seen["exact_dedup"]}
    assert {r["doc_id"] for r in seen["mix_sources"]} <= {r["doc_id"] for r in seen["near_dedup"]}
    assert {r["doc_id"] for r in seen["pack_sequences"]} == {r["doc_id"] for r in seen["mix_sources"]}
    whole = corpus_pipeline.run(spark, sf_dir).collect()
    key = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert Counter(tuple(r[k] for k in key) for r in whole) == Counter(tuple(r[k] for k in key) for r in seen["pack_sequences"])


def test_pipeline_takes_empty_tables(spark, no_documents):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_documents, "").count() == 0
