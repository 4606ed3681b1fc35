"""The registered query of each operator, over its whole table, and its SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetables.llm import (
    codes,
    exactdedup,
    extraction,
    language,
    minhash,
    mixing,
    packing,
    repair,
    secrets,
    sharding,
    toolcalls,
    topk,
    urlfilter,
)
from pagetables.llm.common import count_words, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
SHARDS = 16
NEIGHBOURS = 5


def query(sql: str | None = None):
    def register(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[run.__name__] = run
        if sql is not None:
            ORACLES[run.__name__] = sql
        return run

    return register


@query()
def op1_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    text = F.col("text")
    return sharding.shards(docs, SHARDS).select(
        "doc_id",
        sharding.record_size(text).alias("size"),
        sharding.text_crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query()
def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return language.identify(docs).select(
        "doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )


TOOLS = {
    "ask": [
        {"name": "query", "type": "string", "required": True, "most_length": 300},
        {"name": "turn", "type": "integer", "required": True, "least": 0.0},
        {"name": "words", "type": "integer", "required": True, "least": 5.0, "most": 60.0},
    ],
    "instruct": [
        {"name": "query", "type": "string", "required": True},
        {"name": "turn", "type": "integer", "required": True, "least": 0.0, "most": 0.0},
    ],
}


@query(
    r"""
    WITH RECURSIVE said AS (
      SELECT *, CASE WHEN length(trim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))) = 0 THEN 0
                ELSE len(string_split_regex(trim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '[\x20\x09-\x0D]+')) END AS words
      FROM conversations),
    calls AS (SELECT conv_id, turn, text, words, CASE role WHEN 'user' THEN 'ask' ELSE 'instruct' END AS name
              FROM said WHERE role IS DISTINCT FROM 'assistant'),
    results AS (SELECT conv_id, turn - 1 AS turn, turn AS result_turn, text AS content FROM said WHERE role = 'assistant'),
    deep AS (
      SELECT conv_id, turn, CAST(0 AS BIGINT) AS depth FROM calls c
      WHERE NOT EXISTS (SELECT 1 FROM calls p WHERE p.conv_id = c.conv_id AND p.turn = c.turn - 2)
      UNION ALL
      SELECT c.conv_id, c.turn, d.depth + 1 FROM deep d JOIN calls c ON c.conv_id = d.conv_id AND c.turn = d.turn + 2),
    placed AS (SELECT c.*, d.depth FROM calls c JOIN deep d ON d.conv_id = c.conv_id AND d.turn = c.turn),
    linked AS (
      SELECT coalesce(p.conv_id, r.conv_id) AS conv_id, coalesce(p.turn, r.turn) AS place, p.turn, p.depth, p.name, p.text,
             p.words, r.result_turn, r.content
      FROM placed p FULL JOIN results r ON p.conv_id = r.conv_id AND p.turn = r.turn),
    checked AS (
      SELECT *, array_to_string(list_filter(CASE name
        WHEN 'ask' THEN [CASE WHEN length(text) > 300 THEN 'query: too long' END,
                         CASE WHEN words < 5 THEN 'words: too small' WHEN words > 60 THEN 'words: too large' END]
        WHEN 'instruct' THEN [CASE WHEN turn > 0 THEN 'turn: too large' END, 'words: not a field'] END,
        lambda x: x IS NOT NULL), '; ') AS errors
      FROM linked)
    SELECT conv_id, 't' || place AS call_id, depth, turn, result_turn, CASE WHEN turn IS NOT NULL THEN CAST(1 AS BIGINT) END AS copies,
           CASE WHEN result_turn IS NOT NULL THEN CAST(1 AS BIGINT) END AS result_copies, name,
           CASE WHEN turn IS NULL THEN 'no_call' WHEN result_turn IS NULL THEN 'no_result' WHEN errors <> '' THEN 'invalid'
                ELSE 'ok' END AS status,
           errors, '{"query":' || to_json(text) || ',"turn":' || turn || ',"words":' || words || '}' AS arguments, content,
           '{"arguments":{"query":' || to_json(text) || ',"turn":' || turn || ',"words":' || words || '},"id":"t' || place ||
             '","name":"' || name || '"' || coalesce(',"result":' || to_json(content), '') || '}' AS call_json
    FROM checked"""
)
def op3_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as tool calls: what a user or the system says is a call whose arguments hold the
    text, an assistant's turn is the result of the turn before it, and a call's parent is the
    call two turns earlier.  A turn whose role is NULL is a call of ``instruct``."""
    said = table(spark, sf_dir, "conversations")
    number = F.col("turn")

    def name(turn):
        return F.concat(F.lit("t"), turn.cast("string"))

    calls = said.filter("role is distinct from 'assistant'").select(
        "conv_id", name(number).alias("call_id"), name(number - 2).alias("parent_id"), "turn",
        F.when(F.col("role") == "user", "ask").otherwise("instruct").alias("name"),
        F.to_json(F.struct("turn", count_words(F.col("text")).alias("words"), F.col("text").alias("query"))).alias("arguments"),
    )
    results = said.filter("role = 'assistant'").select(
        "conv_id", name(number - 1).alias("call_id"), "turn", F.col("text").alias("content")
    )
    return toolcalls.link(calls, results, toolcalls.schema_table(spark, TOOLS))


@query(
    r"""
    WITH RECURSIVE split AS (
      SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
    sets AS (
      SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
        ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS hs FROM split),
    members AS (SELECT doc_id, len(hs) AS n, unnest(hs) AS h FROM sets),
    pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, any_value(a.n) AS nx, any_value(b.n) AS ny, count(*) AS c
              FROM members a JOIN members b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY ALL),
    links AS (SELECT x, y FROM pairs WHERE 100 * c >= 75 * (nx + ny - c)),
    arcs AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
    reach AS (SELECT doc_id AS node, doc_id AS seen FROM documents
              UNION SELECT r.node, b.y FROM reach r JOIN arcs b ON r.seen = b.x),
    least AS (SELECT node, min(seen) AS component_id FROM reach GROUP BY node)
    SELECT s.doc_id, CAST(len(s.hs) AS BIGINT) AS n_shingles, l.component_id, s.doc_id = l.component_id AS kept
    FROM sets s JOIN least l ON l.node = s.doc_id"""
)
def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.groups(table(spark, sf_dir, "documents"))


@query(
    r"""
    WITH sized AS (
      SELECT doc_id, text, source, md5('mix|' || CAST(doc_id AS VARCHAR)) AS place,
             CAST(CASE WHEN coalesce(length(trim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))), 0) = 0 THEN 0
               ELSE len(string_split_regex(trim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '[\x20\x09-\x0D]+')) END AS BIGINT) AS size
      FROM documents),
    sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
    weighed AS (SELECT *, [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight FROM sizes),
    levels AS (
      SELECT *, (sum(source_size) OVER () * CAST(1.5 AS DOUBLE) - 2 * coalesce(sum(source_size) OVER before, 0))
                / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
      FROM weighed
      WINDOW before AS (ORDER BY CAST(source_size AS DOUBLE) / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    shared AS (SELECT *, max(CASE WHEN source_size * 2 > level * weight THEN level END) OVER () AS final FROM levels),
    targets AS (
      SELECT source, source_size, CASE WHEN source_size * 2 <= level * weight THEN CAST(source_size * 2 AS DOUBLE)
             ELSE final * weight END AS target FROM shared),
    run AS (
      SELECT s.doc_id, s.size, t.source_size, t.target,
             CASE WHEN t.source_size > 0 THEN CAST(floor(t.target / t.source_size) AS BIGINT) ELSE 0 END AS epochs,
             CAST(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.place, s.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS upto
      FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
    SELECT doc_id, size, source_size, target,
           CAST(epochs * size + greatest(0, least(size, CAST(floor(target) AS BIGINT) - epochs * source_size - (upto - size))) AS BIGINT) AS taken
    FROM run"""
)
def op5_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs, keep_text=False).select("doc_id", "size", "source_size", "target", "taken")


@query(
    r"""
    WITH parts AS (
      SELECT page_id, url, translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
      FROM pages),
    rules(verdict, host, path) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
      ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/'))
    SELECT p.page_id, p.host, p.path, r.rule, coalesce(r.verdict, 'allow') AS verdict
    FROM parts p LEFT JOIN LATERAL (
      SELECT q.host || q.path AS rule, q.verdict FROM rules q
      WHERE (p.host = q.host OR ends_with(p.host, '.' || q.host)) AND starts_with(p.path, q.path)
      ORDER BY length(q.host || q.path) DESC LIMIT 1) r ON true"""
)
def op6_url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The SQL has the rules alone: the given pages hold no link between URLs of different
    rules (the propagation is tested on small tables of links)."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    judged = urlfilter.judge(pages, urlfilter.rule_table(spark))
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query()
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.packed(docs, ids=False).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


@query(
    """
    WITH whole AS (
      SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (
      SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
      FROM whole q JOIN whole c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0),
    ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5"""
)
def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").filter(topk.usable(F.col("embedding")))
    vectors = rows.select("vec_id", topk.integers(F.col("embedding")).alias("v"))
    return topk.nearest(vectors, F.col("vec_id") % 50 == 0, NEIGHBOURS)


@query()
def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extraction.extract(pages).select("page_id", "url", "text", "n_chars")


@query(
    """
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW same AS (PARTITION BY sha256(coalesce(text, '')))"""
)
def op10_exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return exactdedup.groups(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def _code_sql(rounds: int = codes.ROUNDS) -> str:
    """The rounds one after the other; distances of every part to every entry."""
    mean = "(s - ((s % n) + n) % n) // n"
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""
    a{i} AS MATERIALIZED (
      SELECT r, p, any_value(x) AS x, min({{'d': d, 'e': e}}) AS m FROM (
        SELECT a.r, a.p, a.x, c.e, list_sum(list_transform(range(1, len(a.x) + 1), lambda i: (a.x[i] - c.c[i]) * (a.x[i] - c.c[i]))) AS d
        FROM parts a JOIN c{i} c ON a.p = c.p) GROUP BY r, p)""")
        if i < rounds:
            steps.append(f"""
    c{i + 1} AS MATERIALIZED (
      SELECT o.p, o.e, coalesce(w.c, o.c) AS c FROM c{i} o LEFT JOIN (
        SELECT p, e, list({mean} ORDER BY i) AS c FROM (
          SELECT p, e, i, sum(y) AS s, count(*) AS n FROM (
            SELECT p, m.e AS e, unnest(range(len(x))) AS i, unnest(x) AS y FROM a{i}) GROUP BY p, e, i)
        GROUP BY p, e) w ON o.p = w.p AND o.e = w.e)""")
    return f"""
    WITH kept AS (
      SELECT vec_id, label, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r,
             list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    parts AS MATERIALIZED (
      SELECT r, p, v[p * (len(v) // 8) + 1 : (p + 1) * (len(v) // 8)] AS x FROM kept, (SELECT unnest(range(8)) AS p)),
    c0 AS (SELECT p, r - 1 AS e, x AS c FROM parts WHERE r <= 16),{",".join(steps)},
    coded AS (
      SELECT r, string_agg(printf('%02x', m.e), '' ORDER BY p) AS code, CAST(sum(m.d) AS BIGINT) AS error FROM a{rounds} GROUP BY r),
    books AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM c{rounds})
    SELECT k.vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error, b.codebooks_sha256
    FROM kept k JOIN coded c ON k.r = c.r, books b"""


@query(_code_sql())
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))


def _span_sql() -> str:
    """The base spans: a match starts after all gaps and matches before it."""
    words = ("password", "passwd", "secret", "token", "api_?key")
    either = ["".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in words]
    assign = f"({'|'.join(either)})[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)"
    kinds = [("assign", assign, 2, 6), ("access", "(AKIA[A-Z0-9]+)", 1, 20), ("hex", "([0-9a-f]{24,})", 1, 24)]
    found = " UNION ALL ".join(
        f"SELECT row, {i} AS kind, '{name}' AS name, {least} AS least, regexp_extract_all(text, '{p}') AS ms, "
        f"regexp_extract_all(text, '{p}', {group}) AS vs, string_split_regex(text, '{p}') AS gaps FROM texts"
        for i, (name, p, group, least) in enumerate(kinds)
    )
    counts = ", ".join(f"count(*) FILTER (kind = {i}) AS n_{name}" for i, (name, *_) in enumerate(kinds))
    shown = ", ".join(f"CAST(coalesce(n_{name}, 0) AS BIGINT) AS n_{name}" for name, *_ in kinds)
    return f"""
    WITH texts AS (SELECT doc_id, row_number() OVER () AS row, coalesce(text, '') AS text FROM documents),
    found AS ({found}),
    matches AS (
      SELECT row, kind, name, least, unnest(range(1, len(ms) + 1)) AS i, unnest(ms) AS m, unnest(vs) AS v, ms, gaps FROM found),
    spans AS (
      SELECT row, kind, name, length(m) AS n, CAST(list_sum(list_transform(gaps[1:i], lambda x: length(x)))
               + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS start
      FROM matches WHERE length(v) >= least),
    joined AS (
      SELECT row, {counts}, string_agg(name || ':' || start || ':' || (start + n), ',' ORDER BY start, kind) AS spans
      FROM spans GROUP BY row)
    SELECT t.doc_id, {shown}, CAST(0 AS BIGINT) AS n_confirmed, sha256(coalesce(j.spans, '')) AS base_sha256,
           coalesce(j.spans, '') AS spans
    FROM texts t LEFT JOIN joined j ON t.row = j.row"""


@query(_span_sql())
def op12_secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The SQL has the base spans alone: the given documents hold no key encoding and no signed
    token, so nothing is confirmed in them (``tests/llm/test_secrets.py`` has texts that do)."""
    return secrets.scan(table(spark, sf_dir, "documents"))


def _repair_sql() -> str:
    """The grammar as four states, each with its least cost and audit as one text: ten digits,
    then edits.  e: nothing yet, s: a system's turn, u: a user's, p: pairs."""
    states = "esup"

    def more(value: str, cost: str, edit: str) -> str:
        return f"(lpad(CAST(CAST({value}[1:10] AS BIGINT) + {cost} AS VARCHAR), 10, '0') || {value}[11:] || '{edit}')"

    inserted_u = f"least({', '.join(['a[3]', *[more(f'a[{i}]', '3', 'I') for i in (1, 2, 4)]])})"
    inserted = f"list_transform([[a[1], a[2], {inserted_u}, a[4]]], lambda b: [b[1], b[2], b[3], least(b[4], {more('b[3]', '3', 'I')})])[1]"
    before_u = "least(c[1], c[2], c[4])"
    cut = "CASE x[2] WHEN '3' THEN 3 ELSE 0 END"
    may = "x[2] NOT IN ('1', '2')"
    deleted = [more(f"c[{i + 1}]", "4", "D") for i in range(4)]
    s = f"CASE WHEN {may} AND x[1] = 's' THEN {more('c[1]', cut, 'K')} END"
    u = [f"CASE WHEN {may} AND x[1] = 'u' THEN {more(before_u, cut, 'K')} END", f"CASE WHEN {may} THEN {more(before_u, f'3 + {cut}', 'R')} END"]
    p = [f"CASE WHEN {may} AND x[1] = 'a' THEN {more('c[3]', cut, 'K')} END", f"CASE WHEN {may} THEN {more('c[3]', f'3 + {cut}', 'R')} END"]
    step = f"[{deleted[0]}, least({deleted[1]}, {s}), least({', '.join([deleted[2], *u])}), least({', '.join([deleted[3], *p])})]"
    name = "coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')"
    # CRC-32 bit by bit: letters of the name are the steps, zeros stand for their eight bits.
    crc = f"""xor(list_reduce([4294967295::BIGINT] || list_transform(string_split({name}, ''), lambda x: CAST(ord(x) AS BIGINT)),
               lambda c, x: list_reduce([xor(c, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda d, y: xor(d >> 1, (d & 1) * 3988292384))), 4294967295)"""
    return rf"""
    WITH cleaned AS (
      SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             {crc} % 20 AS part FROM conversations),
    damaged AS (
      SELECT conv_id, turn, CASE WHEN part = 4 THEN 'user' ELSE role END AS role,
             CASE part WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
             unnest(range(CASE part WHEN 3 THEN 2 ELSE 1 END)) AS copy
      FROM cleaned WHERE part <> 0),
    placed AS (
      SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS place FROM damaged),
    marked AS (
      SELECT *, role[1:1] AS initial,
             CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 1
                  WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 THEN 2
                  WHEN NOT regexp_matches(text, '[.!?][ 	-
]*\z') THEN 3 ELSE 0 END AS fault,
             lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY place) AS earlier
      FROM placed),
    grouped AS (
      SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
             count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
             count(*) FILTER (earlier || initial NOT IN ('su', 'ua', 'au')) AS illegal,
             list([initial, CAST(fault AS VARCHAR)] ORDER BY place) AS rows
      FROM marked GROUP BY conv_id),
    walked AS (
      SELECT *, list_reduce(rows, lambda a, x: list_transform([{inserted}], lambda c: {step})[1],
                            ['0000000000', NULL, NULL, NULL]::VARCHAR[]) AS a FROM grouped),
    ended AS (SELECT *, list_transform([{inserted}], lambda c: least(c[1], c[4]))[1] AS best FROM walked),
    audited AS (SELECT *, CAST(best[1:10] AS BIGINT) AS cost, best[11:] AS audit FROM ended),
    edits AS (
      SELECT conv_id, unnest(range(1, length(audit) + 1)) AS nth, unnest(string_split(audit, '')) AS edit FROM audited WHERE audit <> ''),
    numbered AS (
      SELECT *, sum(CAST(edit <> 'I' AS INT)) OVER sofar AS place, sum(CAST(edit <> 'D' AS INT)) OVER sofar AS seq
      FROM edits WINDOW sofar AS (PARTITION BY conv_id ORDER BY nth)),
    joined AS (
      SELECT n.conv_id, n.seq, n.edit, m.role, m.initial, m.text,
             max(CASE WHEN n.seq = 1 AND n.edit = 'K' AND m.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY n.conv_id) AS shift
      FROM numbered n LEFT JOIN marked m ON n.conv_id IS NOT DISTINCT FROM m.conv_id AND n.place = m.place AND n.edit <> 'I' WHERE n.edit <> 'D'),
    hashed AS (
      SELECT conv_id, sha256(string_agg(CASE WHEN edit = 'K' THEN role WHEN (seq - shift) % 2 = 1 THEN 'user' ELSE 'assistant' END
                                        || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY seq)) AS h
      FROM joined GROUP BY conv_id),
    ids AS (SELECT DISTINCT conv_id FROM conversations)
    SELECT i.conv_id, CAST(coalesce(a.gaps, 0) AS BIGINT) AS gaps, coalesce(a.blank, 0) AS blank, coalesce(a.duplicate, 0) AS duplicate,
           coalesce(a.truncated, 0) AS truncated, coalesce(a.illegal, 0) AS illegal, coalesce(a.cost, 0) AS cost,
           coalesce(a.audit, '') AS audit, coalesce(h.h, sha256('')) AS repaired_sha256
    FROM ids i LEFT JOIN audited a ON i.conv_id IS NOT DISTINCT FROM a.conv_id
    LEFT JOIN hashed h ON i.conv_id IS NOT DISTINCT FROM h.conv_id"""


@query(_repair_sql())
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repair.repair_all(repair.damaged(turns), turns)
