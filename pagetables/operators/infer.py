"""Column inference from values, and from names where there are no values.

A value is turned into facts once (its kind, number, date formats, shape); facts become
votes by counting; votes become a column description.  The same three steps serve small
samples inside a document's row (``infer_tables``) and whole tables (``profile``).

These rules are this engine's own; they answer the questions a model would be asked:
type, nullability, format, range, pattern and confidence of every column.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetables.functions.rows import once
from pagetables.functions.text import bind, choose, json_text, strip

KINDS = ["int", "float", "date", "boolean", "object", "array", "string"]

INT = r"^[+-]?[0-9]+$"
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
# Whole numbers are compared exactly up to this many digits, beyond as doubles.
WHOLE = "decimal(38,0)"
BOOLEAN = r"(?i)^(true|false)$"

# Date formats in order of preference; the expression is checked before the calendar.
DATE_FORMATS = {
    "yyyy-MM-dd": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$",
    "yyyy-MM-dd HH:mm:ss": r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$",
    "yyyy-MM-dd'T'HH:mm:ss": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}$",
    "yyyy/MM/dd": r"^[0-9]{4}/[0-9]{2}/[0-9]{2}$",
    "MM/dd/yyyy": r"^[0-9]{2}/[0-9]{2}/[0-9]{4}$",
    "dd/MM/yyyy": r"^[0-9]{2}/[0-9]{2}/[0-9]{4}$",
    "dd.MM.yyyy": r"^[0-9]{2}\.[0-9]{2}\.[0-9]{4}$",
}
MAYBE_DATE = r"^[0-9]{2,4}[-/.][0-9]{2}[-/.][0-9]{2,4}"

# Values with control characters, line ends among them, follow no pattern.
SHAPEABLE = r"^[^\x00-\x1f]+$"

# Names to types for columns without values; the first match wins.
NAME_RULES = [
    (r"(?i)^(is|has|can)[ _]|(?i)[ _](flag|active|enabled)$", "boolean", 0.7),
    (r"(?i)(^|[ _])(date|time|timestamp|datetime|day)$|(?i)[ _]at$|(?i)date$", "date", 0.7),
    (r"(?i)(^|[ _])(id|key|count|number|num|qty|quantity|size|year|age|rank)$|(?i)key$", "int", 0.7),
    (r"(?i)(^|[ _])(price|amount|cost|total|rate|ratio|percent|balance|tax|discount|value)$|(?i)(price|bal)$", "float", 0.7),
    (r"(?i)(^|[ _])(name|title|description|comment|text|address|city|country|status|type)$", "string", 0.7),
]
UNKNOWN_CONFIDENCE = 0.5

# Type names of other sources and what they are called here.
TYPE_ALIASES = {
    "string": "string str varchar char text nvarchar nchar",
    "int": "int integer long bigint smallint tinyint",
    "float": "float double number numeric decimal real",
    "date": "date time datetime timestamp",
    "boolean": "boolean bool",
    "object": "object dict map",
    "array": "array list tuple",
    "binary": "bytes binary",
    "null": "null none nonetype",
}

COLUMN_DDL = (
    "struct<name:string,type:string,description:string,nullable:boolean,confidence:double,"
    "inferred:boolean,format:string,constraints:variant,sample_values:array<string>>"
)


# --- facts about one value ----------------------------------------------------------------


def shape(value: Column) -> Column:
    """A value as an expression: runs of capitals, small letters and digits generalised."""
    marks = {"[A-Z]+": "\u0001", "[a-z]+": "\u0002", "[0-9]+": "\u0003"}
    text = F.regexp_replace(value, r"([\\.^$|?*+()\[\]{}])", r"\\$1")
    for run, mark in marks.items():
        text = F.regexp_replace(text, run, mark)
    for run, mark in marks.items():
        text = F.replace(text, F.lit(mark), F.lit(run.replace("[0-9]", r"\d")))
    return F.concat(F.lit("^"), text, F.lit("$"))


def date_mask(value: Column) -> Column:
    """Bit i is set when the value is a date in the i-th format."""
    bits = F.lit(0)
    for i, (form, check) in enumerate(DATE_FORMATS.items()):
        hit = F.when(value.rlike(check), F.try_to_timestamp(value, F.lit(form)).isNotNull())
        bits = bits + F.when(hit, 1 << i).otherwise(0)
    return choose(value.rlike(MAYBE_DATE), bits, 0)


def json_kind(value: Column) -> Column:
    def held(begin: str, end: str) -> Column:
        return value.startswith(begin) & value.endswith(end) & F.try_parse_json(value).isNotNull()

    return choose(held("{", "}"), "object", choose(held("[", "]"), "array"))


def plain_kind(v: Column) -> Column:
    """Kind of a stripped value by its text alone; ``?`` when that does not tell."""
    filled = choose(v.rlike(NUMBER), "float", choose(v.rlike(BOOLEAN), "boolean", "?"))
    return choose(v == "", None, choose(v.rlike(INT), "int", filled))


def open_dates(v: Column, plain: Column) -> Column:
    return choose(plain == "?", date_mask(v), 0)


def full_kind(v: Column, plain: Column, dates: Column) -> Column:
    text = choose(plain == "?", F.coalesce(json_kind(v), F.lit("string")))
    return choose(plain != "?", plain, choose(dates > 0, "date", text))


def fact(v: Column, kind: Column, dates: Column) -> dict[str, Column]:
    return {
        "kind": kind,
        "number": choose((kind == "int") | (kind == "float"), v.try_cast("double")),
        "whole": choose(kind == "int", v.try_cast(WHOLE)),
        "dates": dates,
        "shape": choose((kind == "string") & v.rlike(SHAPEABLE), shape(v)),
    }


def with_facts(cells: DataFrame, value: str = "value") -> DataFrame:
    """The same as columns in place of ``value``: one projection per step, all compiled."""
    keep = [c for c in cells.columns if c != value]
    v, plain, dates, kind = (F.col(f"_{c}") for c in ("v", "plain", "dates", "kind"))
    steps = cells.select(*keep, strip(F.coalesce(value, F.lit(""))).alias("_v"))
    steps = steps.select("*", plain_kind(v).alias("_plain"))
    steps = steps.select("*", open_dates(v, plain).alias("_dates"))
    steps = steps.select("*", full_kind(v, plain, dates).alias("_kind"))
    return steps.select(*keep, *[c.alias(name) for name, c in fact(v, kind, dates).items()])


# --- votes --------------------------------------------------------------------------------


def row_votes() -> Column:
    """Votes as aggregate functions over ``with_facts`` rows; all of them combine before an
    exchange.

    Collecting the (at most seven) kinds makes Spark hash objects; minima of strings
    without it would make it sort all rows.
    """
    kind, dates, shaped = F.col("kind"), F.col("dates"), F.col("shape")
    return F.struct(
        F.array_sort(F.collect_set(kind)).alias("kinds"),
        F.count(F.lit(1)).alias("total"),
        F.count_if(kind.isNull()).alias("blank"),
        F.count_if(kind == "string").alias("strings"),
        F.array(*[F.count_if(dates.bitwiseAND(1 << i) != 0) for i in range(len(DATE_FORMATS))])
        .alias("formats"),
        F.min("number").alias("minimum"),
        F.max("number").alias("maximum"),
        F.count("whole").alias("wholes"),
        F.min("whole").alias("least"),
        F.max("whole").alias("most"),
        F.count_if((kind == "string") & shaped.isNull()).alias("shapeless"),
        F.min(shaped).alias("first_shape"),
        F.max(shaped).alias("last_shape"),
    )


def array_votes(values: Column) -> Column:
    """The same votes over an array of values, step by step over whole arrays."""

    def by(step: Callable[..., Column], items: Column, *others: Column) -> Column:
        """``step`` of every item and of the items beside it in the other arrays."""
        return F.transform(items, lambda v, i: step(v, *[F.get(o, i) for o in others]))

    def count(items: Column, test: Callable[[Column], Column]) -> Column:
        return F.size(F.filter(items, test)).cast("bigint")

    def hits(dates: Column, i: int) -> Column:
        return count(dates, lambda d: d.bitwiseAND(1 << i) != 0)

    def counted(
        kinds: Column, found: Column, dates: Column, numbers: Column, wholes: Column, shapes: Column
    ) -> Column:
        strings = F.when(
            F.array_contains(found, "string"),
            count(kinds, lambda k: F.coalesce(k == "string", F.lit(False))),
        ).otherwise(F.lit(0).cast("bigint"))
        return F.struct(
            found.alias("kinds"),
            F.size(kinds).cast("bigint").alias("total"),
            count(kinds, lambda k: k.isNull()).alias("blank"),
            strings.alias("strings"),
            F.when(
                F.array_contains(found, "date"),
                F.array(*[hits(dates, i) for i in range(len(DATE_FORMATS))]),
            ).alias("formats"),
            F.array_min(numbers).alias("minimum"),
            F.array_max(numbers).alias("maximum"),
            F.size(F.array_compact(wholes)).cast("bigint").alias("wholes"),
            F.array_min(wholes).alias("least"),
            F.array_max(wholes).alias("most"),
            (strings - F.size(F.array_compact(shapes))).alias("shapeless"),
            F.array_min(shapes).alias("first_shape"),
            F.array_max(shapes).alias("last_shape"),
        )

    def with_found(vs: Column, dates: Column, kinds: Column, found: Column) -> Column:
        """``found`` has the few kinds there are; what none of them asks for is not looked at."""

        def where(test: Column, name: str, ddl: str) -> Column:
            facts = by(lambda v, k: fact(v, k, k)[name], vs, kinds)
            return F.when(test, facts).otherwise(F.array().cast(f"array<{ddl}>"))

        whole = F.array_contains(found, "int")
        numbers = where(whole | F.array_contains(found, "float"), "number", "double")
        wholes = where(whole, "whole", WHOLE)
        shapes = where(found == F.array(F.lit("string")), "shape", "string")
        return bind(
            numbers,
            lambda n: bind(
                wholes,
                lambda w: bind(shapes, lambda s: counted(kinds, found, dates, n, w, s)),
            ),
        )

    def with_kinds(vs: Column, dates: Column, kinds: Column) -> Column:
        found = F.array_sort(F.array_compact(F.array_distinct(kinds)))
        return bind(found, lambda known: with_found(vs, dates, kinds, known))

    def with_dates(vs: Column, plains: Column, dates: Column) -> Column:
        kinds = F.when(F.size(dates) > 0, by(full_kind, vs, plains, dates)).otherwise(plains)
        return bind(kinds, lambda known: with_kinds(vs, dates, known))

    def with_plains(vs: Column, plains: Column) -> Column:
        unclear = F.exists(plains, lambda p: F.coalesce(p == "?", F.lit(False)))
        dates = F.when(unclear, by(open_dates, vs, plains)).otherwise(F.array().cast("array<int>"))
        return bind(dates, lambda known: with_dates(vs, plains, known))

    stripped = F.transform(values, lambda v: strip(F.coalesce(v, F.lit(""))))
    return bind(
        stripped,
        lambda vs: bind(F.transform(vs, plain_kind), lambda plains: with_plains(vs, plains)),
    )


# --- columns ------------------------------------------------------------------------------


def resolved_type(kinds: Column) -> Column:
    """The only kind of value, ``float`` for mixed numbers, else ``string``."""
    return (
        F.when(F.size(kinds) == 0, "null")
        .when(F.size(kinds) == 1, F.get(kinds, F.lit(0)))
        .when(kinds == F.array(F.lit("float"), F.lit("int")), "float")
        .otherwise("string")
    )


def constraints_of(minimum: Column, maximum: Column, pattern: Column) -> Column:
    """Constraints as a variant without absent members; NULL when there is none.  Bounds are
    given as they are written in JSON."""
    members = F.array_compact(
        F.array(
            F.concat(F.lit('"minimum":'), minimum),
            F.concat(F.lit('"maximum":'), maximum),
            F.concat(F.lit('"pattern":'), json_text(pattern)),
        )
    )

    def parsed(present: Column) -> Column:
        text = F.concat(F.lit("{"), F.array_join(present, ","), F.lit("}"))
        return F.when(F.size(present) > 0, F.try_parse_json(text))

    return bind(members, parsed)


def described(name: Column) -> Column:
    return F.concat(F.lit("Column containing "), name, F.lit(" data"))


def resolve(v: Column) -> Column:
    """Votes to ``struct<type, nullable, confidence, format, minimum, maximum, least, most,
    pattern>``; ``least`` and ``most`` are the exact bounds as text, NULL where there are none
    or where a whole number has more digits than are compared exactly."""
    filled = v["total"] - v["blank"]

    def rest(kind: Column) -> Column:
        agreeing = F.when(kind == "string", v["strings"]).otherwise(filled)
        most = F.array_max(v["formats"])
        form = F.get(
            F.array(*[F.lit(f) for f in DATE_FORMATS]),
            F.array_position(v["formats"], most).cast("int") - 1,
        )
        numeric = kind.isin("int", "float")
        exact = (kind == "int") & (v["wholes"] == filled)
        one_shape = (
            (kind == "string")
            & (v["strings"] == filled)
            & (v["shapeless"] == 0)
            & (v["first_shape"] == v["last_shape"])
        )
        return F.struct(
            kind.alias("type"),
            (v["blank"] > 0).alias("nullable"),
            F.when(filled == 0, 1.0)
            .otherwise(F.round(agreeing.cast("double") / filled, 3))
            .alias("confidence"),
            F.when(kind == "date", form).otherwise("").alias("format"),
            F.when(numeric, v["minimum"]).alias("minimum"),
            F.when(numeric, v["maximum"]).alias("maximum"),
            F.when(exact, v["least"].cast("string")).alias("least"),
            F.when(exact, v["most"].cast("string")).alias("most"),
            F.when(one_shape, v["first_shape"]).alias("pattern"),
        )

    return bind(resolved_type(v["kinds"]), rest)


def named_column(name: Column) -> Column:
    """A column known by name only."""

    def by_rules(pick: Callable[[tuple], object], otherwise: object) -> Column:
        chain = F
        for rule in NAME_RULES:
            chain = chain.when(strip(name).rlike(rule[0]), F.lit(pick(rule)))
        return chain.otherwise(F.lit(otherwise))

    return F.struct(
        name.alias("name"),
        by_rules(lambda r: r[1], "string").alias("type"),
        described(name).alias("description"),
        F.lit(True).alias("nullable"),
        by_rules(lambda r: r[2], UNKNOWN_CONFIDENCE).alias("confidence"),
        F.lit(True).alias("inferred"),
        F.lit("").alias("format"),
        F.lit(None).cast("variant").alias("constraints"),
        F.array().cast("array<string>").alias("sample_values"),
    ).cast(COLUMN_DDL)


def valued_column(name: Column, found: Column, samples: Column) -> Column:
    return F.struct(
        name.alias("name"),
        found["type"].alias("type"),
        described(name).alias("description"),
        found["nullable"].alias("nullable"),
        found["confidence"].alias("confidence"),
        F.lit(False).alias("inferred"),
        found["format"].alias("format"),
        constraints_of(
            F.coalesce(found["least"], found["minimum"].cast("string")),
            F.coalesce(found["most"], found["maximum"].cast("string")),
            found["pattern"],
        ).alias("constraints"),
        samples.alias("sample_values"),
    ).cast(COLUMN_DDL)


def table_columns(table: Column) -> Column:
    """One column per header of a table struct, from its rows or, without rows, its names."""
    rows = table["rows"]

    def from_values(name: Column, i: Column) -> Column:
        values = F.transform(rows, lambda r: F.coalesce(F.get(r, i), F.lit("")))
        return bind(
            values,
            lambda vs: bind(
                resolve_bound(array_votes(vs)),
                lambda found: valued_column(name, found, F.slice(vs, 1, 5)),
            ),
        )

    return F.when(F.size(rows) > 0, F.transform(table["headers"], from_values)).otherwise(
        F.transform(table["headers"], named_column)
    )


def resolve_bound(votes: Column) -> Column:
    return bind(votes, resolve)


# --- operators ----------------------------------------------------------------------------


def infer_tables(tables: DataFrame) -> DataFrame:
    """Add ``columns`` to a table per row (``tables_of``); no exchange."""
    record = F.struct("headers", "rows")
    return once(tables, columns=bind(record, table_columns))


def infer_from_names(headers: DataFrame, name: str = "name") -> DataFrame:
    """``(…, type, confidence, inferred)`` for column names without values."""
    column = named_column(F.col(name))
    return headers.withColumn("c", column).select(
        "*", F.col("c.type").alias("type"), F.col("c.confidence").alias("confidence"),
        F.col("c.inferred").alias("inferred"),
    ).drop("c")


def profile_votes(frame: DataFrame, by: Iterable[str] = ()) -> DataFrame:
    """``(by…, pos, name, votes)`` of every other column of a wide table of strings.

    One pass over the table, one long row per cell.  Votes are counts, minima and maxima,
    so each task sends one row per group and column, whatever the size of the group.
    """
    by = list(by)
    names = [c for c in frame.columns if c not in by]
    values = F.array(*[F.col(f"`{c}`") for c in names])
    cells = frame.select(*by, F.posexplode(values).alias("pos", "value"))
    votes = with_facts(cells).groupBy(*by, "pos").agg(row_votes().alias("votes"))
    name = F.get(F.array(*[F.lit(c) for c in names]), F.col("pos"))
    return votes.select(*by, "pos", name.alias("name"), "votes")


def type_votes(cells: DataFrame, keys: Iterable[str] = ("doc_id", "table_id", "pos")) -> DataFrame:
    """Votes per kind over long ``cells(…, value)``: counts and ranges of fixed width only,
    so that partial hash aggregation absorbs a table of any size."""
    return with_facts(cells.select(*keys, "value")).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("kind").isNull()).alias("blank"),
        *[F.count_if(F.col("kind") == k).alias(f"{k}_votes") for k in KINDS],
        F.min("number").alias("minimum"),
        F.max("number").alias("maximum"),
    )


def infer_columns(votes: DataFrame) -> DataFrame:
    """Votes to flat column descriptions; every row of votes gives one column."""
    keep = [c for c in votes.columns if c != "votes"]
    return votes.select(*keep, resolve(F.col("votes")).alias("r")).select(
        *keep, "r.*", described(F.col("name")).alias("description")
    )


def profile(frame: DataFrame, by: Iterable[str] = ()) -> DataFrame:
    """Column descriptions of a wide table of strings."""
    return infer_columns(profile_votes(frame, by))


def normalise_types(columns: DataFrame, aliases: dict[str, str] | None = None) -> DataFrame:
    """Map type names of other sources (``varchar(20)``, ``str``) to the names used here;
    unknown names are kept.  What stood in brackets goes to ``format`` if that is empty."""
    base = F.lower(strip(F.regexp_replace("type", r"\(.*$", "")))
    pairs = [
        F.lit(x)
        for name, words in (aliases or TYPE_ALIASES).items()
        for word in words.split()
        for x in (word, name)
    ]
    bracket = F.regexp_extract("type", r"^[^(]*(\([^)]*\))", 1)
    return columns.withColumn(
        "format",
        F.when((F.coalesce("format", F.lit("")) == "") & (bracket != ""), F.lower(strip("type")))
        .otherwise(F.col("format")),
    ).withColumn("type", F.coalesce(F.try_element_at(F.create_map(*pairs), base), F.col("type")))
