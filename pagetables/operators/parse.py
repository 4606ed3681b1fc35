"""Model answers and schema documents to schemas.

A schema is one row: ``(…, name, description, columns, metadata)`` with ``columns`` an
array of ``COLUMN_DDL`` structs and ``metadata`` a map to variants, so that numbers and
flags keep their types.  JSON is read as a variant, which tells a missing member from one
that is null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetables.functions.rows import once
from pagetables.functions.text import bind, strip
from pagetables.operators.infer import COLUMN_DDL, described

METADATA_DDL = "map<string,variant>"
COLUMNS_DDL = f"array<{COLUMN_DDL}>"

# Names and texts of placeholder schemas.
DEFAULT_NAME = "Table Schema"
UNPARSED_TEXT = "Fallback schema created due to JSON parsing issues"
EMPTY_NAME = "Empty Table Schema"
EMPTY_TEXT = "Schema created with no column data"
NULL_NAME = "Empty Schema"
NULL_TEXT = "This schema was created when a null schema was encountered."
HEADER_NAME = "CSV Data Schema"
HEADER_TEXT = "Automatically generated schema for CSV data"
NO_HEADERS = "Error: No headers found in table data"
BROKEN_TEXT = "Placeholder for column that failed to parse"
UNKNOWN_NAME = "Unknown"


def strip_fences(text: Column) -> Column:
    """Remove a leading code fence (with or without ``json``) and a trailing one."""
    body = F.regexp_replace(strip(text), r"^```(json)?", "")
    return strip(F.regexp_replace(body, r"```$", ""))


def repair_escapes(text: Column) -> Column:
    """Double every backslash that does not start one of the short escapes."""
    return F.regexp_replace(text, r'\\(?!["ntrbf])', r"\\\\")


def brace_slice(text: Column) -> Column:
    """From the first ``{`` to the last ``}``; NULL when there is no such part."""
    return F.nullif(F.regexp_extract(text, r"(?s)\{.*\}", 0), F.lit(""))


def variant_kind(value: Column) -> Column:
    """``OBJECT``, ``ARRAY``, ``STRING``, … of a variant."""
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)


def is_object(value: Column) -> Column:
    """Whether a variant is an object; the kind's name would spell out all that it holds."""
    return F.try_variant_get(value, "$", "map<string,variant>").isNotNull()


def member(value: Column, name: str, kind: str = "variant") -> Column:
    return F.try_variant_get(value, f"$.{name}", kind)


def lenient_json(text: Column) -> Column:
    """Strict JSON, else JSON with repaired escapes."""
    return F.coalesce(F.try_parse_json(text), F.try_parse_json(repair_escapes(text)))


def read_json(text: Column) -> Column:
    """``struct<json, rescued>`` of JSON text in fences, in a string, or amid other text."""

    def unquoted(value: Column) -> Column:
        inner = F.try_variant_get(value, "$", "string")
        return F.when(is_object(value), value).when(variant_kind(value) == "STRING", lenient_json(inner)).otherwise(value)

    def attempt(clean: Column) -> Column:
        return bind(
            lenient_json(clean),
            lambda whole: F.struct(
                F.when(whole.isNotNull(), unquoted(whole))
                .otherwise(lenient_json(brace_slice(clean)))
                .alias("json"),
                whole.isNull().alias("rescued"),
            ),
        )

    return bind(strip_fences(text), attempt)


def column_items(json: Column) -> Column:
    """The ``columns`` (or older ``schema``) member as an array of variants."""
    listed = F.coalesce(member(json, "columns"), member(json, "schema"))
    return F.try_variant_get(listed, "$", "array<variant>")


def object_only(value: Column) -> Column:
    return F.when(is_object(value), value)


def has_columns(json: Column) -> Column:
    return F.coalesce(member(json, "columns"), member(json, "schema")).isNotNull()


def text_or_null(value: Column) -> Column:
    """A variant as text; an object or array as JSON text."""
    return F.coalesce(F.try_variant_get(value, "$", "string"), F.when(
        ~F.is_variant_null(value), F.to_json(value)
    ))


def filled_object(value: Column) -> Column:
    """A variant object with members, else NULL."""
    return F.when(is_object(value) & (F.to_json(value) != "{}"), value)


def lenient_column(item: Column, position: Column, has_sample: Column) -> Column:
    """One column from whatever the model gave; never fails."""
    placeholder = F.concat(F.lit("Column_"), (position + 1).cast("string"))
    given = F.coalesce(member(item, "name"), member(item, "column_name"))
    name = F.when(given.isNull(), "").when(F.is_variant_null(given), placeholder).otherwise(
        text_or_null(given)
    )

    def read(name: Column) -> Column:
        return F.struct(
            name.alias("name"),
            F.coalesce(text_or_null(member(item, "type")), F.lit("string")).alias("type"),
            F.coalesce(text_or_null(member(item, "description")), described(name)).alias("description"),
            F.coalesce(member(item, "nullable", "boolean"), F.lit(True)).alias("nullable"),
            F.coalesce(member(item, "confidence", "double"), F.lit(1.0)).alias("confidence"),
            F.coalesce(member(item, "inferred", "boolean"), ~has_sample).alias("inferred"),
            F.coalesce(text_or_null(member(item, "format")), F.lit("")).alias("format"),
            filled_object(member(item, "constraints")).alias("constraints"),
            F.array().cast("array<string>").alias("sample_values"),
        ).cast(COLUMN_DDL)

    broken = F.struct(
        placeholder.alias("name"),
        F.lit("string").alias("type"),
        F.lit(BROKEN_TEXT).alias("description"),
        F.lit(True).alias("nullable"),
        F.lit(0.5).alias("confidence"),
        F.lit(True).alias("inferred"),
        F.lit("").alias("format"),
        F.lit(None).cast("variant").alias("constraints"),
        F.array().cast("array<string>").alias("sample_values"),
    ).cast(COLUMN_DDL)
    return F.when(is_object(item), bind(name, read)).otherwise(broken)


def header_columns(headers: Column) -> Column:
    """The fallback: every header as an inferred string column."""
    return F.transform(
        headers,
        lambda h: F.struct(
            h.alias("name"),
            F.lit("string").alias("type"),
            described(h).alias("description"),
            F.lit(True).alias("nullable"),
            F.lit(0.5).alias("confidence"),
            F.lit(True).alias("inferred"),
            F.lit("").alias("format"),
            F.lit(None).cast("variant").alias("constraints"),
            F.array().cast("array<string>").alias("sample_values"),
        ).cast(COLUMN_DDL),
    )


def parse_schema_text(responses: DataFrame) -> DataFrame:
    """Add ``json`` (variant) and ``status`` to rows with ``content``.

    ``parsed``: an object with columns; ``no_columns``: an object with a name only, or text
    without any usable JSON; ``not_a_schema``: JSON of another kind; ``model_error``: the
    model failed.  The last two call for the header fallback.
    """
    read = read_json(F.col("content"))
    named = member(F.col("read.json"), "name").isNotNull()
    given = is_object(F.col("read.json"))
    status = (
        F.when(F.col("content").isNull(), "model_error")
        .when(given & has_columns(F.col("read.json")), "parsed")
        .when(given & named, "no_columns")
        .when(F.col("content").startswith("Error: ") & F.col("read.rescued"), "model_error")
        .when(F.col("read.rescued"), "unparsed")
        .otherwise("not_a_schema")
    )
    return once(responses, read=read).select(
        *[c for c in responses.columns],
        F.when(status.isin("parsed", "no_columns"), F.col("read.json")).alias("json"),
        status.alias("status"),
    )


def normalise_schema(parsed: DataFrame, has_sample: str | None = None) -> DataFrame:
    """Parsed answers to schemas; rows whose status calls for the header fallback get NULL
    ``columns``."""
    json = F.col("json")
    sampled = F.col(has_sample) if has_sample else F.lit(True)
    items = F.coalesce(column_items(json), F.array().cast("array<variant>"))
    columns = F.transform(items, lambda c, i: lenient_column(c, i, sampled))
    empty = F.size(items) == 0
    usable = F.col("status").isin("parsed", "no_columns", "unparsed")
    by_default = F.when(F.col("status") == "unparsed", DEFAULT_NAME).when(
        F.col("status") == "no_columns", DEFAULT_NAME
    ).otherwise(F.when(empty, EMPTY_NAME).otherwise(DEFAULT_NAME))
    text_default = F.when(F.col("status") == "unparsed", UNPARSED_TEXT).when(
        empty & (F.col("status") == "parsed"), EMPTY_TEXT
    ).otherwise("")
    keep = [c for c in parsed.columns if c not in ("json", "content")]
    return once(
        parsed,
        name=F.when(usable, F.coalesce(text_or_null(member(json, "name")), by_default)),
        description=F.when(
            usable, F.coalesce(text_or_null(member(json, "description")), text_default)
        ),
        columns=F.when(usable, columns).cast(COLUMNS_DDL),
    ).select(*keep, "name", "description", "columns")


def fallback_schema(schemas: DataFrame, headers: str = "headers") -> DataFrame:
    """Fill schemas without columns from the table's headers; without headers the row
    becomes an error."""
    missing = F.col("columns").isNull()
    known = F.size(headers) > 0
    keep = [c for c in schemas.columns if c not in ("name", "description", "columns", "status")]
    return schemas.select(
        *keep,
        F.when(missing & ~known, NO_HEADERS)
        .otherwise(F.col("status"))
        .alias("status"),
        F.when(missing & known, HEADER_NAME).otherwise(F.col("name")).alias("name"),
        F.when(missing & known, HEADER_TEXT).otherwise(F.col("description")).alias("description"),
        F.when(missing & known, header_columns(F.col(headers)))
        .otherwise(F.col("columns"))
        .alias("columns"),
    )


# --- schema documents ---------------------------------------------------------------------


def metadata_of(json: Column) -> Column:
    found = F.try_variant_get(member(json, "metadata"), "$", METADATA_DDL)
    return F.coalesce(found, F.create_map().cast(METADATA_DDL))


def document_column(item: Column, strict: bool) -> Column:
    """One column of a stored document; format and constraints are kept."""
    given = member(item, "name")
    if strict:
        given = F.coalesce(given, member(item, "column_name"))
    return F.struct(
        F.coalesce(text_or_null(given), F.lit("")).alias("name"),
        F.coalesce(text_or_null(member(item, "type")), F.lit("string")).alias("type"),
        F.coalesce(text_or_null(member(item, "description")), F.lit("")).alias("description"),
        F.coalesce(member(item, "nullable", "boolean"), F.lit(True)).alias("nullable"),
        F.coalesce(member(item, "confidence", "double"), F.lit(1.0)).alias("confidence"),
        F.coalesce(member(item, "inferred", "boolean"), F.lit(False)).alias("inferred"),
        F.coalesce(text_or_null(member(item, "format")), F.lit("")).alias("format"),
        filled_object(member(item, "constraints")).alias("constraints"),
        F.array().cast("array<string>").alias("sample_values"),
    ).cast(COLUMN_DDL)


def _load(docs: DataFrame, json: Column, items: Column, status: Column, strict: bool) -> DataFrame:
    keep = [c for c in docs.columns if c != "doc"]
    default = DEFAULT_NAME if strict else UNKNOWN_NAME
    ok = F.col("status") == "Success"
    staged = once(once(once(docs, json=json), items=items), status=status)
    loaded = F.col("json")
    columns = F.transform(F.col("items"), lambda c: document_column(c, strict))
    return once(
        staged,
        name=F.when(ok, F.coalesce(text_or_null(member(loaded, "name")), F.lit(default))),
        description=F.when(ok, F.coalesce(text_or_null(member(loaded, "description")), F.lit(""))),
        columns=F.when(ok, columns).cast(COLUMNS_DDL),
        metadata=F.when(ok, metadata_of(loaded)),
    ).select(*keep, "status", "name", "description", "columns", "metadata")


def load_strict(docs: DataFrame) -> DataFrame:
    """``(schema_id, doc)`` to schemas.  Fences and surrounding text are tolerated; a
    document without columns, or with a column lacking name or type, is an error row.  The
    older member names ``schema`` and ``column_name`` are read too."""

    def complete(item: Column) -> Column:
        name = F.coalesce(member(item, "name"), member(item, "column_name"))
        return F.coalesce(text_or_null(name) != "", F.lit(False)) & member(item, "type").isNotNull()

    items = F.coalesce(column_items(F.col("json")), F.array().cast("array<variant>"))
    status = (
        F.when(F.col("json").isNull(), "Error: Invalid JSON")
        .when(F.size("items") == 0, "Error: Invalid schema format")
        .when(~F.forall("items", complete), "Error: Invalid column format")
        .otherwise("Success")
    )
    return _load(docs, bind(read_json(F.col("doc"))["json"], object_only), items, status, True)


def load_lenient(docs: DataFrame) -> DataFrame:
    """Like ``load_strict`` for plain JSON, with defaults for everything that is missing."""
    items = F.coalesce(
        F.try_variant_get(member(F.col("json"), "columns"), "$", "array<variant>"),
        F.array().cast("array<variant>"),
    )
    status = F.when(F.col("json").isNull(), "Error: Invalid JSON").otherwise("Success")
    return _load(docs, bind(F.try_parse_json("doc"), object_only), items, status, False)
