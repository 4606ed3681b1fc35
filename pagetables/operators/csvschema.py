"""CSV rows to documents, including CSV texts that describe a database schema.

A describing text has one line per column of some database table.  Its roles (which field
is the name, the type, the key …) are found from the header, and each line is unpivoted
into named properties.  All of it is array work inside the document's row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetables.functions.rows import once
from pagetables.functions.text import basename, bind, contains_any, is_blank, strip
from pagetables.operators.extract import TABLES_TYPE, with_status

# Header terms, type words, and role words with their default positions.
SCHEMA_TERMS = ["key", "name", "data type", "null", "attributes", "references", "description"]
TYPE_WORDS = ["int", "varchar", "char", "text", "date", "time", "float", "decimal"]
ROLES = {
    "name": ["name"],
    "type": ["type", "data"],
    "key": ["key"],
    "null": ["null"],
    "ref": ["ref"],
    "desc": ["desc"],
}
PROPERTY_NAMES = {
    "name": "Column Name",
    "type": "Data Type",
    "key": "Key",
    "null": "Nullable",
    "ref": "References",
    "desc": "Description",
}


def _first(rows: Column) -> Column:
    return F.get(rows, F.lit(0))


def _data(rows: Column) -> Column:
    return F.slice(rows, 2, F.size(rows))


def describes_schema(rows: Column) -> Column:
    """``header``, ``content`` or NULL: what shows that the text describes a schema."""
    by_header = F.exists(_first(rows), lambda h: contains_any(F.lower(h), SCHEMA_TERMS))
    by_content = F.exists(
        F.get(rows, F.lit(1)), lambda c: contains_any(F.lower(c), TYPE_WORDS)
    )
    return F.when(by_header, "header").when(by_content, "content")


def roles(headers: Column) -> Column:
    """Position of each role: the first header with one of its words, else the default."""

    def first_with(words: list[str]) -> Column:
        hit = F.array_position(
            F.transform(headers, lambda h: contains_any(F.lower(h), words)), True
        )
        return F.when(hit > 0, (hit - 1).cast("int"))

    defaults = {
        "name": F.when(F.size(headers) > 3, 3).otherwise(0),
        "type": F.when(F.size(headers) > 4, 4).otherwise(1),
    }
    return F.struct(
        *[
            F.coalesce(first_with(words), defaults.get(role, F.lit(None).cast("int"))).alias(role)
            for role, words in ROLES.items()
        ]
    )


def no_usable_roles(rows: Column, role: Column) -> Column:
    """Name and type both at the first field: such lines cannot be measured."""
    return (role["name"] == 0) & (role["type"] == 0) & F.exists(
        _data(rows), lambda r: F.size(r) > 0
    )


def definition_rows(rows: Column, role: Column) -> Column:
    """Lines long enough for name and type and with a name, as structs by role."""
    reach = F.greatest(role["name"], role["type"])

    def by_role(line: Column) -> Column:
        return F.struct(*[strip(F.get(line, role[r])).alias(r) for r in ROLES])

    usable = F.filter(
        _data(rows),
        lambda r: (F.size(r) > reach) & ~is_blank(F.get(r, role["name"])),
    )
    return F.transform(usable, by_role)


def _property(name: Column, value: Column) -> Column:
    return F.struct(name.alias("name"), value.alias("value"))


def defined_properties(definitions: Column) -> Column:
    """Properties of all definitions in order; blank ones are left out, but a blank null
    flag means ``Yes``."""

    def one(d: Column) -> Column:
        def value(role: str) -> Column:
            filled = F.when(d[role] != "", d[role])
            return F.when(d[role] == "", "Yes").otherwise(filled) if role == "null" else filled

        pairs = F.array(*[_property(F.lit(PROPERTY_NAMES[r]), value(r)) for r in ROLES])
        return F.filter(pairs, lambda p: p["value"].isNotNull())

    return F.flatten(F.transform(definitions, one))


def other_properties(rows: Column, role: Column) -> Column:
    """Filled cells outside the roles, under their header; lines without a name count too."""
    headers = _first(rows)

    def one(line: Column) -> Column:
        cells = F.transform(
            line,
            lambda c, i: F.struct(
                F.get(headers, i).alias("name"),
                strip(c).alias("value"),
                F.coalesce(F.array_contains(F.array(*[role[r] for r in ROLES]), i), F.lit(False))
                .alias("has_role"),
            ),
        )
        free = F.filter(cells, lambda c: ~c["has_role"] & (c["value"] != "") & ~is_blank(c["name"]))
        return F.transform(free, lambda c: _property(c["name"], c["value"]))

    return F.flatten(F.transform(_data(rows), one))


def csv_record(rows: Column, source: Column, sample: int) -> Column:
    """The one table of a CSV text as a struct of type ``TABLE_TYPE``."""
    headers = _first(rows)
    first_rows = F.slice(rows, 2, sample)

    def record(caption: Column, row_count: Column, properties: Column) -> Column:
        return F.struct(
            F.lit(0).alias("table_id"),
            F.lit("csv").alias("kind"),
            caption.alias("caption"),
            F.size(headers).alias("column_count"),
            row_count.alias("row_count"),
            headers.alias("headers"),
            first_rows.alias("rows"),
            F.lit(False).alias("is_vertical"),
            properties.alias("properties"),
        )

    no_properties = F.lit(None).cast(TABLES_TYPE.elementType["properties"].dataType)
    plain = record(basename(source), F.size(first_rows), no_properties)

    def described(role: Column) -> Column:
        properties = F.concat(
            defined_properties(definition_rows(rows, role)), other_properties(rows, role)
        )
        return F.when(no_usable_roles(rows, role), plain).otherwise(
            record(F.lit("Database Schema"), F.size(rows) - 1, properties)
        )

    return F.when(describes_schema(rows).isNull(), plain).otherwise(bind(roles(headers), described))


def csv_tables(files: DataFrame, sample: int = 5) -> DataFrame:
    """``parse_csv`` output to documents, one table each."""
    table = csv_record(F.col("rows"), F.col("source"), sample)
    readable = F.col("status").isNull() & F.col("rows").isNotNull()
    tables = F.when(readable, F.array(table)).cast(TABLES_TYPE)
    return with_status(once(files, tables=tables).drop("rows"))


def detect_schema_csv(files: DataFrame) -> DataFrame:
    keep = [c for c in files.columns if c not in ("status", "rows")]
    reason = describes_schema(F.col("rows"))
    return files.select(*keep, reason.alias("reason")).withColumn(
        "is_schema", F.col("reason").isNotNull()
    )


def resolve_roles(files: DataFrame) -> DataFrame:
    keep = [c for c in files.columns if c not in ("status", "rows")]
    role = roles(_first(F.col("rows")))
    return files.select(*keep, role.alias("r")).select(
        *keep, *[F.col(f"r.{r}").alias(f"{r}_idx") for r in ROLES]
    )


def definitions(files: DataFrame) -> DataFrame:
    """``(…, def_no, name, type, key, null, ref, desc)``: one row per described column."""
    keep = [c for c in files.columns if c not in ("status", "rows")]
    rows = F.col("rows")
    found = bind(roles(_first(rows)), lambda role: definition_rows(rows, role))
    return (
        files.filter(describes_schema(rows).isNotNull())
        .select(*keep, F.posexplode(found).alias("def_no", "d"))
        .select(*keep, "def_no", "d.*")
    )


def properties_of(tables: DataFrame, key: str = "doc_id") -> DataFrame:
    """Long form ``(doc_id, table_id, prop_no, name, value)``."""
    return tables.select(key, "table_id", F.posexplode("properties").alias("prop_no", "p")).select(
        key, "table_id", "prop_no", "p.name", "p.value"
    )
