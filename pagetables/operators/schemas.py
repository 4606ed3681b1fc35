"""Schemas as data: building, metadata, patches, versions, and their written form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagetables.functions.rows import once
from pagetables.functions.shared import kept, new_path
from pagetables.functions.text import basename, bind, json_text
from pagetables.operators.infer import COLUMN_DDL, TYPE_ALIASES, described
from pagetables.operators.parse import (
    COLUMNS_DDL,
    METADATA_DDL,
    NULL_NAME,
    NULL_TEXT,
)

# Column fields that feedback may change, and how their new values are read.
PATCH_FIELDS = ["name", "type", "description", "nullable", "format", "constraints"]


def metadata_map(**members: Column) -> Column:
    """A metadata map without the members that are NULL."""
    entries = F.array(
        *[F.struct(F.lit(name).alias("key"), value.cast("variant").alias("value"), value.isNotNull().alias("given"))
          for name, value in members.items()]
    )
    kept = F.transform(F.filter(entries, lambda e: e["given"]), lambda e: F.struct(e["key"], e["value"]))
    return F.map_from_entries(kept).cast(METADATA_DDL)


def table_metadata(table: Column) -> dict[str, Column]:
    """Metadata members every schema of a table gets."""
    return {
        "table_caption": F.nullif(table["caption"], F.lit("")),
        "column_count": F.size(table["headers"]),
        "sample_rows_count": F.size(F.slice(table["rows"], 1, 5)),
        "has_sample_data": F.size(table["rows"]) > 0,
    }


def source_metadata(kind: Column, source: Column, table_index: Column) -> dict[str, Column]:
    """Metadata members by kind of source: an address, a file, or a file of a dataset."""
    return {
        "source_type": F.when(kind == "dataset", "kaggle"),
        "source_url": F.when(kind.isin("url", "dataset"), source),
        "source_file": F.when(kind == "file", basename(source)),
        "csv_file": F.when(kind == "dataset", basename(source)),
        "table_index": F.when(kind != "dataset", table_index),
    }


def attach_metadata(schemas: DataFrame, **members: Column) -> DataFrame:
    """Add members to ``metadata``; NULL members are left out, present ones replaced."""
    added = metadata_map(**members)
    if "metadata" not in schemas.columns:
        return schemas.withColumn("metadata", added)
    old = F.coalesce("metadata", F.create_map().cast(METADATA_DDL))
    merged = bind(
        added,
        lambda new: F.map_concat(
            F.map_filter(old, lambda k, _: ~F.map_contains_key(new, k)), new
        ),
    )
    return schemas.withColumn("metadata", merged)


def sql_type(declared: Column) -> Column:
    """A declared database type as one of the logical types, unknown ones kept."""
    base = F.lower(F.regexp_extract(declared, r"^\s*([A-Za-z]+)", 1))
    pairs = [
        F.lit(x)
        for name, words in TYPE_ALIASES.items()
        for word in words.split()
        for x in (word, name)
    ]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), base), declared)


def described_column(d: Column) -> dict[str, Column]:
    """What a definition says about its column: the null flag gives ``nullable``, key and
    reference the two keys, and a declared length or precision is kept in ``format``."""
    flag = F.lower(F.coalesce(d["null"], F.lit("")))
    return {
        "name": d["name"],
        "type": F.coalesce(sql_type(F.nullif(d["type"], F.lit(""))), F.lit("string")),
        "description": F.coalesce(F.nullif(d["desc"], F.lit("")), described(d["name"])),
        "nullable": ~flag.isin("no", "n", "not null", "false", "0"),
        "format": F.when(F.contains(d["type"], F.lit("(")), F.lower(d["type"])).otherwise(""),
        "primary_key": F.coalesce(F.lower(d["key"]).rlike(r"\bpk\b|primary"), F.lit(False)),
        "foreign_key": F.nullif(d["ref"], F.lit("")),
    }


DEFINITION_FIELDS = ("name", "type", "key", "null", "ref", "desc")


def definitions_to_schema(definitions: DataFrame) -> DataFrame:
    """Described columns (``csvschema.definitions``) to flat schema columns."""
    keep = [c for c in definitions.columns if c not in (*DEFINITION_FIELDS, "def_no")]
    fields = described_column({name: F.col(name) for name in DEFINITION_FIELDS})
    return definitions.select(
        *keep, F.col("def_no").alias("pos"), *[c.alias(name) for name, c in fields.items()]
    )


def definition_columns(definitions: Column) -> Column:
    """An array of definitions to an array of columns; keys become constraints."""

    def one(d: Column) -> Column:
        fields = described_column(d)
        keys = F.struct(
            F.when(fields["primary_key"], True).alias("primary_key"),
            fields["foreign_key"].alias("foreign_key"),
        )
        has_key = fields["primary_key"] | fields["foreign_key"].isNotNull()
        return F.struct(
            *[fields[name].alias(name) for name in ("name", "type", "description", "nullable")],
            F.lit(1.0).alias("confidence"),
            F.lit(False).alias("inferred"),
            fields["format"].alias("format"),
            F.when(has_key, F.parse_json(F.to_json(keys))).alias("constraints"),
            F.array().cast("array<string>").alias("sample_values"),
        ).cast(COLUMN_DDL)

    return F.transform(definitions, one)


# --- versions -----------------------------------------------------------------------------


def _with_rename_before(rows: DataFrame, name: str, renames: DataFrame) -> DataFrame:
    """Rows with ``(up_round, up_name)``: the last rename to their ``name`` in an earlier round.

    An as-of join by one sort of both sides.  Rounds are cut at the log's percentiles, so a
    schema or a name of much of the log is sorted by many tasks; what the earlier parts end
    with is carried over by a window of one row a part.
    """
    points = rows.agg(F.percentile_approx("round", [i / 100 for i in range(1, 100)], 1000).alias("points"))
    event = F.struct(F.col("round").alias("round"), F.col("old").alias("name"))
    kind = event_type(renames, event)
    asks = rows.select(
        "schema_id", F.col(name).alias("_key"), "round", F.lit(0).alias("_kind"), F.lit(None).cast(kind).alias("_event"),
        F.struct(*rows.columns).alias("_row"),
    )
    events = renames.select(
        "schema_id", F.col("to").alias("_key"), "round", F.lit(1).alias("_kind"), event.alias("_event"),
        F.lit(None).cast(asks.schema["_row"].dataType).alias("_row"),
    )
    both = asks.unionByName(events).withColumn("_points", points.scalar()).withColumn(
        "_part", F.coalesce(F.size(F.filter("_points", lambda p: p < F.col("round"))), F.lit(0))
    ).drop("_points")
    # A round's own renames come after what it asks; of one round's, the largest name is last.
    inside = Window.partitionBy("schema_id", "_key", "_part").orderBy("round", "_kind", "_event").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    here = both.withColumn("_here", F.last("_event", ignorenulls=True).over(inside)).filter("_kind = 0")
    ends = events.withColumn("_points", points.scalar()).groupBy(
        "schema_id", "_key", F.coalesce(F.size(F.filter("_points", lambda p: p < F.col("round"))), F.lit(0)).alias("_part")
    ).agg(F.max("_event").alias("_end"))
    keys = here.select("schema_id", "_key", "_part").distinct().join(ends, ["schema_id", "_key", "_part"], "full")
    ahead = Window.partitionBy("schema_id", "_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = keys.withColumn("_before", F.max("_end").over(ahead)).filter(F.col("_before").isNotNull()).drop("_end")
    found = F.coalesce("_here", "_before")
    return here.join(carried, ["schema_id", "_key", "_part"], "left").select(
        "_row.*", found["round"].alias("up_round"), found["name"].alias("up_name")
    )


def event_type(renames: DataFrame, event: Column):
    return renames.select(event.alias("e")).schema["e"].dataType


def original_names(rounds: DataFrame, renames: DataFrame) -> DataFrame:
    """``rounds`` with ``column_name`` as it was before all renames of earlier rounds.

    Every row points at the rename before it, and every rename at the one before that; the
    renames' pointers are doubled until each points at the first of its chain.  A rename is a
    row throughout, so it doesn't matter how many a schema has; chains of n take log2 n rounds.
    """
    spark = rounds.sparkSession
    nodes = _with_rename_before(renames, "old", renames).withColumn("moved", F.col("up_round").isNotNull())
    nodes = kept(nodes, new_path(spark, "renames"))
    while not nodes.filter("moved").isEmpty():
        ups = nodes.filter("up_round is not null").select(
            F.col("schema_id").alias("_s"), F.col("round").alias("_r"), F.col("old").alias("_o"),
            F.col("up_round").alias("_round"), F.col("up_name").alias("_name"),
        )
        same = (F.col("schema_id") == F.col("_s")) & (F.col("up_round") == F.col("_r")) & (F.col("up_name") == F.col("_o"))
        further = nodes.filter("up_round is not null").join(ups, same, "left").select(
            "schema_id", "round", "old", "to", F.coalesce("_round", "up_round").alias("up_round"),
            F.coalesce("_name", "up_name").alias("up_name"), F.col("_round").isNotNull().alias("moved"),
        )
        first = nodes.filter("up_round is null").select(*further.columns)
        nodes = kept(further.unionByName(first), new_path(spark, "renames"))
    first_name = nodes.select(
        F.col("schema_id").alias("_s"), F.col("round").alias("_r"), F.col("old").alias("_o"),
        F.coalesce("up_name", "old").alias("_first"),
    )
    same = (F.col("schema_id") == F.col("_s")) & (F.col("up_round") == F.col("_r")) & (F.col("up_name") == F.col("_o"))
    linked = _with_rename_before(rounds, "column_name", renames)
    pointing = linked.filter("up_round is not null").join(first_name, same, "left")
    plain = linked.filter("up_round is null").select(*rounds.columns)
    return pointing.withColumn("column_name", F.coalesce("_first", "column_name")).select(*rounds.columns).unionByName(plain)


def fold_patches(patches: DataFrame) -> DataFrame:
    """The last value per schema, column and field over all feedback rounds, one row per
    schema and column, by the name the column had at first.

    NULL values say nothing.  A round works on the result of the one before, so a patch may
    use the name an earlier round gave.  The log is reduced to one row per schema, round and
    column in each task before anything else, and written once; only where it holds renames
    are names followed back.
    """
    given = F.col("value").isNotNull()
    rounds = patches.groupBy("schema_id", "round", "column_name").agg(
        # A collected set makes Spark hash the groups; maxima of texts alone would sort them.
        F.size(F.collect_set("field")).alias("n_fields"),
        *[F.max(F.when((F.col("field") == f) & given, F.col("value"))).alias(f) for f in PATCH_FIELDS],
    )
    rounds = kept(rounds, new_path(patches.sparkSession, "rounds"))
    renames = rounds.filter(F.col("name").isNotNull() & (F.col("name") != F.col("column_name"))).select(
        "schema_id", "round", F.col("column_name").alias("old"), F.col("name").alias("to")
    )
    named = rounds if renames.isEmpty() else original_names(rounds, renames)
    last = [
        F.max(F.when(F.col(f).isNotNull(), F.struct("round", f)))[f].alias(f) for f in PATCH_FIELDS
    ]
    return named.groupBy("schema_id", "column_name").agg(*last)


def patch_column(column: Column, patch: Column) -> Column:
    """A column struct with the non-NULL fields of a patch."""
    return F.struct(
        F.coalesce(patch["name"], column["name"]).alias("name"),
        F.coalesce(patch["type"], column["type"]).alias("type"),
        F.coalesce(patch["description"], column["description"]).alias("description"),
        F.coalesce(patch["nullable"].try_cast("boolean"), column["nullable"]).alias("nullable"),
        column["confidence"].alias("confidence"),
        column["inferred"].alias("inferred"),
        F.coalesce(patch["format"], column["format"]).alias("format"),
        F.coalesce(F.try_parse_json(patch["constraints"]), column["constraints"]).alias("constraints"),
        column["sample_values"].alias("sample_values"),
    )


def apply_patches(schemas: DataFrame, patches: DataFrame) -> DataFrame:
    """Schemas with their folded patches and a new version; schemas without an applicable
    patch are returned as they are.

    Patches of columns a schema does not have are dropped before they are gathered, so a
    schema gathers at most one patch per column of its own.
    """
    known = schemas.select("schema_id", F.explode("columns.name").alias("column_name"))
    applicable = fold_patches(patches).join(known, ["schema_id", "column_name"], "left_semi")
    gathered = applicable.groupBy("schema_id").agg(
        F.map_from_entries(
            F.collect_list(F.struct("column_name", F.struct(*PATCH_FIELDS).alias("patch")))
        ).alias("patches")
    )
    by_name = F.col("patches")
    patched = F.transform(
        "columns",
        lambda c: F.coalesce(
            bind(
                F.try_element_at(by_name, c["name"]),
                lambda p: F.when(p.isNotNull(), patch_column(c, p)),
            ),
            c,
        ),
    )
    joined = schemas.join(gathered, "schema_id", "left")
    columns = F.when(by_name.isNull(), F.col("columns")).otherwise(patched.cast(COLUMNS_DDL))
    stamped = stamp_version(once(joined, columns=columns), by_name.isNotNull())
    return stamped.select(*schemas.columns)


def stamp_version(schemas: DataFrame, where: Column | None = None) -> DataFrame:
    """Mark a refinement in the metadata: a flag, and a counter that starts at 1.  Rows
    outside ``where`` stay as they are."""
    refined = F.lit(True) if where is None else where
    count = F.try_variant_get(
        F.try_element_at("metadata", F.lit("refinement_version")), "$", "int"
    )
    stamped = attach_metadata(
        schemas,
        feedback_incorporated=F.when(refined, True),
        refinement_version=F.when(refined, F.coalesce(count, F.lit(0)) + 1),
    )
    if "version" in schemas.columns:
        stamped = stamped.withColumn("version", F.col("version") + refined.cast("int"))
    return stamped


def refine(originals: DataFrame, refined: DataFrame) -> DataFrame:
    """Model revisions (``load_strict`` of the answers) in place of the originals.

    The original's metadata is carried and stamped; where the answer could not be loaded
    the original stays, unchanged.
    """
    answer = refined.filter(F.col("status") == "Success").select(
        "schema_id",
        F.struct("name", "description", "columns").alias("revision"),
    )
    taken = F.col("revision").isNotNull()
    joined = stamp_version(originals.join(answer, "schema_id", "left"), taken)
    revised = {
        field: F.when(taken, F.col(f"revision.{field}")).otherwise(F.col(field))
        for field in ("name", "description", "columns")
    }
    return joined.withColumns(revised).select(*originals.columns)


# --- views --------------------------------------------------------------------------------


def schema_columns(schemas: DataFrame, key: str = "schema_id") -> DataFrame:
    """Flat ``(schema_id, pos, name, type, …)``."""
    return schemas.select(key, F.posexplode("columns").alias("pos", "c")).select(key, "pos", "c.*")


def column_counts(schemas: DataFrame, key: str = "schema_id") -> DataFrame:
    return schemas.select(key, F.coalesce(F.size("columns"), F.lit(0)).alias("columns"))


def review_view(schemas: DataFrame, key: str = "schema_id") -> DataFrame:
    return schema_columns(schemas, key).select(
        key,
        "pos",
        F.col("name").alias("Name"),
        F.col("type").alias("Type"),
        F.col("description").alias("Description"),
        F.when(F.col("nullable"), "Yes").otherwise("No").alias("Nullable"),
    )


def fill_missing_schemas(keys: DataFrame, schemas: DataFrame) -> DataFrame:
    """Every key with its schema, or with a placeholder that says it was missing."""
    found = schemas.withColumn("_found", F.lit(True))
    joined = keys.select("schema_id").join(found, "schema_id", "left")
    missing = F.col("_found").isNull()
    return (
        joined.withColumn("name", F.when(missing, NULL_NAME).otherwise(F.col("name")))
        .withColumn("description", F.when(missing, NULL_TEXT).otherwise(F.col("description")))
        .withColumn(
            "columns",
            F.when(missing, F.array().cast(COLUMNS_DDL)).otherwise(F.col("columns")),
        )
        .withColumn(
            "metadata",
            F.when(missing, F.create_map().cast(METADATA_DDL)).otherwise(F.col("metadata")),
        )
        .select(*schemas.columns)
    )


# --- written form -------------------------------------------------------------------------


def sparse_column(c: Column) -> Column:
    """The written members of a column; those at their defaults are NULL and left out."""
    return F.struct(
        c["name"].alias("name"),
        c["type"].alias("type"),
        c["description"].alias("description"),
        c["nullable"].alias("nullable"),
        F.when(c["confidence"] < 1, c["confidence"]).alias("confidence"),
        F.when(c["inferred"], True).alias("inferred"),
        F.nullif(c["format"], F.lit("")).alias("format"),
        c["constraints"].alias("constraints"),
    )


def to_json_docs(schemas: DataFrame, key: str = "schema_id") -> DataFrame:
    """``(schema_id, doc)``: each schema as indented JSON."""
    document = F.struct(
        "name",
        "description",
        F.transform("columns", sparse_column).alias("columns"),
        F.when(F.size("metadata") > 0, F.col("metadata")).alias("metadata"),
    )
    return schemas.select(key, F.to_json(document, {"pretty": "true"}).alias("doc"))


def yaml_json(text: Column) -> Column:
    """JSON text as YAML: the characters YAML does not print, or folds, become escapes."""
    special = r"\x7f-\x9f\u2028\u2029\ufeff\ufffe\uffff"

    def escaped(text: Column) -> Column:
        pieces = F.regexp_extract_all(text, F.lit(f"[{special}]|[^{special}]+"), F.lit(0))
        return F.array_join(
            F.transform(
                pieces,
                lambda p: F.when(
                    p.rlike(f"^[{special}]"),
                    F.concat(F.lit("\\u"), F.lpad(F.lower(F.hex(F.ascii(p))), 4, "0")),
                ).otherwise(p),
            ),
            "",
        )

    return bind(text, lambda t: F.when(t.rlike(f"[{special}]"), escaped(t)).otherwise(t))


def yaml_scalar(col: Column) -> Column:
    """A string as a double-quoted YAML scalar."""
    return yaml_json(json_text(col))


def to_yaml_docs(schemas: DataFrame, key: str = "schema_id") -> DataFrame:
    """``(schema_id, doc)``: each schema as YAML; strings are always quoted."""

    def member(name: str, value: Column) -> Column:
        """``name: value``; NULL, and so left out, without a value."""
        return F.concat(F.lit(f"{name}: "), value)

    def lines(indent: str, *members: Column) -> Column:
        return F.array_join(F.array_compact(F.array(*members)), "\n" + indent)

    def column(c: Column) -> Column:
        sparse = sparse_column(c)
        members = lines(
            "  ",
            member("name", yaml_scalar(c["name"])),
            member("type", yaml_scalar(c["type"])),
            member("description", yaml_scalar(c["description"])),
            member("nullable", c["nullable"].cast("string")),
            member("confidence", sparse["confidence"].cast("string")),
            member("inferred", sparse["inferred"].cast("string")),
            member("format", yaml_scalar(sparse["format"])),
            member("constraints", yaml_json(F.to_json(sparse["constraints"]))),
        )
        return F.concat(F.lit("- "), F.coalesce(F.nullif(members, F.lit("")), F.lit("{}")), F.lit("\n"))

    columns = F.when(
        F.size("columns") > 0,
        F.concat(F.lit("columns:\n"), F.array_join(F.transform("columns", column), "")),
    ).otherwise("columns: []\n")
    entries = F.transform(
        F.map_entries("metadata"),
        lambda e: F.concat(
            F.lit("  "), yaml_scalar(e["key"]), F.lit(": "),
            yaml_json(F.to_json(e["value"])),
            F.lit("\n"),
        ),
    )
    metadata = F.when(
        F.size("metadata") > 0, F.concat(F.lit("metadata:\n"), F.array_join(entries, ""))
    ).otherwise("")
    return schemas.select(
        key,
        F.concat(
            F.coalesce(F.concat(member("name", yaml_scalar(F.col("name"))), F.lit("\n")), F.lit("")),
            F.coalesce(F.concat(member("description", yaml_scalar(F.col("description"))), F.lit("\n")), F.lit("")),
            F.coalesce(columns, F.lit("")),
            F.coalesce(metadata, F.lit("")),
        ).alias("doc"),
    )

