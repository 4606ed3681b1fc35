"""Canonical JSON with numbers of any length, and nested values against a tool's fields.

DataFrame functions only.  A variant holds numbers of up to 38 digits and doubles, so before the
text is parsed each number in it becomes a string: a mark, then its canonical spelling, made of
its digits.  The mark is U+E000 before a digit or a minus; wherever a text holds U+E000 itself,
U+E001 is put after it, so nothing is taken for a mark.  ``plain`` takes both off again.

A number's spelling follows from its value alone: no zeros that say nothing, no plus, no minus on
zero; plain digits where the point falls within 21 digits before or 6 zeros behind it, else one
digit, the rest behind a point, and a signed exponent.

Defined cases: what isn't JSON is NULL, and so is a number whose exponent has over 15 digits;
repeated members, as the variant type has it, aren't JSON.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagetables.functions.text import bind

MARK, GUARD = "\ue000", "\ue001"
NUMBER = r"^(-?)([0-9]+)(?:\.([0-9]+))?(?:[eE]\+?(-?)0*([0-9]{0,15}))?$"
PLAIN_DIGITS, LEADING_ZEROS = 21, 6
MOST_DEPTH = 16


def spelled(number: Column) -> Column:
    """The canonical spelling of a text that ``NUMBER`` fits."""

    def part(i: int) -> Column:
        return F.regexp_extract(number, NUMBER, i)

    digits = F.ltrim(F.concat(part(2), part(3)), F.lit("0"))
    exponent = F.concat(part(4), F.coalesce(F.nullif(part(5), F.lit("")), F.lit("0"))).cast("long")
    # The value is 0.d times ten to the p.
    facts = F.struct(
        part(1).alias("sign"),
        F.rtrim(digits, F.lit("0")).alias("d"),
        (F.length(digits) + exponent - F.length(part(3))).alias("p"),
    )

    def written(v: Column) -> Column:
        d, p = v["d"], v["p"]
        n = F.length(d)
        near = F.least(F.greatest(p, F.lit(-LEADING_ZEROS)), F.lit(PLAIN_DIGITS)).cast("int")
        far = p - 1
        text = (
            F.when((p <= PLAIN_DIGITS) & (p >= n), F.rpad(d, near, "0"))
            .when((p <= PLAIN_DIGITS) & (p > 0), F.concat(F.left(d, near), F.lit("."), F.substring(d, near + 1, n)))
            .when((p <= 0) & (p > -LEADING_ZEROS), F.concat(F.lit("0."), F.repeat(F.lit("0"), -near), d))
            .otherwise(F.concat(
                F.left(d, F.lit(1)), F.when(n > 1, F.concat(F.lit("."), F.substring(d, F.lit(2), n))).otherwise(""),
                F.when(far < 0, "e").otherwise("e+"), far.cast("string"),
            ))
        )
        return F.when(n == 0, "0").otherwise(F.concat(v["sign"], text))

    return bind(facts, written)


def guarded(text: Column) -> Column:
    """A text in which no mark is found."""
    return F.replace(text, F.lit(MARK), F.lit(MARK + GUARD))


def marked(json: Column) -> Column:
    """Canonical JSON whose numbers are marked strings; NULL if the text isn't JSON."""

    def structure(segment: Column) -> Column:
        def token(t: Column) -> Column:
            number = F.concat(F.lit(f'"{MARK}'), spelled(t), F.lit('"'))
            return F.when(t.rlike(NUMBER), number).when(t.rlike("^[-0-9]"), F.lit("?")).otherwise(t)

        return F.array_join(F.transform(F.regexp_extract_all(segment, F.lit(r"[\w.+-]+|[^\w.+-]+"), F.lit(0)), token), "")

    # Without escaped quotes and backslashes every second piece between quotes is a string.
    bare = F.replace(F.replace(json, F.lit("\\\\"), F.lit("\\u005c")), F.lit('\\"'), F.lit("\\u0022"))
    segments = F.split(bare, '"', -1)
    told = F.transform(
        segments,
        lambda s, i: F.when(i % 2 == 0, structure(s)).otherwise(guarded(F.regexp_replace(s, r"\\u[eE]000", MARK))),
    )
    # The text itself decides whether it is JSON: a number can't be a member's name.
    return F.when(F.try_parse_json(json).isNotNull(), F.to_json(F.try_parse_json(F.array_join(told, '"'))))


def plain(json: Column) -> Column:
    """Marked JSON without its marks."""
    bare = F.regexp_replace(json, f'"{MARK}(-?[0-9][-+.e0-9]*)"', "$1")
    return F.replace(bare, F.lit(MARK + GUARD), F.lit(MARK))


def canonical(json: Column) -> Column:
    """Canonical JSON: members sorted, no white space, one spelling of each number."""
    return plain(marked(json))


# --- values against fields ----------------------------------------------------------------


def unguarded(text: Column) -> Column:
    return F.replace(text, F.lit(MARK + GUARD), F.lit(MARK))


def joined(path: Column, name: Column) -> Column:
    return F.when(path == "", name).otherwise(F.concat(path, F.lit("/"), name))


def escaped(name: Column) -> Column:
    """A member's name as a part of a path."""
    for sign, code in (("~", "~0"), ("/", "~1"), ("*", "~2")):
        name = F.replace(name, F.lit(sign), F.lit(code))
    return name


def is_whole(number: Column) -> Column:
    """Whether a canonical number is an integer."""
    behind = F.length(F.regexp_extract(number, r"\.([0-9]+)", 1))
    power = F.coalesce(F.nullif(F.regexp_extract(number, r"e\+([0-9]+)$", 1), F.lit("")), F.lit("0")).cast("long")
    return ~number.contains("e-") & (behind <= power)


def node(path: Column, at: Column, value: Column) -> Column:
    """A marked variant as ``(path, at, kind, text, json)``: the path of its field, its own place,
    its JSON type, the text of a scalar, and the JSON of a container."""

    def read(v: Column) -> Column:
        kind, text = F.schema_of_variant(v), F.try_variant_get(v, "$", "string")
        number = (kind == "STRING") & text.startswith(MARK) & ~text.startswith(MARK + GUARD)
        spelling = F.substring(text, 2, 2**31 - 1)
        container = kind.startswith("ARRAY") | kind.startswith("OBJECT")
        json_type = (
            F.when(v.isNull() | (kind == "VOID"), "null")
            .when(number, F.when(is_whole(spelling), "integer").otherwise("number"))
            .when(kind == "STRING", "string")
            .when(kind == "BOOLEAN", "boolean")
            .when(kind.startswith("ARRAY"), "array")
            .otherwise("object")
        )
        return F.struct(
            path.alias("path"), at.alias("at"), json_type.alias("kind"),
            F.when(number, spelling).otherwise(unguarded(text)).alias("text"),
            F.when(container, F.to_json(v)).alias("json"),
        )

    return bind(value, read)


def children(of: Column, parents: Column) -> Column:
    """The members or items of a node, if fields are declared below it."""
    declared = F.array_contains(parents, of["path"])
    members = F.transform(
        F.map_entries(F.from_json(of["json"], "map<string,variant>")),
        lambda e: bind(escaped(unguarded(e["key"])), lambda n: node(joined(of["path"], n), joined(of["at"], n), e["value"])),
    )
    items = F.transform(
        F.from_json(of["json"], "array<variant>"),
        lambda v, i: node(joined(of["path"], F.lit("*")), joined(of["at"], i.cast("string")), v),
    )
    found = F.when(declared & (of["kind"] == "object"), members).when(declared & (of["kind"] == "array"), items)
    return F.coalesce(found, F.slice(F.array(of), 1, 0))


def nodes_below(root: Column, parents: Column) -> Column:
    """All nodes below one that fields are declared for, level by level."""
    none = F.slice(F.array(root), 1, 0)
    start = F.struct(F.array(root).alias("open"), none.alias("done"))

    def level(state: Column, _: Column) -> Column:
        kids = F.flatten(F.transform(state["open"], lambda n: children(n, parents)))
        return bind(kids, lambda k: F.struct(k.alias("open"), F.concat(state["done"], k).alias("done")))

    return F.reduce(F.sequence(F.lit(1), F.lit(MOST_DEPTH)), start, level, lambda state: state["done"])


def breaches(arguments: Column, fields: Column) -> Column:
    """What is wrong with marked arguments, as sorted texts."""
    names = F.transform(fields, lambda f: f["name"])
    parents = F.array_distinct(F.concat(F.array(F.lit("")), F.transform(names, parent_of)))
    # A field below an undeclared one declares what is above it.
    above = F.reduce(
        F.sequence(F.lit(1), F.lit(MOST_DEPTH)), parents,
        lambda found, _: F.array_distinct(F.concat(found, F.transform(found, parent_of))),
    )

    def with_nodes(parents: Column, root: Column, nodes: Column) -> Column:
        def of_field(field: Column) -> Column:
            def check(n: Column) -> Column:
                number = F.when(n["kind"].isin("integer", "number"), n["text"].try_cast("double"))
                right = (n["kind"] == field["type"]) | ((field["type"] == "number") & (n["kind"] == "integer"))

                def said(what: str) -> Column:
                    return F.concat(n["at"], F.lit(f": {what}"))

                return (
                    F.when(~right, F.concat(n["at"], F.lit(": "), n["kind"], F.lit(" instead of "), field["type"]))
                    .when(number < field["least"], said("too small"))
                    .when(number > field["most"], said("too large"))
                    .when((n["kind"] == "string") & (F.length(n["text"]) > field["most_length"]), said("too long"))
                    .when(field["choices"].isNotNull() & ~F.array_contains(field["choices"], n["text"]), said("not a choice"))
                )

            own = F.filter(nodes, lambda n: n["path"] == field["name"])
            leaf = F.regexp_extract(field["name"], "[^/]*$", 0)
            holders = F.filter(
                F.concat(F.array(root), nodes), lambda n: (n["path"] == parent_of(field["name"])) & (n["kind"] == "object")
            )
            places = F.transform(own, lambda n: n["at"])
            wanted = F.transform(holders, lambda n: joined(n["at"], leaf))
            missing = F.transform(F.array_except(wanted, places), lambda at: F.concat(at, F.lit(": missing")))
            needed = F.coalesce(field["required"], F.lit(False)) & (leaf != "*")
            return F.concat(F.transform(own, check), F.when(needed, missing).otherwise(F.slice(places, 1, 0)))

        known = F.concat(names, parents)
        extra = F.transform(
            F.filter(nodes, lambda n: ~F.array_contains(known, n["path"])), lambda n: F.concat(n["at"], F.lit(": not a field"))
        )
        return F.array_sort(F.array_compact(F.concat(F.flatten(F.transform(fields, of_field)), extra)))

    root = node(F.lit(""), F.lit(""), F.try_parse_json(arguments))
    return bind(above, lambda p: bind(root, lambda r: bind(nodes_below(r, p), lambda ns: with_nodes(p, r, ns))))


def parent_of(name: Column) -> Column:
    return F.regexp_replace(name, "/?[^/]*$", "")
