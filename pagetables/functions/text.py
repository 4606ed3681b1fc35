"""Text functions built from Spark's own expressions."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points Python's str.strip() removes.
WHITESPACE = "".join(
    map(
        chr,
        [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
         0x2028, 0x2029, 0x202F, 0x205F, 0x3000],
    )
)


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once.

    Inside a higher-order function a plain reference is evaluated again for every element
    it is used on; binding it to a lambda variable is Spark SQL's ``let``.  An aggregate over
    nothing hands its initial value to ``body`` as it is, where a ``transform`` would copy what
    ``body`` returns, a table with all its cells at every level of nesting.
    """
    nothing = F.array().cast("array<int>")
    return F.aggregate(nothing, value, lambda bound, _: bound, body)


def choose(test: Column, yes: Column | str | int, no: Column | str | int | None = None) -> Column:
    """SQL's ``if``: the same as ``when`` with one branch, and cheaper inside an array, where a CASE
    is not compiled and walks the list of its branches."""
    return F.call_function("if", test, *[v if isinstance(v, Column) else F.lit(v) for v in (yes, no)])


def strip(col: Column) -> Column:
    """Remove leading and trailing Unicode whitespace (``trim`` removes spaces only)."""
    return F.btrim(col, F.lit(WHITESPACE))


def is_blank(col: Column) -> Column:
    return F.coalesce(strip(col), F.lit("")) == ""


def contains_any(col: Column, words: list[str]) -> Column:
    """True where any of the words is a substring."""
    return reduce(or_, [col.contains(word) for word in words])


def basename(path: Column) -> Column:
    return F.regexp_extract(path, r"[^/]*$", 0)


def dataset_id(url: Column) -> Column:
    """``owner/name`` from a dataset address; NULL when it has fewer than two parts."""
    parts = F.split(F.rtrim(strip(url), F.lit("/")), "/")
    return bind(
        parts,
        lambda p: F.when(
            F.size(p) >= 2, F.concat_ws("/", F.element_at(p, -2), F.element_at(p, -1))
        ),
    )


def preview(items: Column, limit: int, sep: str = ", ") -> Column:
    """The first ``limit`` items joined, with an ellipsis when there are more."""
    return F.concat(
        F.array_join(F.slice(items, 1, limit), sep),
        F.when(F.size(items) > limit, F.lit("...")).otherwise(F.lit("")),
    )


def json_text(col: Column) -> Column:
    """A string as a quoted JSON scalar (``to_json`` only takes containers); NULL stays NULL."""
    return F.when(col.isNotNull(), F.regexp_extract(F.to_json(F.array(col)), r"(?s)^\[(.*)\]$", 1))
