"""Helpers over VARIANT values that keep *missing*, *null* and *wrong kind* apart.

A missing key is SQL NULL, a JSON null is a VARIANT holding null. Casting to a
struct of VARIANT fields reads one level of an object and gives NULL for
anything that is not an object, without walking the nested values.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, with the value computed once per row.

    Inside a lambda an outer expression is computed again for every element; a
    lambda variable is not.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def object_of(value: Column, *keys: str, path: str = "$") -> Column:
    """The named keys of a JSON object as VARIANT fields; NULL if not an object."""
    fields = ",".join(f"`{key}`: variant" for key in keys)
    return F.try_variant_get(value, path, f"struct<{fields}>")


def is_object(value: Column) -> Column:
    return object_of(value, "_").isNotNull()


def is_wrong_object(value: Column) -> Column:
    """True for a value that is present but is not an object (JSON null included)."""
    return value.isNotNull() & ~is_object(value)


def text_of(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def kind(value: Column) -> Column:
    """``STRING``, ``BIGINT``, ``OBJECT``, ``VOID`` ...; NULL if missing."""
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)


def is_plain(value: Column, sql_type: str) -> Column:
    """Whether a value is of just this kind: a test that takes a fraction of reading the value,
    for which Spark builds a cast each time. False if missing."""
    return F.coalesce(F.schema_of_variant(value) == sql_type, F.lit(False))


def truthy(value: Column) -> Column:
    """False for missing, null, false, zero, empty text, empty array and empty object."""
    text = text_of(value)
    # Only text that may stand for one of them needs a look at the kind.
    doubtful = text.rlike(r"^(|false|\[\]|\{\}|-?0[.0]*(E.*)?)$")
    return F.when(text.isNull(), F.lit(False)).when(~doubtful, F.lit(True)).otherwise(
        (kind(value) == "STRING") & (text != "")
    )


def default_if_missing(value: Column, default: Any, sql_type: str) -> Column:
    """Typed value; ``default`` only if the key is missing, NULL for a JSON null."""
    return F.when(value.isNull(), F.lit(default)).otherwise(typed(value, sql_type))


def typed(value: Column, sql_type: str) -> Column:
    """Value as the column type of a target table; NULL if it does not load."""
    if sql_type == "boolean":
        text = F.lower(text_of(value))
        plain = F.when(is_plain(value, "BOOLEAN"), F.try_variant_get(value, "$", "boolean"))
        return plain.when(text.isin(*TRUE_TEXT), F.lit(True)).when(
            text.isin(*FALSE_TEXT), F.lit(False)
        )
    return F.try_variant_get(value, "$", sql_type)


def loads_as(value: Column, sql_type: str) -> Column:
    """Whether a value can be loaded into a column of ``sql_type``.

    Missing and null always load. Numbers must be whole, however they are spelled, and fit 64 bits, text
    columns take any scalar, boolean columns take the usual spellings.
    """
    if sql_type == "bigint":
        spelled = text_of(value).rlike(r"^[+-]?[0-9]+(\.0+)?$")
        number = F.try_variant_get(value, "$", "double")
        whole = kind(value).isin("DOUBLE", "FLOAT", "DECIMAL") & (number == F.floor(number))
        in_range = F.try_variant_get(value, "$", "bigint").isNotNull()
        fits = is_plain(value, "BIGINT") | F.coalesce((spelled | whole) & in_range, F.lit(False))
    elif sql_type == "boolean":
        spelled = F.coalesce(F.lower(text_of(value)).isin(*TRUE_TEXT, *FALSE_TEXT), F.lit(False))
        fits = is_plain(value, "BOOLEAN") | spelled
    else:
        # the beginning of the kind: a pattern over it takes longer than reading it
        fits = ~F.substring(F.schema_of_variant(value), 1, 5).isin("OBJEC", "ARRAY")
    return value.isNull() | fits | F.is_variant_null(value)


# Spellings a boolean column accepts.
TRUE_TEXT = ("true", "t", "yes", "y", "1")
FALSE_TEXT = ("false", "f", "no", "n", "0")
