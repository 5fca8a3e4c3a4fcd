"""Expressions over raw JSON payloads. They look at the text, not at an inferred schema."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# JSON values that count as false (fixed values).
FALSY_JSON = ["null", "false", "0", "0.0", '""', "[]", "{}"]


def elements(raw: Column) -> Column:
    """A payload is one object or a list of objects: the objects as an array of JSON texts."""
    text = F.trim(raw)
    return F.when(text.startswith("["), F.from_json(text, "array<string>")).otherwise(F.array(text))


def falsy_json(raw: Column, field: str) -> Column:
    """True if `field` is present with a false value; a missing field is not falsy."""
    value = F.to_json(F.variant_get(F.try_parse_json(raw), f"$.{field}", "variant"))
    return F.coalesce(value.isin(FALSY_JSON), F.lit(False))


def is_only_detail(keys: Column) -> Column:
    """An error answer is an object with the single key `detail`."""
    return (F.size(keys) == 1) & (F.element_at(keys, 1) == "detail")


def payload_status(raw: Column) -> Column:
    """`ok`, `error` (detail answer), `empty` or `corrupt`.

    The cheap text tests come first, so a good payload is parsed once.
    """
    text = F.trim(F.coalesce(raw, F.lit("")))
    keys = F.json_object_keys(F.try_element_at(elements(text), F.lit(1)))
    return (
        F.when(text.isin("", "null") | F.regexp_like(text, F.lit(r"^(\[\s*\]|\{\s*\})$")), "empty")
        .when(text.contains('"detail"') & F.coalesce(is_only_detail(keys), F.lit(False)), "error")
        .when(keys.isNull(), "corrupt")
        .otherwise("ok")
    )
