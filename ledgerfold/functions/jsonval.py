"""Canonical JSON text: the value form the ledger stores, compares and groups on."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EMPTY_JSON = ("null", '""', "[]", "{}")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it several times in ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def once(rows: DataFrame, value: Column, where: Column) -> DataFrame:
    """``rows`` that meet ``where``, with the fields of the struct ``value``, which is evaluated once per row.

    A filter on a plain column goes below the projection that makes it, and below a repartition too, and there writes out
    all that the column is made of; it stays above a generator.
    """
    return rows.select("*", F.inline(F.when(where, F.array(value))))


def canonical(text: Column) -> Column:
    """Sorted-key compact JSON of JSON text; NULL when the text is not JSON."""
    return F.to_json(F.try_parse_json(text))


def is_empty(value: Column) -> Column:
    """Null, empty string, empty list and empty object are empty; 0 and false are not."""
    return value.isNull() | value.isin(*EMPTY_JSON)


def text_of(value: Column) -> Column:
    """The string inside a JSON scalar; nested values keep their JSON form."""
    return F.try_variant_get(F.try_parse_json(value), "$", "string")


def get_text(doc: Column, path: str) -> Column:
    return F.try_variant_get(doc, path, "string")


def get_doc(doc: Column, path: str) -> Column:
    return F.try_variant_get(doc, path, "variant")


def get_list(doc: Column, path: str) -> Column:
    """A JSON array as an array of variants; anything else as an empty array."""
    return F.coalesce(
        F.try_variant_get(doc, path, "array<variant>"), F.array().cast("array<variant>")
    )


def get_strings(doc: Column, path: str) -> Column:
    return F.coalesce(F.try_variant_get(doc, path, "array<string>"), F.array().cast("array<string>"))


def json_type(doc: Column) -> Column:
    """``OBJECT``, ``ARRAY``, ``STRING``, ``BOOLEAN``, ``BIGINT``, ``VOID`` ..."""
    return F.regexp_extract(F.schema_of_variant(doc), r"^([A-Z]+)", 1)


def quote(text: Column) -> Column:
    """A string column as a JSON string literal; NULL stays NULL.

    The array brackets are trimmed off; a literal starts and ends with a quote, so
    nothing else is. The text is evaluated once.
    """
    return F.nullif(F.btrim(F.to_json(F.array(text)), F.lit("[]")), F.lit("null"))


def json_object(entries: list[tuple[str, Column]]) -> Column:
    """Canonical JSON object from ``(key, JSON-text column)``; NULL values are left out."""
    parts = [F.concat(F.lit(f'"{key}":'), value) for key, value in sorted(entries)]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def json_array(items: Column) -> Column:
    """JSON array text from an array of JSON texts."""
    return F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))
