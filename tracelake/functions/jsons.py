"""JSON column helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tracelake.functions.text import col


def string_array(c: Column | str) -> Column:
    """JSON array of strings; null when the text is not one."""
    return F.from_json(col(c), "array<string>")


def has_tag(c: Column | str, tag: str) -> Column:
    """Exact membership in a JSON array held as text; null counts as an empty array."""
    return F.coalesce(F.array_contains(string_array(F.coalesce(col(c), F.lit("[]"))), F.lit(tag)), F.lit(False))


def object_variant(c: Column | str) -> Column:
    """VARIANT of a JSON object; null for null, broken or non-object text."""
    v = F.try_parse_json(col(c))
    return F.when(F.startswith(F.schema_of_variant(v), F.lit("OBJECT")), v)


def text_at(v: Column | str, path: str) -> Column:
    return F.try_variant_get(col(v), path, "string")


def kind_at(v: Column | str, path: str) -> Column:
    """Type name of the value at path ('VOID' for a JSON null); null when absent."""
    return F.schema_of_variant(F.try_variant_get(col(v), path, "variant"))


def is_object(v: Column | str, path: str) -> Column:
    return F.coalesce(F.startswith(kind_at(v, path), F.lit("OBJECT")), F.lit(False))


def is_array(v: Column | str, path: str) -> Column:
    return F.coalesce(F.startswith(kind_at(v, path), F.lit("ARRAY")), F.lit(False))


def spaced(json: Column) -> Column:
    """JSON text with a space after each comma and colon between tokens; strings stay as they are."""
    return F.regexp_replace(json, r'((?:"(?:[^"\\]++|\\.)*+"|[^",:])++)([,:])', "$1$2 ")


def quoted(c: Column | str) -> Column:
    """A JSON string literal for the value; the word null for a null."""
    body = F.to_json(F.struct(col(c).alias("v")))
    return F.when(col(c).isNull(), F.lit("null")).otherwise(F.regexp_extract(body, r"(?s)^.{5}(.*).$", 1))


def list_text(items: Column) -> Column:
    """Array of strings as JSON text with a space after each comma."""
    return F.concat(F.lit("["), F.array_join(F.transform(items, quoted), ", "), F.lit("]"))
