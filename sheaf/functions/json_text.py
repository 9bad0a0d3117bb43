"""Expressions over JSON text: strict validity, canonical form, member types.

Spark's lenient readers accept text after a value. Wrapping the text in brackets and
asking for exactly one array item makes the same parser strict.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

from sheaf.functions.binding import let
from sheaf.functions.text import _col, byte_slice

STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
JSON_BLANKS = " \t\n\r"


def root_kind(text: Column | str) -> Column:
    """'object', 'array' or 'scalar', judged by the first character. No validation."""
    text = _col(text)
    # nearly all texts begin with their value; taking a first character counts all of them
    first = F.substring(F.ltrim(text, F.lit(JSON_BLANKS)), 1, 1)
    return (
        F.when(text.startswith("{"), "object").when(text.startswith("["), "array")
        .when(first == "{", "object").when(first == "[", "array").otherwise("scalar")
    )


def canonical(text: Column | str) -> Column:
    """Compact text of one valid JSON value, null when the text is anything else.

    Key order, nulls and long integers are kept and escapes are decoded. The text of
    a string value comes back without its quotes, so test ``root_kind`` as well.
    """
    wrapped = F.from_json(F.concat(F.lit("["), _col(text), F.lit("]")), "array<string>", STRICT)
    # a valid null root is an item without text
    return let(wrapped, lambda w: F.when(F.size(w) == 1, F.coalesce(F.get(w, 0), F.lit("null"))))


def canonical_object(text: Column | str) -> Column:
    """Canonical text when the value is an object, else null."""
    return let(_col(text), lambda t: F.when(root_kind(t) == "object", canonical(t)))


def string_members(text: Column | str, names: Iterable[str]) -> Column:
    """Struct of the named members; a member that is absent or not a string is null."""
    names = list(names)
    schema = "struct<" + ",".join(f"`{n}`:variant" for n in names) + ">"
    return let(
        F.from_json(_col(text), schema),
        lambda p: F.struct(*[_string_of(p.getField(n)).alias(n) for n in names]),
    )


def variant_members(value: Column | str, names: Iterable[str]) -> Column:
    """:func:`string_members` of an object that is a variant already."""
    v = _col(value)

    def member(name: str) -> Column:
        return let(F.try_variant_get(v, f"$.{name}", "variant"), _string_of)

    return F.struct(*[member(n).alias(n) for n in names])


def _string_of(v: Column) -> Column:
    return F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string"))


def strict_variant(text: Column | str) -> Column:
    """Variant of one valid JSON value without repeated members, null when the text is anything else."""
    wrapped = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), _col(text), F.lit("]"))), "$", "array<variant>")
    return let(wrapped, lambda w: F.when(F.size(w) == 1, F.get(w, 0)))


def is_object_variant(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))


def is_string_variant(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v) == "STRING", F.lit(False))


def object_keys(text: Column | str) -> Column:
    """Top-level keys in order, also of objects holding NaN, which the plain function refuses."""
    lenient = F.map_keys(F.from_json(_col(text), "map<string,string>"))
    return F.coalesce(F.json_object_keys(_col(text)), lenient)


def quoted(text: Column | str) -> Column:
    """JSON string literal of a text."""
    return let(F.to_json(F.array(_col(text))), lambda q: byte_slice(q, 2, F.octet_length(q) - 2))


def escaped(text: Column | str) -> Column:
    """A text as it stands inside a JSON string; the escaped parts of a text make up its escaped whole."""
    inside = let(F.to_json(F.array(_col(text))), lambda q: byte_slice(q, 3, F.octet_length(q) - 4))
    return F.when(_col(text).isNotNull(), inside)


def patched_object(text: Column | str, changes: Column | str) -> Column:
    """Overwrite string members of a canonical object, keeping key order.

    ``changes`` is map<string,string>. Keys that the object lacks are appended.
    """
    text = _col(text)
    nothing = F.expr("cast(array() as array<string>)")
    parts = F.struct(
        F.coalesce(object_keys(text), nothing).alias("keys"),
        F.from_json(text, "map<string,string>").alias("texts"),
        F.from_json(text, "map<string,variant>").alias("kinds"),
        _col(changes).alias("changes"),
    )

    def rebuilt(p: Column) -> Column:
        def value(k: Column) -> Column:
            new, old = F.element_at(p["changes"], k), F.element_at(p["texts"], k)
            return (
                F.when(new.isNotNull(), quoted(new))
                .when(is_string_variant(F.element_at(p["kinds"], k)), quoted(old))
                .otherwise(F.coalesce(old, F.lit("null")))
            )

        every = F.array_union(p["keys"], F.coalesce(F.map_keys(p["changes"]), nothing))
        pairs = F.transform(every, lambda k: F.concat(quoted(k), F.lit(":"), value(k)))
        return F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}"))

    return let(parts, rebuilt)
