"""Finding the JSON value inside a model's answer.

Fences are taken off in the JVM. Nearly all answers are then plain JSON and are decoded
there; only rows with another answer are sent to Python, which looks for the first value
that can be decoded.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from functools import reduce
from operator import or_

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from sheaf.fixed import EXOTIC_LINE_ENDS
from sheaf.functions.binding import let
from sheaf.functions.json_text import canonical, root_kind, strict_variant
from sheaf.functions.text import _col, byte_slice, strip

# first characters of JSON values
_VALUE_STARTS = '{["-0123456789tfn'
# line ends of which JSON takes any inside a string
_ENDS_IN_STRINGS = "\x85\u2028\u2029"

DECODED = "struct<kind:string,value:string>"
KINDS = {dict: "object", list: "array"}


def _told(value: object) -> tuple[str, str] | None:
    """Kind and compact text of a decoded value; null for one that is nested too deeply."""
    try:
        text = json.dumps(value, ensure_ascii=False, separators=(",", ":"))
    except RecursionError:
        return None
    # a lone surrogate has no UTF-8 form and would end the whole job; leave it escaped
    return KINDS.get(type(value), "scalar"), re.sub("[\ud800-\udfff]", lambda m: f"\\u{ord(m[0]):04X}", text)


def _values(text: str, inside: bool) -> Iterator[tuple[str, str] | None]:
    """The whole text as a value; then, with ``inside``, whatever starts at a bracket, in order."""
    decoder = json.JSONDecoder()
    places = (m.start() for m in re.finditer(r"[\[{]", text)) if inside else ()
    for decode in (lambda: json.loads(text), *((lambda p=p: decoder.raw_decode(text, p)[0]) for p in places)):
        try:
            yield _told(decode())
        except (ValueError, RecursionError):
            continue


def _first_value(text: str, inside: bool) -> tuple[str, str] | None:
    return next(_values(text, inside), None)


def decoded(text: Column) -> Column:
    """Struct of ``kind`` and ``value`` of a text that is one JSON value to Python's
    decoder, which also takes NaN and repeated keys; null for others and for null.
    """

    @F.pandas_udf(DECODED)
    def decode(texts: pd.Series) -> pd.DataFrame:
        found = [None if t is None else _first_value(t, inside=False) for t in texts]
        return pd.DataFrame([f or (None, None) for f in found], columns=["kind", "value"], dtype=object)

    return decode(text)


_FENCE = "```"


def _holds_any(text: Column, characters: str) -> Column:
    """Plain searches, one for each character: a class of a regular expression takes over twice as long."""
    return reduce(or_, [text.contains(c) for c in characters])


def _inside_fence(lines: Column) -> Column:
    """What stands between a first line and a last one that is a fence, of lines that end in line feeds."""

    def cut(p: Column) -> Column:
        rest = F.octet_length(p["lines"]) - F.octet_length(p["first"]) - 1
        closing = F.when(strip(p["last"]) == _FENCE, F.octet_length(p["last"]) + 1).otherwise(0)
        # of one line, which is first and last, nothing is left
        return strip(byte_slice(p["lines"], F.octet_length(p["first"]) + 2, F.greatest(rest - closing, F.lit(0))))

    # the lines are bound with their ends: Spark does not find a Python function whose argument has them from outside
    parts = {"lines": lines, "first": F.substring_index(lines, "\n", 1), "last": F.substring_index(lines, "\n", -1)}
    return let(F.struct(*[part.alias(name) for name, part in parts.items()]), cut)


def unfenced(text: Column | str) -> Column:
    """The stripped answer without its code fence, closed or left open.

    A fence is a first line that starts with three backticks; a last line of nothing but
    these closes it. Lines may end in any way that Python knows; inside a fence all ends
    become line feeds.
    """

    def inside(t: Column) -> Column:
        # nearly all answers have line feeds only
        plain = F.regexp_replace(t, f"\r\n|[\r{EXOTIC_LINE_ENDS}]", "\n")
        return let(F.when(_holds_any(t, f"\r{EXOTIC_LINE_ENDS}"), plain).otherwise(t), _inside_fence)

    return let(strip(_col(text)), lambda t: F.when(t.startswith(_FENCE), inside(t)).otherwise(t))


def _read_unfenced(text: Column | str, read: Callable[[Column], Column]) -> Column:
    """``read(unfenced(text))`` of a strict ``read`` that takes one JSON value and gives null for other texts.

    Inside a fence, line feeds are tried alone first. What is then one JSON value is the
    same with all line ends replaced, if its first line has no other end and it holds
    none of those that JSON allows in strings; between the parts of a value JSON allows
    only CR, as white space.
    """

    def fenced(t: Column) -> Column:
        first = let(F.substring_index(t, "\n", 1), lambda line: _holds_any(line, f"\r{EXOTIC_LINE_ENDS}"))
        tried = let(_inside_fence(t), lambda body: F.when(~_holds_any(body, _ENDS_IN_STRINGS), read(body)))
        return F.coalesce(F.when(~first, tried), let(unfenced(t), read))

    return let(strip(_col(text)), lambda t: F.when(t.startswith(_FENCE), fenced(t)).otherwise(read(t)))


def fast_json(text: Column | str) -> Column:
    """Struct of ``kind`` and ``value`` of an answer that is one valid JSON value, fenced
    or not; null for any other answer.

    The variant test turns away objects with repeated keys, whose last value must win.
    """

    def read(body: Column) -> Column:
        def judged(value: Column) -> Column:
            ok = value.isNotNull() & F.try_parse_json(body).isNotNull()
            return F.when(ok, F.struct(root_kind(body).alias("kind"), value.alias("value")))

        return let(canonical(body), judged)

    return _read_unfenced(text, read)


def fast_variant(text: Column | str) -> Column:
    """Struct of ``kind`` and ``value`` as :func:`fast_json`, the value as a variant: one parse, no text."""

    return _read_unfenced(text, _variant_of)


def _variant_of(body: Column) -> Column:
    """:func:`strict_variant` of a stripped text, with its kind."""
    # a stripped text that begins in words need not be parsed to be refused
    return let(
        F.when(byte_slice(body, 1, F.lit(1)).isin(*_VALUE_STARTS), strict_variant(body)),
        lambda v: F.when(v.isNotNull(), F.struct(root_kind(body).alias("kind"), v.alias("value"))),
    )


def trailing_variant(body: Column) -> Column:
    """:func:`fast_variant` of what starts at the first bracket of an unfenced text, where that is one JSON value to the end.

    It is what :func:`salvaged` finds, as a decoder starts there and then has nothing left:
    a text that is a value as a whole and holds a bracket further on is a string, which ends in a quote.
    """
    before = F.octet_length(F.substring_index(F.substring_index(body, "{", 1), "[", 1))
    rest = F.when(before < F.octet_length(body), byte_slice(body, before + 1, F.octet_length(body)))
    return let(rest, _variant_of)


def with_fast_json(df: DataFrame, text_col: str, kind: str, value: str) -> DataFrame:
    df = df.withColumn("_fast", fast_json(text_col))
    return df.withColumn(kind, F.col("_fast.kind")).withColumn(value, F.col("_fast.value")).drop("_fast")


def salvaged(body: Column) -> Column:
    """Struct of ``kind`` and ``value`` of the first JSON value in a text, sought by Python; null for null."""

    @F.pandas_udf(DECODED)
    def search(texts: pd.Series) -> pd.DataFrame:
        found = [None if t is None else _first_value(t, inside=True) for t in texts]
        return pd.DataFrame([f or (None, None) for f in found], columns=["kind", "value"], dtype=object)

    return search(body)


def with_json_value(
    df: DataFrame, text_col: str, kind: str = "json_kind", value: str = "json", variant: str | None = None
) -> DataFrame:
    """Add the JSON value found in an answer: its kind and its compact text.

    Both are null when no value can be decoded. A null answer gives null. One pass, and no
    write: Python is sent the refused answers, and nulls in place of all others.

    With ``variant`` the values that the JVM decodes go to a column of that name instead,
    parsed once and for good, and ``value`` is left to those that Python finds. Values that
    stand at the end of other words are then decoded in the JVM, too.
    """
    fast = fast_json(text_col)
    if variant:
        fast = let(fast_variant(text_col), lambda f: F.coalesce(f, let(unfenced(text_col), trailing_variant)))
    read = df.withColumn("_fast", fast)
    refused = F.col("_fast").isNull() & F.col(text_col).isNotNull()
    read = read.withColumn("_slow", salvaged(F.when(refused, unfenced(text_col))))
    told = {kind: F.coalesce("_fast.kind", "_slow.kind")}
    if variant:
        told |= {variant: F.col("_fast.value"), value: F.col("_slow.value")}
    else:
        told |= {value: F.coalesce("_fast.value", "_slow.value")}
    return read.withColumns(told).drop("_fast", "_slow")
