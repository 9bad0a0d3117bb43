"""Reading model responses: text, usage, wrapped samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sheaf.fixed import ENVELOPE_KEYS
from sheaf.functions.binding import let
from sheaf.functions.json_text import is_object_variant, is_string_variant, object_keys
from sheaf.functions.text import _col, strip

_BODY = "struct<status:string,output_text:variant,output:array<variant>,error:variant,incomplete_details:variant>"
_CUT_SHORT = "the answer was cut short: "
_USAGE = (
    "struct<usage:struct<input_tokens:bigint,output_tokens:bigint,"
    "input_tokens_details:struct<cached_tokens:bigint>>>"
)


def _text(v: Column) -> Column:
    return F.when(is_string_variant(v), strip(F.try_variant_get(v, "$", "string")))


def _message_text(b: Column) -> Column:
    """First filled text part of the messages among the output items."""
    no_variants = F.expr("cast(array() as array<variant>)")

    def content(item: Column) -> Column:
        return F.coalesce(F.try_variant_get(item, "$.content", "array<variant>"), no_variants)

    def part_text(part: Column) -> Column:
        of_kind = F.try_variant_get(part, "$.type", "string") == "output_text"
        return F.when(of_kind, let(F.try_variant_get(part, "$.text", "variant"), _text))

    messages = F.filter(
        F.coalesce(b["output"], no_variants), lambda i: F.try_variant_get(i, "$.type", "string") == "message"
    )
    texts = F.transform(F.flatten(F.transform(messages, content)), part_text)
    return F.get(F.filter(texts, lambda t: t.isNotNull() & (t != "")), F.lit(0))


def response_text(body: Column | str, error: Column | str) -> Column:
    """Struct of ``text`` and ``text_error``; an ``error`` of the transport is passed on."""
    body, error = _col(body), _col(error)

    def judged(b: Column) -> Column:
        direct = _text(b["output_text"])
        error_json = F.coalesce(F.to_json(b["error"]), F.lit("null"))
        details = F.coalesce(F.to_json(b["incomplete_details"]), F.lit("null"))
        said_error = ~error_json.isin("null", "false", "0", '""', "[]", "{}")
        payload_error = F.concat(F.lit("the model reported an error: "), error_json)
        keys = F.array_join(F.array_sort(object_keys(body)), ", ")

        def fault(found: Column) -> Column:
            return (
                F.when(error.isNotNull(), error)
                .when(b["status"] == "failed", payload_error)
                .when(
                    b["status"] == "incomplete",
                    F.concat(F.lit(_CUT_SHORT), details),
                )
                .when(found.isNotNull(), None)
                .when(said_error, payload_error)
                .otherwise(
                    F.concat(F.lit("no text in the answer (members: "), keys, F.lit(")."))
                )
            )

        def outcome(found: Column) -> Column:
            return let(
                fault(found), lambda f: F.struct(F.when(f.isNull(), found).alias("text"), f.alias("text_error"))
            )

        return let(F.coalesce(F.when(direct != "", direct), _message_text(b)), outcome)

    def plain(b: Column) -> Column:
        """Outcome of the usual bodies: cut short, or with a message first that begins with text; null for others."""

        def told(path: str, kind: str = "string") -> Column:
            return F.try_variant_get(b, path, kind)

        def outcome(text: Column, fault: Column) -> Column:
            return F.struct(text.alias("text"), fault.alias("text_error"))

        none = F.lit(None).cast("string")
        details = F.coalesce(F.to_json(told("$.incomplete_details", "variant")), F.lit("null"))
        first = (told("$.output[0].type") == "message") & (told("$.output[0].content[0].type") == "output_text")
        text = F.when(
            first & told("$.output_text", "variant").isNull(), let(told("$.output[0].content[0].text", "variant"), _text)
        )
        return let(
            F.coalesce(told("$.status"), F.lit("")),
            lambda status: F.when(status == "incomplete", outcome(none, F.concat(F.lit(_CUT_SHORT), details))).when(
                status != "failed", let(text, lambda t: F.when(t != "", outcome(t, none)))
            ),
        )

    # one parse and a few looks at it; only other bodies are taken apart
    usual = F.when(error.isNull(), let(F.try_parse_json(body), plain))
    return F.coalesce(usual, let(F.from_json(body, _BODY), judged))


def with_response_text(responses: DataFrame) -> DataFrame:
    """Add ``text`` and ``text_error`` from ``body`` and ``error``."""
    df = responses.withColumn("_r", response_text("body", "error"))
    return df.withColumns({n: F.col(f"_r.{n}") for n in ("text", "text_error")}).drop("_r")


def with_usage(responses: DataFrame) -> DataFrame:
    """Add ``regular_input_tokens``, ``cached_input_tokens`` and ``output_tokens``.

    Values that are not whole numbers count as 0.
    """
    df = responses.withColumn("_u", F.from_json("body", _USAGE).getField("usage"))
    zero = F.lit(0).cast("bigint")
    given = F.coalesce(F.col("_u.input_tokens"), zero)
    cached = F.least(F.coalesce(F.col("_u.input_tokens_details.cached_tokens"), zero), given)
    return (
        df.withColumn("regular_input_tokens", given - cached)
        .withColumn("cached_input_tokens", cached)
        .withColumn("output_tokens", F.coalesce(F.col("_u.output_tokens"), zero))
        .drop("_u")
    )


def total_usage(responses: DataFrame) -> DataFrame:
    """Token totals over all accepted payloads, failed ones and repeated passes included."""
    totals = ["regular_input_tokens", "cached_input_tokens", "output_tokens"]
    accepted = responses.filter(F.col("error").isNull())
    return with_usage(accepted).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in totals]
    )


def _chosen(kind: Column | str, text: Column, item_type: str, itself: Column) -> Column:
    """Items of a decoded answer: those of the array, of the first envelope that is a list, or the object itself."""
    members = "struct<" + ",".join(f"{k}:array<{item_type}>" for k in ENVELOPE_KEYS) + ">"
    inside = let(
        F.from_json(text, members),
        lambda m: F.coalesce(*[m[k] for k in ENVELOPE_KEYS], F.array(itself)),
    )
    return F.when(_col(kind) == "array", F.from_json(text, f"array<{item_type}>")).when(_col(kind) == "object", inside)


def object_items(kind: Column | str, value: Column | str) -> Column:
    """Texts of the object items of a decoded answer; null when the root is neither list nor object.

    An array counts as it is; an object gives its list under the first envelope key that
    holds one, else itself. Items that are not objects are dropped, not counted.
    """
    def both(text: Column) -> Column:
        # the same items twice: once for their text, once for their type
        return F.struct(
            _chosen(kind, text, "string", text).alias("texts"),
            _chosen(kind, text, "variant", F.try_parse_json(text)).alias("types"),
        )

    def objects(p: Column) -> Column:
        kept = F.transform(p["texts"], lambda t, i: F.when(is_object_variant(F.get(p["types"], i)), t))
        return F.filter(kept, lambda t: t.isNotNull())

    return let(let(_col(value), both), objects)


def object_variants(kind: Column | str, value: Column | str, variant: Column | str) -> Column:
    """:func:`object_items` as variants, of ``variant`` or, where that is null, of the text ``value``."""

    def members(v: Column) -> Column:
        inside = [F.try_variant_get(v, f"$.{k}", "array<variant>") for k in ENVELOPE_KEYS]
        return F.when(_col(kind) == "array", F.try_variant_get(v, "$", "array<variant>")).when(
            _col(kind) == "object", F.coalesce(*inside, F.array(v))
        )

    parsed = let(_col(value), lambda text: _chosen(kind, text, "variant", F.try_parse_json(text)))
    return F.filter(F.when(_col(variant).isNotNull(), let(_col(variant), members)).otherwise(parsed), is_object_variant)


def with_items(
    answers: DataFrame, kind: str = "json_kind", value: str = "json", variant: str | None = None
) -> DataFrame:
    """Add ``items`` (texts of the object items) and ``items_error``.

    With ``variant``, a column of values that are variants already, the items are variants;
    ``value`` then gives those of the other rows.
    """
    wrong_root = F.when(
        F.col(kind) == "scalar", "the samples are not an array"
    ).when(F.col(kind).isNull(), "no JSON value in the answer")
    items = object_variants(kind, value, variant) if variant else object_items(kind, value)
    return answers.withColumn("items", items).withColumn("items_error", wrong_root)
