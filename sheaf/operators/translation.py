"""Translating text members of JSON records in size-bounded batches."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from sheaf.fixed import BATCH_CHARS, BATCH_RECORDS, LANGUAGES, TRANSLATE_FIELDS, TRANSLATION_TEXT
from sheaf.functions.binding import let
from sheaf.functions.json_text import is_object_variant, is_string_variant, patched_object, string_members
from sheaf.functions.text import is_filled
from sheaf.operators.batching import CHUNK_ROWS, assign_batches
from sheaf.operators.requests import user_message


def payloads(records: DataFrame, members: Column | None = None) -> DataFrame:
    """(``id``, ``payload``, ``names``, ``chars``) for records with ``id``.

    ``members`` is a struct of nullable strings; by default it is read from the JSON in
    ``record``. Filled members are kept as they are, unstripped. A record without any
    still becomes a payload. ``chars`` measures the payload with spaced separators.
    """
    if members is None:
        members = string_members("record", TRANSLATE_FIELDS)
    df = records.withColumn("_m", members)
    present = [f for f in TRANSLATE_FIELDS if f in df.schema["_m"].dataType.names]
    kept = F.struct(*[F.when(is_filled(f"_m.{f}"), F.col(f"_m.{f}")).alias(f) for f in present])
    df = df.withColumn("_f", kept)
    names = F.array_compact(F.array(*[F.when(F.col(f"_f.{f}").isNotNull(), F.lit(f)) for f in present]))
    df = df.select(
        "id",
        F.to_json(F.struct("id", F.col("_f").alias("fields"))).alias("payload"),
        names.alias("names"),
    )
    # compact text plus the blanks after 2 colons and 1 comma outside, 2n-1 inside
    blanks = F.lit(3) + F.greatest(2 * F.size("names") - 1, F.lit(0))
    return df.withColumn("chars", (F.length("payload") + blanks).cast("bigint"))


def batch_payloads(
    payload_rows: DataFrame,
    batch_size: int = BATCH_RECORDS,
    max_chars: int = BATCH_CHARS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Batches in record order: ``batch_no``, ``source_json`` and the ``expected`` members.

    A group is one batch, bounded by ``batch_size`` records.
    """
    numbers = assign_batches(payload_rows.select("id", "chars"), batch_size, max_chars, chunk_rows)
    grouped = (
        payload_rows.join(numbers, "id")
        .groupBy("batch_no")
        .agg(F.array_sort(F.collect_list(F.struct("id", "payload", "names"))).alias("_items"))
    )
    return grouped.select(
        "batch_no",
        F.concat(F.lit("["), F.array_join("_items.payload", ","), F.lit("]")).alias("source_json"),
        F.transform("_items", lambda i: F.struct(i["id"].alias("id"), i["names"].alias("names"))).alias("expected"),
    )


def translation_text(language: str, source_json: Column | str) -> Column:
    source_json = F.col(source_json) if isinstance(source_json, str) else source_json
    head, tail = TRANSLATION_TEXT.split("%s")
    return F.concat(F.lit(head + LANGUAGES[language] + tail), source_json)


def translation_requests(batches: DataFrame, language: str) -> DataFrame:
    request_id = F.sha2(
        F.concat_ws("\x1f", F.lit("translate"), F.lit(language), F.col("batch_no").cast("string"), "source_json"), 256
    )
    return batches.select(
        request_id.alias("request_id"),
        "batch_no", "expected",
        user_message(translation_text(language, "source_json")).alias("input"),
        F.lit("none").alias("reasoning_effort"),
        F.lit(None).cast("int").alias("max_output_tokens"),
    )


def check_batches(answers: DataFrame, kind: str = "json_kind", value: str = "json") -> DataFrame:
    """Compare what came back with what was sent; add ``fault`` and ``translated``.

    ``answers`` carries ``expected`` and the decoded answer. The answer must be an array
    of objects, each with the whole-number id of a record of the batch and exactly the
    members sent, all strings; every record must occur. One fault fails the batch. A
    repeated id counts with its last item. The comparison stays inside the row, whose
    arrays are as long as a batch, so nothing is shuffled.
    """
    items = F.from_json(value, "array<variant>")

    def read(item: Column) -> Column:
        whole = F.try_variant_get(item, "$.id", "variant")
        is_whole = F.schema_of_variant(whole).isin("BIGINT", "BOOLEAN")
        return F.struct(
            is_object_variant(item).alias("is_object"),
            F.when(is_whole, F.try_variant_get(whole, "$", "bigint")).alias("id"),
            F.try_variant_get(item, "$.fields", "map<string,variant>").alias("fields"),
        )

    told = F.when(F.col(kind) == "array", F.transform(items, read))
    sent = F.col("expected")

    def names_of(item_id: Column) -> Column:
        return F.get(F.filter(sent, lambda e: e["id"] == item_id), F.lit(0))["names"]

    def fault_of(item: Column) -> Column:
        return let(names_of(item["id"]), lambda names: named_fault(item, names))

    def named_fault(item: Column, names: Column) -> Column:
        keys = F.map_keys(item["fields"])
        same = (F.size(F.array_except(keys, names)) == 0) & (F.size(F.array_except(names, keys)) == 0)
        texts = F.forall(F.map_values(item["fields"]), is_string_variant)
        shown = item["id"].cast("string")
        return (
            F.when(~item["is_object"] | item["id"].isNull(), "an item has no usable id")
            .when(
                names.isNull() | item["fields"].isNull(),
                F.concat(F.lit("an id that was not asked for: "), shown),
            )
            .when(~(same & texts), F.concat(F.lit("other members than were sent for id "), shown, F.lit(".")))
        )

    def fault(got: Column) -> Column:
        first = F.get(F.filter(F.transform(got, fault_of), lambda f: f.isNotNull()), F.lit(0))
        missing = F.array_except(sent["id"], F.transform(got, lambda i: i["id"]))
        return (
            F.when(F.col(kind).isNull(), "no JSON value in the translation")
            .when(got.isNull(), "the translation is not an array")
            .otherwise(
                F.coalesce(first, F.when(F.size(missing) > 0, "records are missing from the translation"))
            )
        )

    def last_of(got: Column, record: Column) -> Column:
        found = F.element_at(F.filter(got, lambda i: i["id"] == record["id"]), -1)
        texts = F.transform_values(found["fields"], lambda _, v: F.try_variant_get(v, "$", "string"))
        return F.struct(record["id"].alias("id"), texts.alias("fields"))

    def outcome(got: Column) -> Column:
        good = F.transform(sent, lambda record: last_of(got, record))
        return let(fault(got), lambda f: F.struct(f.alias("fault"), F.when(f.isNull(), good).alias("translated")))

    df = answers.withColumn("_o", let(told, outcome))
    return df.withColumns({n: F.col(f"_o.{n}") for n in ("fault", "translated")}).drop("_o")


def translated_rows(checked: DataFrame) -> DataFrame:
    """(``id``, ``fields``) of the records in good batches."""
    good = checked.filter(F.col("fault").isNull())
    return good.select(F.explode("translated").alias("_t")).select("_t.id", "_t.fields")


def apply_translations(records: DataFrame, translated: DataFrame) -> DataFrame:
    """Records with their translated members; records without a translation are left out."""

    @F.pandas_udf("string")
    def patched(texts: pd.Series, changes: pd.Series) -> pd.Series:
        import json

        def one(text: str | None, change: str | None) -> str | None:
            if text is None:
                return None
            return json.dumps(json.loads(text) | json.loads(change), ensure_ascii=False, separators=(",", ":"))

        return pd.Series([one(t, c) for t, c in zip(texts, changes, strict=True)], dtype=object)

    # Spark has no NaN and Infinity in JSON: records with such a value are patched in Python.
    # Texts may hold these letters; only a parser tells, and it is asked for those alone.
    letters = F.col("record").contains("NaN") | F.col("record").contains("Infinity")
    joined = records.join(translated, "id").withColumn("_odd", letters & F.try_parse_json("record").isNull())
    odd = F.col("_odd")
    # Python is sent nothing but nulls for the others
    in_python = patched(F.when(odd, F.col("record")), F.when(odd, F.to_json("fields")))
    record = F.when(odd, F.col("_python")).otherwise(patched_object("record", "fields"))
    return joined.withColumn("_python", in_python).withColumn("record", record).drop("_odd", "_python", "fields")


def translation_report(checked: DataFrame) -> DataFrame:
    n = F.size("expected")
    failed = F.col("fault").isNotNull()
    zero = F.lit(0)
    return checked.agg(
        F.coalesce(F.sum(n), zero).cast("bigint").alias("records"),
        F.count(F.lit(1)).alias("batches"),
        F.count_if(failed).alias("failed_batches"),
        F.coalesce(F.sum(F.when(~failed, n)), zero).cast("bigint").alias("translated"),
        F.coalesce(F.sum(F.when(failed, n)), zero).cast("bigint").alias("untranslated"),
    )
