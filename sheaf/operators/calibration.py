"""Calibration set for quantisation: filter, seeded draw, chat messages."""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, functions as F

from sheaf.fixed import CALIBRATION_SAMPLES, CALIBRATION_SEED
from sheaf.functions.binding import let, with_kept
from sheaf.functions.text import strip

_FIELDS = ("instruction", "input", "output")
# Numbers that are drawn on the driver; calibration sets have some hundred members.
MAX_DRAWS = 1_000_000
MAX_BROADCAST_DRAWS = 1_000_000


def calibration_records(records: DataFrame, record: str = "record") -> DataFrame:
    """Add the stripped ``instruction``, ``input`` and ``output`` of usable records.

    Members that are not strings count as their text, a null as the word None; an
    absent member is empty. Instruction and output must not be empty.
    """
    def members(kind: str) -> str:
        return "struct<" + ",".join(f"{f}:{kind}" for f in _FIELDS) + ">"

    def both(text: Column) -> Column:
        return F.struct(
            F.from_json(text, members("variant")).alias("kinds"), F.from_json(text, members("string")).alias("texts")
        )

    def shown(p: Column, name: str) -> Column:
        kind, text = F.schema_of_variant(p["kinds"][name]), p["texts"][name]
        value = (
            F.when(kind == "VOID", "None")
            .when(kind == "BOOLEAN", F.initcap(text))
            .otherwise(F.coalesce(text, F.lit("")))
        )
        return strip(value).alias(name)

    def usable(c: Column) -> Column:
        return F.when((c["instruction"] != "") & (c["output"] != ""), c)

    read = let(let(F.col(record), both), lambda p: F.struct(*[shown(p, f) for f in _FIELDS]))
    kept = with_kept(records, "_c", let(read, usable))
    return kept.withColumns({f: F.col(f"_c.{f}") for f in _FIELDS}).drop("_c")


def chat_messages(instruction: Column, user_input: Column, output: Column) -> Column:
    """User and assistant message of a record."""
    asked = F.when(user_input == "", instruction).otherwise(F.concat(instruction, F.lit("\n\n"), user_input))

    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    return F.array(message("user", asked), message("assistant", output))


def with_messages(pairs: DataFrame) -> DataFrame:
    return pairs.withColumn("messages", chat_messages(*[F.col(f) for f in _FIELDS]))


def seeded_draw(
    indexed: DataFrame, index: str, k: int = CALIBRATION_SAMPLES, seed: int = CALIBRATION_SEED
) -> DataFrame:
    """Draw min(k, n) of the n rows whose ``index`` is dense from 0; adds ``draw_no``.

    The draw is that of a seeded ``random.Random(seed).sample`` over the row numbers,
    so only the k numbers, not the rows, are drawn on the driver; ``k`` above
    ``MAX_DRAWS`` is refused.
    """
    if k > MAX_DRAWS:
        raise ValueError(f"a calibration set has at most {MAX_DRAWS} members, not {k}")
    n = indexed.count()
    picks = random.Random(seed).sample(range(n), min(k, n))
    rows = [(p, i) for i, p in enumerate(picks)]
    draws = indexed.sparkSession.createDataFrame(rows, f"`{index}` bigint, draw_no int")
    if len(rows) <= MAX_BROADCAST_DRAWS:
        draws = F.broadcast(draws)
    return indexed.join(draws, index)
