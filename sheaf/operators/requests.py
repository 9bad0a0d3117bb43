"""Generation requests: every record with every task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sheaf.fixed import GENERATION_RULES, MAX_SAMPLE_CHARS, SAMPLE_FORMATS, TASKS
from sheaf.functions.json_text import canonical, escaped


def user_message(content: Column) -> Column:
    """Request input holding one user message of plain text."""
    return F.to_json(F.array(F.struct(F.lit("user").alias("role"), content.alias("content"))))


def escaped_user_message(*parts: Column) -> Column:
    """:func:`user_message` of a text given in escaped parts; one that is null makes the whole text null."""
    whole = F.concat(F.lit('[{"role":"user","content":"'), *parts, F.lit('"}]'))
    return F.coalesce(whole, F.lit('[{"role":"user"}]'))


def with_tasks(records: DataFrame, prompts: DataFrame, *more: Column) -> DataFrame:
    """Pair every record with the nine tasks, their prompts and ``more`` columns made of these.

    The tasks are exploded from a literal, so the records are neither joined crosswise
    nor shuffled; the nine prompt rows of one method then come in by a keyed broadcast.
    """
    names = F.array(*[F.lit(n) for n in TASKS])
    paired = records.withColumn("prompt_name", F.explode(names))
    nine = prompts.filter(F.col("prompt_name").isin(*TASKS)).select("prompt_name", "task_type", "prompt", *more)
    return paired.join(F.broadcast(nine), "prompt_name")


def planned_calls(records: DataFrame) -> DataFrame:
    """Records, tasks and their product, without pairing anything."""
    return records.agg(F.count(F.lit(1)).alias("papers")).select(
        "papers",
        F.lit(len(TASKS)).cast("bigint").alias("tasks"),
        (F.col("papers") * len(TASKS)).alias("calls"),
    )


def generation_head(prompt: Column, task_type: Column, method: str, max_chars: int = MAX_SAMPLE_CHARS) -> Column:
    """User text before the record: prompt and five hard rules."""
    before, _, after = SAMPLE_FORMATS[method].partition("%s")
    if after:
        shape = F.concat(F.lit(before), task_type, F.lit(after))
    else:
        shape = F.lit(before)
    head, middle, tail = GENERATION_RULES.split("%s")
    return F.concat(prompt, F.lit("\n\n" + head + str(max_chars) + middle), shape, F.lit(tail))


def generation_requests(
    records: DataFrame, prompts: DataFrame, method: str, max_chars: int = MAX_SAMPLE_CHARS
) -> DataFrame:
    """Nine requests per row of (``paper_index``, ``record_json``): head, then the compact record."""
    # a record holding NaN has no canonical form here and is sent as it is
    text = F.coalesce(canonical("record_json"), F.col("record_json"))
    compact = records.select("paper_index", text.alias("record"))
    # hash and escape the record once, not once per task, and the heads nine times in all
    compact = compact.select("paper_index", escaped("record").alias("_record"), F.sha2("record", 256).alias("_digest"))
    head = escaped(generation_head(F.col("prompt"), F.col("task_type"), method, max_chars))
    pairs = with_tasks(compact, prompts, head.alias("_head"), F.sha2("prompt", 256).alias("_prompt"))
    request_id = F.sha2(
        F.concat_ws("\x1f", F.lit("generate"), F.lit(method), F.lit(str(max_chars)),
                    F.col("paper_index").cast("string"), "task_type", "_prompt", "_digest"), 256)
    return pairs.select(
        request_id.alias("request_id"),
        "paper_index", "task_type",
        F.lit(method).alias("method"),
        escaped_user_message(F.col("_head"), F.col("_record")).alias("input"),
        F.lit("medium").alias("reasoning_effort"),
        F.lit(None).cast("int").alias("max_output_tokens"),
    )
