"""Inputs of the registered queries, as pure functions of the given tables.

Every fixture exists twice: as a Spark table here, and as a DuckDB query for the oracle.
Both cover all rows of their tables. ``CASE``s on keys shape values (a blank here, a
damaged record there) so that each rule has something to act on; they select no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sheaf.fixed import RECORD_KEYS, TASKS
from sheaf.functions.json_text import quoted
from sheaf.operators.ordering import with_dense_index
from sheaf.operators.pages import page_key
from sheaf.record_template import TECHNIQUES
from sheaf.session import spread, staged_path

TASK_LIST = list(TASKS.values())
IMAGE_HOST = "https://images.example/"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents for row-heavy work; a single small file is spread over the cores."""
    return spread(table(spark, sf_dir, "documents"))


def nth_task(n: Column) -> Column:
    return F.get(F.array(*[F.lit(t) for t in TASK_LIST]), F.pmod(n, F.lit(len(TASK_LIST))).cast("int"))


# -- documents as pre-training candidates -------------------------------------------
def cpt_candidates(spark, sf_dir) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    padded = F.concat(F.lit(" "), "text", F.lit("\n"))
    second = F.when(F.col("doc_id") % 50 == 0, F.lit(" \t")).otherwise(F.col("text"))
    return docs.select(
        F.col("doc_id").alias("paper_index"),
        nth_task(F.col("doc_id")).alias("task_type"),
        F.posexplode(F.array(padded, second)).alias("pos", "text"),
    )


# -- conversations as instruction and preference candidates ---------------------------
def turns(spark, sf_dir) -> DataFrame:
    """User turns answered by the assistant: conv_id, turn, instruction, input, output."""
    conv = table(spark, sf_dir, "conversations")
    users = conv.filter("role = 'user'").select("conv_id", "turn", F.col("text").alias("instruction"))
    replies = conv.filter("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("output")
    )
    system = conv.filter("role = 'system'").groupBy("conv_id").agg(F.min("text").alias("system"))
    pairs = users.join(replies, ["conv_id", "turn"]).join(system, "conv_id", "left")
    shown = F.coalesce("system", F.concat(F.lit("turn "), F.col("turn").cast("string")))
    return pairs.withColumn("input", F.when(F.col("conv_id") % 10 == 0, F.lit(" ")).otherwise(shown)).drop("system")


def sft_candidates(spark, sf_dir) -> DataFrame:
    """Each turn twice, the copy at a later position."""
    t = turns(spark, sf_dir)
    return t.select(
        F.col("conv_id").alias("paper_index"),
        nth_task(F.col("conv_id")).alias("task_type"),
        F.explode(F.array(F.col("turn").cast("int"), (F.col("turn") + 1000).cast("int"))).alias("pos"),
        F.lit("x").alias("model_task_type"),
        "instruction", "input", "output",
    )


def dpo_candidates(spark, sf_dir) -> DataFrame:
    """Rejected is the reply two turns later, or the chosen one where there is none."""
    t = turns(spark, sf_dir)
    later = table(spark, sf_dir, "conversations").filter("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 3).alias("turn"), F.col("text").alias("later")
    )
    return t.join(later, ["conv_id", "turn"], "left").select(
        F.col("conv_id").alias("paper_index"),
        nth_task(F.col("conv_id")).alias("task_type"),
        F.col("turn").cast("int").alias("pos"),
        F.col("instruction").alias("prompt"),
        F.col("output").alias("chosen"),
        F.coalesce("later", "output").alias("rejected"),
    )


# -- documents as extraction records ---------------------------------------------------
def paper_records(spark, sf_dir) -> DataFrame:
    docs = documents(spark, sf_dir)
    record = F.concat(
        F.lit('{"文献元数据":{"标题":'), quoted("source"), F.lit(',"关键词":['), quoted("lang"),
        F.lit(']},"文献原文信息":{"摘要":'), quoted("text"), F.lit("}}"),
    )
    return docs.select(F.col("doc_id").alias("paper_index"), record.alias("record_json"))


def prompts(spark) -> DataFrame:
    return spark.createDataFrame(
        [(n, t, f"Task: {n}") for n, t in TASKS.items()], "prompt_name string, task_type string, prompt string"
    )


def damaged_records(spark, sf_dir) -> DataFrame:
    """Records with all twelve keys; some lose a key, hold a null, are wrapped or cut in half."""
    docs = documents(spark, sf_dir)
    first, last = RECORD_KEYS[0], RECORD_KEYS[-1]
    middle = "".join(f',"{k}":[]' for k in RECORD_KEYS[2:-1])
    record = F.concat(
        F.lit(f'{{"{first}":{{"标题":'), quoted("source"), F.lit(f'}},"{RECORD_KEYS[1]}":{{"摘要":'), quoted("text"),
        F.lit("}" + middle),
        F.when(F.col("doc_id") % 7 == 0, F.lit("")).otherwise(
            F.concat(F.lit(f',"{last}":'), F.when(F.col("doc_id") % 11 == 0, F.lit("null")).otherwise(F.lit("[]")))
        ),
        F.lit("}"),
    )
    shaped = (
        F.when(F.col("doc_id") % 13 == 0, F.concat(F.lit("["), record, F.lit("]")))
        .when(F.col("doc_id") % 17 == 0, F.substring(record, F.lit(1), (F.length(record) / 2).cast("int")))
        .otherwise(record)
    )
    return docs.select("doc_id", shaped.alias("answer"))


TECHNIQUE_CYCLE = [*TECHNIQUES, "plasma", None]
#: First and third core parameter of each technique, by place in the cycle.
PARAMETERS = [(core[0], core[2].split("|")[0]) for core, _ in TECHNIQUES.values()] + [("x", "y")] * 2


def section_records(spark, sf_dir) -> DataFrame:
    """Records with samples, techniques and measured values, and faults of every kind in them."""
    docs = documents(spark, sf_dir)
    d, n = F.col("doc_id"), F.col("n_chars").cast("string")
    year = (
        F.when(d % 4 == 0, F.concat(F.lit(',"发表年份":'), (2000 + d % 25).cast("string")))
        .when(d % 4 == 1, F.lit(',"发表年份":" 2001.5 "')).when(d % 4 == 2, F.lit(',"发表年份":null')).otherwise("")
    )
    source = F.concat(
        F.lit('"文献元数据":{"标题":'), quoted("source"), year, F.lit(',"关键词":['), quoted("lang"), F.lit(',1,"k"],"a~/*":{"*":[]}}')
    )
    abstract = F.concat(F.lit(',"文献原文信息":{"摘要":'), quoted("text"), F.lit(',"结论":null,"重要机理":""}'))

    def cycled(values: list, k: Column) -> Column:
        return F.get(F.array(*[F.lit(v) for v in values]), F.pmod(d + k, F.lit(len(values))).cast("int"))

    def sprayed(k: Column) -> Column:
        number = F.when(d % 2 == 0, F.concat(F.lit(" s"), k.cast("string"), F.lit(" "))).otherwise(F.concat(F.lit("S"), k.cast("string")))
        second = F.when(d % 5 == 0, cycled([p[1] for p in PARAMETERS[1:] + PARAMETERS[:1]], k)).otherwise(
            cycled([p[1] for p in PARAMETERS], k)
        )
        return F.concat(
            F.lit('{"样品/涂层编号":"'), number, F.lit('","功能层类型":"工作层","喷涂技术类型":'),
            F.coalesce(quoted(cycled(TECHNIQUE_CYCLE, k)), F.lit("null")), F.lit(',"工艺参数":{'),
            quoted(cycled([p[0] for p in PARAMETERS], k)), F.lit(":"), n, F.lit(","), quoted(second), F.lit(":null}}"),
        )

    def measured(k: Column) -> Column:
        mean = F.when(d % 6 == 0, F.lit('"n/a"')).when(d % 6 == 1, F.concat(F.lit('"'), n, F.lit('"'))).otherwise(n)
        number = F.when((d % 9 == 0) & (k == 1), F.lit("null")).otherwise(F.concat(F.lit('"S'), k.cast("string"), F.lit('"')))
        return F.concat(
            F.lit('{"样品/涂层编号":'), number, F.lit(',"显微硬度":{"类型":"HV","平均值":'), mean, F.lit('},"弹性模量(GPa)":'), n, F.lit("}")
        )

    def listed(last: Column, item) -> Column:
        return F.array_join(F.transform(F.sequence(F.lit(1).cast("bigint"), last), item), ",")

    record = F.concat(
        F.lit("{"), source, F.when(d % 7 == 0, F.lit("")).otherwise(abstract),
        F.lit(',"喷涂工艺参数":['), listed(1 + d % 3, sprayed), F.lit('],"力学性能参数":['), listed(1 + d % 4, measured),
        F.lit('],"摩擦学性能":'), F.when(d % 11 == 0, F.lit("null")).otherwise(F.lit("[]")),
        F.when(d % 5 == 0, F.lit(',"extra/field":{"a":[1,{"b":true}]}')).otherwise(F.lit("")), F.lit("}"),
    )
    shaped = (
        F.when(d % 13 == 0, F.concat(F.lit("["), record, F.lit("]")))
        .when(d % 17 == 0, F.substring(record, F.lit(1), (F.length(record) / 2).cast("int")))
        .otherwise(record)
    )
    return docs.select("doc_id", shaped.alias("record_json"))


def array_files(spark, sf_dir) -> str:
    """Folder of files with one JSON array each, indented or not; every document is an item."""
    docs = documents(spark, sf_dir)
    item = F.concat(
        F.lit('{"id":'), F.col("doc_id").cast("string"), F.lit(',"text":'), quoted("text"), F.lit(',"of":[{"lang":'),
        quoted("lang"), F.lit('}, "],[", null]}'),
    )

    def as_array(batches):
        import pandas as pd

        first = True
        for batch in batches:
            head = batch["value"].copy()
            head[:] = "  " + head
            head.iloc[1:] = ",\n" + head.iloc[1:]
            head.iloc[0] = ("[" if first else ",") + head.iloc[0]
            first = False
            yield pd.DataFrame({"value": head})
        yield pd.DataFrame({"value": ["[]" if first else "]"]})

    # a task writes one file
    path = staged_path(spark, "arrays")
    docs.select(item.alias("value")).mapInPandas(as_array, "value string").write.text(path)
    return path


# -- documents as papers with pages --------------------------------------------------------
def papers(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select(
        "doc_id",
        F.concat(F.lit("/papers/"), F.col("doc_id").cast("string"), F.lit(".pdf")).alias("doc_path"),
        (F.lit(1) + F.expr("n_chars div 400")).cast("int").alias("page_count"),
    )


def pages(spark, sf_dir) -> DataFrame:
    p = papers(spark, sf_dir).select("*", F.explode(F.sequence(F.lit(1), F.col("page_count"))).alias("page_no"))
    return p.select(
        "doc_id", "doc_path", "page_no", "page_count",
        ((F.col("doc_id") * 7919 + F.col("page_no") * 104729) % 12000000).alias("image_bytes_len"),
        F.concat(F.lit(IMAGE_HOST), page_key("doc_path", "page_no")).alias("image_url"),
    )


# -- documents as model responses --------------------------------------------------------------
def responses(spark, sf_dir) -> DataFrame:
    docs = documents(spark, sf_dir)
    d = F.col("doc_id")
    one = F.concat(F.lit('{"text":'), quoted("text"), F.lit("}"))
    two = F.concat(F.lit("["), one, F.lit(',"note",{"text":'), quoted("lang"), F.lit("}]"))
    fenced = F.concat(F.lit("```json\n"), two, F.lit("\n```"))
    wrapped = F.concat(F.lit('{"note":1,"samples":'), two, F.lit("}"))
    content = F.when(d % 10 == 7, fenced).when(d % 10 == 8, wrapped).when(d % 10 == 9, one).otherwise(two)

    def message(text):
        return F.concat(
            F.lit('{"type":"message","content":[{"type":"refusal","text":"no"},{"type":"output_text","text":'),
            quoted(text), F.lit("}]}"),
        )

    output = (
        F.when(d % 10 == 0, F.concat(F.lit('"output_text":'), quoted(content)))
        .when(d % 10 == 2, F.concat(F.lit('"output_text":"  ","output":['), message(content), F.lit("]")))
        .when(d % 10 == 3, F.concat(F.lit('"output":[{"type":"reasoning","content":null},'), message(content), F.lit("]")))
        .when(d % 10 == 6, F.lit('"output":[],"error":{"message":"no answer"}'))
        .otherwise(F.concat(F.lit('"output":['), message(content), F.lit("]")))
    )
    status = F.when(d % 10 == 4, "failed").when(d % 10 == 5, "incomplete").otherwise("completed")
    given = F.when(d % 29 == 0, F.lit("true")).otherwise(F.col("n_chars").cast("string"))
    usage = F.when(d % 23 == 0, F.lit("")).otherwise(
        F.concat(
            F.lit(',"usage":{"input_tokens":'), given,
            F.lit(',"input_tokens_details":{"cached_tokens":'), (d * 3).cast("string"),
            F.lit('},"output_tokens":'), (d % 100).cast("string"), F.lit("}"),
        )
    )
    body = F.concat(F.lit('{"status":"'), status, F.lit('",'), output, usage, F.lit("}"))
    return docs.select("doc_id", body.alias("body"), F.lit(None).cast("string").alias("error"))


STATUS_CYCLE = [200, 400, 400, 401, 408, 409, 425, 429, 500, 503]


def attempts(spark, sf_dir) -> DataFrame:
    """HTTP answers of every kind, three attempts each."""
    docs = table(spark, sf_dir, "documents")
    status = F.get(F.array(*[F.lit(s) for s in STATUS_CYCLE]), F.pmod("doc_id", F.lit(10)).cast("int"))
    message = F.when(F.col("doc_id") % 10 == 2, F.concat(F.lit("Disallowed URL: "), "source")).otherwise(F.col("lang"))
    body = (
        F.when(F.col("doc_id") % 10 != 0, F.concat(F.lit('{"error":{"message":'), quoted(message), F.lit("}}")))
        .when(F.col("doc_id") % 20 == 0, F.lit('{"status":"completed"}'))
        .otherwise(F.lit("[1]"))
    )
    return docs.select(
        "doc_id", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("attempt"),
        status.alias("http_status"), body.alias("body"),
    )


def noisy_answers(spark, sf_dir) -> DataFrame:
    """Answers with prose around the value, a value before the value, or a cut-off array."""
    docs = documents(spark, sf_dir)
    one = F.concat(F.lit('{"text":'), quoted("text"), F.lit("}"))
    kind = F.col("doc_id") % 5
    answer = (
        F.when(kind == 0, F.concat(F.lit("Here it is:\n"), one, F.lit("\nDone.")))
        .when(kind == 1, F.concat(F.lit("See [1] for "), one))
        .when(kind == 2, F.concat(F.lit("["), one, F.lit(',{"text":"cut')))
        .when(kind == 3, F.concat(F.lit("```\n"), one, F.lit("\n``` trailing")))
        .otherwise(F.regexp_replace("text", r"[\[{]", "("))
    )
    return docs.select("doc_id", answer.alias("answer"))


# -- conversations as records to translate ----------------------------------------------------
def translation_input(spark, sf_dir) -> DataFrame:
    t = with_dense_index(turns(spark, sf_dir), ["conv_id", "turn"], out="id")
    return t.select("id", "instruction", "input", "output")


def as_record(t: DataFrame) -> Column:
    return F.to_json(F.struct("instruction", "input", "output"))


# -- JSON lines of two sources --------------------------------------------------------------------
def json_lines(spark, sf_dir) -> DataFrame:
    """(src_ordinal, line_key, value, path): instruction records, then event properties, blank lines between."""
    t = turns(spark, sf_dir)
    task = nth_task(F.col("conv_id"))
    member = (
        F.when(F.col("turn") % 6 == 0, F.lit(""))
        .when(F.col("turn") % 7 == 0, F.lit('"task_type":"  ",'))
        .when(F.col("turn") % 5 == 0, F.concat(F.lit('"task_type":"  '), task, F.lit(' ",')))
        .otherwise(F.concat(F.lit('"task_type":"'), task, F.lit('",')))
    )
    line = F.concat(
        F.lit("{"), member, F.lit('"instruction":'), quoted("instruction"), F.lit(', "input" : '), quoted("input"),
        F.lit(',"output":'), quoted("output"), F.lit("}"),
    )
    first = t.select(F.lit(0).alias("src_ordinal"), (F.col("conv_id") * 100000 + F.col("turn")).alias("line_key"), line.alias("value"))
    events = table(spark, sf_dir, "events")
    second = events.select(F.lit(1).alias("src_ordinal"), F.col("event_id").alias("line_key"), F.col("props").alias("value"))
    blank = events.select(F.lit(2).alias("src_ordinal"), F.col("event_id").alias("line_key"), F.lit(" \t").alias("value"))
    lines = first.unionAll(second).unionAll(blank)
    return lines.withColumn("path", F.concat(F.lit("source "), F.col("src_ordinal").cast("string")))
