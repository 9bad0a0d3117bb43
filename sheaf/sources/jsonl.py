"""JSON Lines and JSON array inputs."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import TypeVar

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sheaf.functions.binding import let, with_kept
from sheaf.functions.json_text import canonical, root_kind
from sheaf.functions.salvage import decoded
from sheaf.functions.text import is_filled
from sheaf.operators.ordering import add_position
from sheaf.session import stage
from sheaf.sources.json_array import checked_items, read_items

T = TypeVar("T")


BROKEN = "broken JSON"
NOT_OBJECT = "not a JSON object"
NOT_LINES = "; lines of records belong in a .jsonl file"


class JsonlError(RuntimeError):
    """A line that is not one JSON object; the message names file and line."""


def scan_lines(spark: SparkSession, inputs: Sequence[str]) -> DataFrame:
    """All physical lines of the inputs, blank ones included.

    An input is a file or a folder of files. One scan per input keeps an input that is
    named twice twice. ``split_start`` and ``split_pos`` give the place of a line: files
    are cut into byte ranges, and ``split_pos`` grows along each range.
    """
    scans = [
        spark.read.text(path).select(
            F.lit(i).alias("src_ordinal"),
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_block_start").alias("split_start"),
            F.monotonically_increasing_id().alias("split_pos"),
            "value",
        )
        for i, path in enumerate(inputs)
    ]
    if not scans:
        raise ValueError("name at least one input")
    lines = scans[0]
    for scan in scans[1:]:
        lines = lines.unionAll(scan)
    return lines


def physical_lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line (``value``) with its line feed; the last of a file only if it has one.

    Spark drops line ends. Read line feed by line feed, a file's size tells whether its
    last line had one, so a first pass compares sizes; it decodes nothing and shuffles
    one row per file. Only files that end without a line feed, normally none, are landed
    to find their last line. A carriage return alone also ends a line.
    """
    raw = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_block_start").alias("split_start"),
        F.monotonically_increasing_id().alias("split_pos"),
        "value",
    )
    files = raw.groupBy("path").agg(
        (F.max("size") - F.sum(F.octet_length("value")) - F.count(F.lit(1))).alias("left"),
        F.count(F.lit(1)).alias("n"),
    )
    # what is left over besides line feeds: nothing, or the three bytes of a dropped mark
    unended = stage(files.filter(F.col("left").isin(-1, 2)).select("path", "n"), "unended")
    if unended.isEmpty():
        return raw.select(F.explode(_line_pieces("value", F.lit(False))).alias("value"))
    ended = raw.join(unended, "path", "left_anti").select("value", F.lit(False).alias("last"))
    landed = stage(raw.join(unended.select("path"), "path", "left_semi"), "lines")
    placed = add_position(landed, by=["path", "split_start"], pos="split_pos", out="line", within=["path"], first=1)
    final = placed.join(unended, "path").select("value", (F.col("line") == F.col("n")).alias("last"))
    both = ended.unionByName(final)
    return both.select(F.explode(_line_pieces("value", F.col("last"))).alias("value"))


def _line_pieces(value: str, last: Column) -> Column:
    """Lines inside a stretch between line feeds; the stretch that is ``last`` has none behind it."""
    feed = F.lit("\n")
    inner = F.split(F.regexp_replace(value, r"\r\z", ""), "\r", -1)
    pieces = F.split(value, "\r", -1)
    size = F.size(pieces)
    open_end = F.transform(pieces, lambda p, i: F.when(i < size - 1, F.concat(p, feed)).otherwise(p))
    return F.when(last, F.filter(open_end, lambda p: p != "")).otherwise(F.transform(inner, lambda p: F.concat(p, feed)))


def line_problem(value: Column | str) -> Column:
    """Why a line is not one JSON object; null for a good or a blank line."""
    bad = F.when(~_is_plain(canonical(value), value), BROKEN).when(root_kind(value) != "object", NOT_OBJECT)
    return F.when(is_filled(value), bad)


def _is_plain(compact: Column, value: Column | str) -> Column:
    """Whether Spark may judge a line alone: one valid value, no object in it with repeated members.

    Of repeated members the last counts; Spark's parser for variants refuses them, so such
    lines are read by Python's decoder, like those with NaN.
    """
    return compact.isNotNull() & F.try_parse_json(value).isNotNull()


def with_record(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Drop blank lines and add ``record`` (canonical text) and ``problem``."""

    def read(value: Column) -> Column:
        def judged(text: Column) -> Column:
            is_object = root_kind(value) == "object"
            plain = _is_plain(text, value)
            problem = F.when(~plain, BROKEN).when(~is_object, NOT_OBJECT)
            return F.struct(F.when(plain & is_object, text).alias("record"), problem.alias("problem"))

        return F.when(is_filled(value), let(canonical(value), judged))

    read_lines = with_kept(lines, "_r", let(F.col(value_col), read))
    return read_lines.withColumns({n: F.col(f"_r.{n}") for n in ("record", "problem")}).drop("_r")


def with_python_judgement(records: DataFrame, value_col: str = "value") -> DataFrame:
    """Let Python's decoder have the last word on lines Spark's refuses, such as NaN values."""
    broken = F.col("problem") == BROKEN
    judged = records.withColumn("_p", decoded(F.when(broken, F.col(value_col))))
    kind = F.when(broken, F.col("_p.kind"))
    return (
        judged.withColumn("record", F.when(kind == "object", F.col("_p.value")).otherwise(F.col("record")))
        .withColumn("problem", F.when(kind == "object", None).when(kind.isNotNull(), NOT_OBJECT).otherwise(F.col("problem")))
        .drop("_p")
    )


def require_objects(records: DataFrame, skip_others: bool = False) -> DataFrame:
    """Strict reading: a broken line ends the job, naming its file.

    So does a value that is not an object, unless such values are to be skipped.
    ``bad_lines`` finds the line numbers; it runs only once something is wrong. The error
    is raised by the row's own value, so no later filter can raise it for another row.
    """
    fault = F.raise_error(F.concat_ws(" ", "problem", F.lit("in"), "path")).cast("string")
    checked = F.when(F.col("problem").isNull(), F.col("record"))
    if skip_others:
        checked = checked.when(F.col("problem") == NOT_OBJECT, F.lit(None).cast("string"))
    records = records.withColumn("record", checked.otherwise(fault)).drop("problem")
    return records.filter("record is not null") if skip_others else records


def read_jsonl(
    spark: SparkSession, inputs: Sequence[str], mode: str = "fail", python_judges: bool = False
) -> DataFrame:
    """One row per non-blank line with its canonical ``record``.

    ``mode='fail'`` rejects the input at a line that is not an object, ``'quarantine'``
    leaves such lines out (``bad_lines`` returns them), ``'skip'`` leaves out valid
    values that are not objects and rejects broken JSON. ``python_judges`` shows refused
    lines to Python's decoder; it costs a Python step that clean inputs do not need.
    """
    if mode not in ("fail", "quarantine", "skip"):
        raise ValueError(f"unknown mode {mode!r}")
    records = with_record(scan_lines(spark, inputs))
    if python_judges:
        records = with_python_judgement(records)
    if mode == "quarantine":
        return records.filter(F.col("problem").isNull()).drop("problem")
    return require_objects(records, skip_others=mode == "skip")


def index_records(records: DataFrame, out: str = "record_index") -> DataFrame:
    """Add a dense 0-based index in input order to rows that came from ``scan_lines``.

    The rows are landed first, because positions inside a scan are stable only once
    they are written. Then one row per byte range is summed up and joined back; the
    rows are neither sorted nor, for a normal number of ranges, shuffled.
    """
    placed = records.drop("split_pos").withColumn("_pos", F.monotonically_increasing_id())
    landed = stage(placed, "records")
    return add_position(landed, by=["src_ordinal", "path", "split_start"], pos="_pos", out=out).drop("_pos")


def bad_lines(spark: SparkSession, inputs: Sequence[str]) -> DataFrame:
    """Quarantine table: every line that is not one JSON object, with its line number.

    Line numbers are 1-based per file and count blank lines.
    """
    lines = scan_lines(spark, inputs)
    marked = lines.withColumn("problem", line_problem("value")).withColumn("record", F.lit(None).cast("string"))
    marked = with_python_judgement(marked).drop("record")
    marked = marked.withColumn("value", F.when(F.col("problem").isNotNull(), F.col("value")))
    numbered = add_position(
        stage(marked, "lines"),
        by=["src_ordinal", "path", "split_start"],
        pos="split_pos",
        out="line_no",
        within=["src_ordinal", "path"],
        first=1,
        keep="problem is not null",
    )
    return numbered.select("src_ordinal", "path", "line_no", "problem", "value")


def run_strict(
    spark: SparkSession, inputs: Sequence[str], action: Callable[[bool], T], skip_others: bool = False
) -> T:
    """Run ``action(python_judges)`` over strictly read lines.

    The first try reads in the JVM alone. Only if it meets a line it refuses, a second
    one asks Python; if that refuses too, the error names the first bad line.
    """
    failure = None
    for python_judges in (False, True):
        try:
            return action(python_judges)
        except Exception as error:
            if "USER_RAISED_EXCEPTION" not in str(error):
                raise
            failure = error
    bad = bad_lines(spark, inputs)
    bad = bad.filter(F.col("problem") == BROKEN) if skip_others else bad
    first = bad.orderBy("src_ordinal", "path", "line_no").first()
    if first is None:
        raise failure
    raise JsonlError(f"{first.problem} at {first.path}:{first.line_no}") from failure


def count_array_items(spark: SparkSession, path: str) -> DataFrame:
    """Items of any type in a file holding one JSON array; anything else ends the job.

    The file is read by as many tasks as it has byte ranges.
    """
    items = checked_items(read_items(spark, path))
    wrong = F.raise_error(F.concat(F.lit("no JSON array in "), F.col("path"), F.lit(NOT_LINES))).cast("bigint")
    one = F.when(~F.col("is_array"), wrong).when(F.col("item").isNotNull(), F.lit(1).cast("bigint"))
    return items.agg(F.coalesce(F.sum(one), F.lit(0).cast("bigint")).alias("samples"))


def array_length(text: Column | str, source: Column) -> Column:
    """Number of items of any type; any text but one JSON array ends the job, naming ``source``."""

    def fault(*words: str | Column) -> Column:
        parts = [F.lit(w) if isinstance(w, str) else w for w in words]
        return F.raise_error(F.concat(*parts)).cast("bigint")

    def read(value: Column) -> Column:
        def judged(compact: Column) -> Column:
            return (
                F.when(compact.isNull(), fault("broken JSON in ", source))
                .when(root_kind(value) == "array", F.json_array_length(compact).cast("bigint"))
                .otherwise(
                    fault("no JSON array in ", source, NOT_LINES)
                )
            )

        return let(canonical(value), judged)

    return let(F.col(text) if isinstance(text, str) else text, read)
