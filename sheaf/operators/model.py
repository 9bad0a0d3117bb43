"""The model stage: requests in, one row per attempt out.

The caller supplies ``model_fn(request: dict) -> (http_status, body_text)``; an exception
counts as a failed attempt. Nothing here opens a connection.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sheaf.fixed import MAX_RETRIES, RETRYABLE_400_TEXT, RETRYABLE_STATUS
from sheaf.functions.json_text import canonical, is_string_variant, root_kind
from sheaf.session import read_table_if_any

RESPONSES = "request_id string, attempt int, http_status int, body string, error string, final boolean, round int"
REQUEST_FIELDS = ("request_id", "input", "reasoning_effort", "max_output_tokens")

ModelFn = Callable[[dict], tuple[int, str]]

# what an attempt tells
ATTEMPT = {"attempt": pa.int32(), "http_status": pa.int32(), "body": pa.string(), "error": pa.string(), "final": pa.bool_()}

# how much of a refused answer its error shows; the whole body is kept in its own column
EXCERPT_CHARS = 150


def _caller(model_fn: ModelFn, keys: list[str], max_retries: int, threads: int, backoff_s: float, round_no: int):
    """Per-partition loop. A failing request gives an error row and never ends the job."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import json
        import time
        from concurrent.futures import ThreadPoolExecutor

        def ask(request: dict) -> list[tuple]:
            told = []
            for attempt in range(max_retries + 1):
                status, body, error = None, None, None
                try:
                    status, body = model_fn(request)
                    if status >= 400:
                        excerpt = (body or "")[:EXCERPT_CHARS]
                        error = f"HTTP {status}, body: {excerpt}"
                    elif not isinstance(json.loads(body), dict):
                        error = "the body is not a JSON object"
                except Exception as exc:  # noqa: BLE001 - any failure belongs to this request only
                    error = str(exc) or type(exc).__name__
                if error is not None:
                    error = f"request failed: {error}"
                final = error is None or attempt == max_retries
                told.append((attempt, status, body, error, final))
                if final:
                    break
                if backoff_s:  # also a sleep of no time takes some
                    time.sleep(backoff_s * 2**attempt)
            return told

        def rows(part: pa.RecordBatch) -> Iterator[dict]:
            # texts through arrays of objects, which cost less than single values
            columns = [
                c.to_numpy(zero_copy_only=False).tolist() if pa.types.is_string(c.type) else c.to_pylist() for c in part.columns
            ]
            return (dict(zip(part.schema.names, values)) for values in zip(*columns))

        step = max(256, 8 * threads)
        names = ["request_id", *ATTEMPT, "round", *keys]
        with ThreadPoolExecutor(max_workers=threads) as pool:
            # one request at a time needs no other thread, whose wake-ups cost as much as a short answer
            ask_all = map if threads == 1 else pool.map
            for batch in batches:
                # hand answers on in small steps: requests and answers are long texts
                for start in range(0, batch.num_rows, step):
                    part = batch.slice(start, step)
                    told = list(ask_all(ask, rows(part)))
                    asked = pa.array([i for i, attempts in enumerate(told) for _ in attempts], pa.int64())
                    columns = zip(*(row for attempts in told for row in attempts))
                    yield pa.RecordBatch.from_arrays([
                        part.column("request_id").take(asked),
                        *(pa.array(values, kind) for values, kind in zip(columns, ATTEMPT.values())),
                        pa.array([round_no] * len(asked), pa.int32()),
                        *(part.column(k).take(asked) for k in keys),
                    ], names=names)

    return run


def response_schema(requests: DataFrame, keys: Sequence[str]) -> str:
    """Columns of the response table: those of every response, then the requests' keys."""
    return ", ".join([RESPONSES, *[f"{k} {requests.schema[k].dataType.simpleString()}" for k in keys]])


def call_model(
    requests: DataFrame,
    model_fn: ModelFn,
    keys: Sequence[str] = (),
    max_retries: int = MAX_RETRIES,
    threads: int = 1,
    backoff_s: float = 1.0,
    round_no: int = 0,
) -> DataFrame:
    """Responses of all requests, lazily. Concurrency is running tasks times ``threads``.

    ``keys`` are scalar columns handed on with each response, so that responses need not
    be joined back to their requests.
    """
    run = _caller(model_fn, list(keys), max_retries, threads, backoff_s, round_no)
    return requests.select(*REQUEST_FIELDS, *keys).mapInArrow(run, response_schema(requests, keys))


WAVES = "round int, waves int, wave int"


def committed_waves(spark: SparkSession, path: str, waves: int) -> tuple[int, set[int]] | None:
    """Round and finished waves of the last run at ``path`` if it was cut into as many waves and did not finish."""
    marks = read_table_if_any(spark, _marks(path), WAVES)
    last = None if marks is None else marks.agg(F.max("round")).first()[0]
    if last is None:
        return None
    done = {r["wave"] for r in marks.filter((F.col("round") == last) & (F.col("waves") == waves)).select("wave").distinct().collect()}
    return (last, done) if 0 < len(done) < waves else None


def _marks(path: str) -> str:
    return f"{path.rstrip('/')}.waves"


def answer(
    requests: DataFrame,
    model_fn: ModelFn,
    path: str,
    keys: Sequence[str] = (),
    waves: int = 1,
    max_retries: int = MAX_RETRIES,
    threads: int = 1,
    backoff_s: float = 1.0,
    wave_by: Sequence[str] = ("request_id",),
    resume: bool = False,
) -> DataFrame:
    """Answer all requests into a table at ``path`` and return that table's rows for them.

    Responses are written before they are used, so no later failure repeats a call.
    Requests already answered at ``path`` are not asked again; those that failed there
    are, in a new round, and their latest round counts. ``waves`` commits the work in
    that many steps: what a lost job has to repeat is at most one wave.

    ``wave_by`` names columns that decide a request's wave. Those that requests are built
    from let Spark skip the other waves' rows before it multiplies and hashes texts. Each
    finished wave is marked beside the table. ``resume`` goes on with the last round if it
    was lost on the way: its finished waves are not even built again, and the others
    ask what that round has not asked. It is for the same requests and number of waves.
    """
    spark = requests.sparkSession
    schema = response_schema(requests, keys)
    earlier = read_table_if_any(spark, path, schema)
    rounds = None if earlier is None else earlier.agg(F.max("round")).first()[0]
    lost = committed_waves(spark, path, waves) if resume else None
    round_no, done = lost or (0 if rounds is None else rounds + 1, set())
    wave = F.pmod(F.xxhash64(*wave_by), F.lit(waves))
    asked = F.col("error").isNull() | (F.col("round") == round_no)
    for number in range(waves):
        if number in done:
            continue
        todo = requests if waves == 1 else requests.filter(wave == number)
        if earlier is not None:
            # a fresh scan: the listing of the first one does not know this call's waves
            answered = spark.read.schema(schema).parquet(path).filter("final").filter(asked)
            todo = todo.join(answered.select("request_id"), "request_id", "left_anti")
        told = call_model(todo, model_fn, keys, max_retries, threads, backoff_s, round_no)
        told.write.mode("append").parquet(path)
        if waves > 1:
            spark.createDataFrame([(round_no, waves, number)], WAVES).coalesce(1).write.mode("append").parquet(_marks(path))
    responses = spark.read.schema(schema).parquet(path)
    if earlier is not None:
        # the table may also hold answers to other requests; only ids and rounds are grouped
        latest = responses.groupBy("request_id").agg(F.max("round").alias("round"))
        wanted = latest.join(requests.select("request_id"), "request_id", "left_semi")
        responses = responses.join(wanted, ["request_id", "round"]).select(*responses.columns)
    return responses


def named_retryable(http_status: Column, body: Column) -> Column:
    """Answers the service itself marks as worth repeating."""
    message = F.from_json(body, "struct<error:struct<message:variant>>").getField("error").getField("message")
    text = F.when(is_string_variant(message), F.try_variant_get(message, "$", "string"))
    rejected = (http_status == 400) & F.coalesce(F.lower(text).contains(RETRYABLE_400_TEXT), F.lit(False))
    return http_status.isin(*RETRYABLE_STATUS) | (http_status >= 500) | rejected


def with_retry_class(responses: DataFrame, max_retries: int = MAX_RETRIES) -> DataFrame:
    """Classify attempts: ``accepted``, ``named_retryable``, ``retry`` and ``backoff_s``.

    Every attempt that is not accepted is repeated while attempts remain.
    """
    is_object = (root_kind("body") == "object") & canonical("body").isNotNull()
    accepted = F.coalesce((F.col("http_status") < 400) & is_object, F.lit(False))
    return (
        responses.withColumn("accepted", accepted)
        .withColumn("named_retryable", F.coalesce(named_retryable(F.col("http_status"), F.col("body")), F.lit(False)))
        .withColumn("retry", ~F.col("accepted") & (F.col("attempt") < max_retries))
        .withColumn("backoff_s", F.when(F.col("retry"), F.pow(F.lit(2.0), F.col("attempt"))))
    )
