"""From paper pages to extraction requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sheaf.fixed import CORRECTION_TEXT, IMAGE_MAX_MB, KEY_PREFIX, MAX_OUTPUT_TOKENS, PAGES_PER_REQUEST


def page_key(doc_path: Column | str, page_no: Column | str, prefix: str = KEY_PREFIX) -> Column:
    """Stable object key of a page image; a repeated run gives the same key."""
    doc_path = F.col(doc_path) if isinstance(doc_path, str) else doc_path
    page_no = F.col(page_no) if isinstance(page_no, str) else page_no
    # format_string keeps numbers above 9999 whole, lpad would cut them
    key = F.concat(
        F.substring(F.sha2(doc_path, 256), 1, 16), F.lit("/page-"), F.format_string("%04d", page_no), F.lit(".png")
    )
    prefix = prefix.strip("/")
    return F.concat(F.lit(prefix + "/"), key) if prefix else key


def with_batch_numbers(pages: DataFrame, pages_per_request: int = PAGES_PER_REQUEST) -> DataFrame:
    """Add ``batch_no``, ``batch_count``, ``start_page`` and ``end_page`` to page rows."""
    k = pages_per_request
    batch_no = F.floor((F.col("page_no") - 1) / F.lit(k)) + 1
    return (
        pages.withColumn("batch_no", batch_no.cast("int"))
        .withColumn("batch_count", F.ceil(F.col("page_count") / F.lit(k)).cast("int"))
        .withColumn("start_page", ((F.col("batch_no") - 1) * k + 1).cast("int"))
        .withColumn("end_page", F.least(F.col("batch_no") * k, F.col("page_count")).cast("int"))
    )


def page_batches(pages: DataFrame, pages_per_request: int = PAGES_PER_REQUEST) -> DataFrame:
    """One row per request with its page images in page order.

    Groups are (paper, batch), so no group is larger than ``pages_per_request`` pages,
    however long a paper is.
    """
    numbered = with_batch_numbers(pages, pages_per_request)
    grouped = numbered.groupBy("doc_path", "batch_no", "batch_count", "start_page", "end_page").agg(
        F.max("image_bytes_len").alias("max_image_bytes"),
        F.array_sort(F.collect_list(F.struct("page_no", "image_url"))).alias("_pages"),
    )
    return grouped.withColumn("image_urls", F.col("_pages.image_url")).drop("_pages")


# above any page size in bytes, so that a page number and a size pack into one number
_BYTE_RANGE = 10**15


def image_limit(max_mb: float = IMAGE_MAX_MB) -> int:
    return int(max_mb * 1024 * 1024)


def first_oversized_page(pages: DataFrame, max_mb: float = IMAGE_MAX_MB) -> DataFrame:
    """Per paper with a page above the limit: ``first_bad`` and its ``bad_bytes``.

    Packs (page, bytes) into one number so that the aggregate stays hash based.
    """
    bad = pages.filter(F.col("image_bytes_len") > image_limit(max_mb))
    packed = F.col("page_no").cast("decimal(38,0)") * _BYTE_RANGE + F.col("image_bytes_len")
    first = bad.groupBy("doc_path").agg(F.min(packed).alias("_p"))
    page_no = F.expr(f"_p div {_BYTE_RANGE}")
    return first.select(
        "doc_path",
        page_no.cast("int").alias("first_bad"),
        (F.col("_p") - page_no.cast("decimal(38,0)") * _BYTE_RANGE).cast("bigint").alias("bad_bytes"),
    )


def guard_oversized(batches: DataFrame, oversized: DataFrame) -> DataFrame:
    """Keep the batches that end before the first oversized page of their paper."""
    joined = batches.join(oversized.select("doc_path", "first_bad"), "doc_path", "left")
    return joined.filter(F.col("first_bad").isNull() | (F.col("end_page") < F.col("first_bad"))).drop("first_bad")


def oversize_error(page_no: Column, n_bytes: Column, max_mb: float = IMAGE_MAX_MB) -> Column:
    mb = 1024.0 * 1024.0
    return F.format_string(
        "image of page %d has %.2f MB, the limit is %.2f MB",
        page_no, n_bytes / F.lit(mb), F.lit(image_limit(max_mb) / mb),
    )


def extraction_input(image_urls: Column | str, prompt: str, correct: Column | bool = False) -> Column:
    """Request input: images in order, then the prompt, then the correction if asked for."""
    image_urls = F.col(image_urls) if isinstance(image_urls, str) else image_urls

    def part(kind: str, url: Column, text: Column) -> Column:
        return F.struct(F.lit(kind).alias("type"), url.alias("image_url"), text.alias("text"))

    none = F.lit(None).cast("string")
    images = F.transform(image_urls, lambda u: part("input_image", u, none))
    text = F.array(part("input_text", none, F.lit(prompt)))
    again = F.array(part("input_text", none, F.lit(CORRECTION_TEXT)))
    if isinstance(correct, bool):
        content = F.concat(images, text, again) if correct else F.concat(images, text)
    else:
        content = F.when(correct, F.concat(images, text, again)).otherwise(F.concat(images, text))
    return F.to_json(F.array(F.struct(F.lit("user").alias("role"), content.alias("content"))))


def extraction_requests(batches: DataFrame, prompt: str, correct: bool = False) -> DataFrame:
    """Requests for batches; the id covers the images, so changed pages are asked anew."""
    urls = F.array_join("image_urls", "\n")
    request_id = F.sha2(
        F.concat_ws("\x1f", F.lit("extract"), "doc_path", F.col("batch_no").cast("string"),
                    F.lit("1" if correct else "0"), F.sha2(F.lit(prompt), 256), urls), 256)
    return batches.select(
        request_id.alias("request_id"),
        "doc_path", "batch_no", "batch_count", "start_page", "end_page",
        extraction_input("image_urls", prompt, correct).alias("input"),
        F.lit("none").alias("reasoning_effort"),
        F.lit(MAX_OUTPUT_TOKENS).alias("max_output_tokens"),
    )
