"""The registered queries of the operators, and DuckDB statements for those SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sheaf.llm import (
    exact_dedup, lexical_scan, near_dedup, packing, pieces, pii, quality_model, quality_rules, secrets, suffix_buckets,
    token_files, url_filter, whitening,
)
from sheaf.llm.common import table
from sheaf.session import stage


def vocabulary(name: str) -> str:
    """Path of a file of a public tokenizer."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_best_fit_packing(spark, sf_dir) -> DataFrame:
    """The place of every piece of every document in sequences of 1024 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.tiktoken"))


def op2_sentencepiece(spark, sf_dir) -> DataFrame:
    """Encoding with merge dropout and decoding, of every document."""
    return pieces.round_trips(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op3_quality_rules(spark, sf_dir) -> DataFrame:
    """Measurements, failure bits, the verdict of the production policy and its ablation for every document."""
    rows = stage(quality_rules.ledger(table(spark, sf_dir, "documents")), "quality-ledger")
    return quality_rules.judged(rows, quality_rules.PRODUCTION).select(
        "doc_id", *quality_rules.MEASURES,
        (~quality_rules.passes(quality_rules.BASE)).alias("base_failed"), "kept",
        F.col("failed").alias("failed_rules"),
        F.lit(quality_rules.PRODUCTION.version).alias("policy"), "only_rule", "kept_without",
    )


def op4_token_counts(spark, sf_dir) -> DataFrame:
    """Tokens of every document, counted in flat token files."""
    return token_files.counted_documents(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op5_minhash_near_dedup(spark, sf_dir) -> DataFrame:
    """The component of near duplicates of every document, on four-word shingles."""
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), 4).select(
        "doc_id", "n_shingles", "component_id", "kept", "class_id"
    )


def op6_secret_scans(spark, sf_dir) -> DataFrame:
    """Secrets in every document."""
    return secrets.digest_columns(secrets.secret_spans(table(spark, sf_dir, "documents")))


def op7_url_filters(spark, sf_dir) -> DataFrame:
    """The verdict on the URL of every page."""
    return url_filter.judged(
        table(spark, sf_dir, "pages"),
        url_filter.host_table(spark, url_filter.HOST_RULES),
        url_filter.pattern_table(spark, url_filter.PATTERN_RULES),
    ).drop("url")


def op8_exact_dedup(spark, sf_dir) -> DataFrame:
    """The document that stays for every document."""
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )


def op9_quality_classifier(spark, sf_dir) -> DataFrame:
    """The quality score of every document."""
    return quality_model.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_pii(spark, sf_dir) -> DataFrame:
    """Personal data in every document."""
    return pii.digest_columns(pii.personal_spans(table(spark, sf_dir, "documents")))


def op11_ranked_lexical_search(spark, sf_dir) -> DataFrame:
    """The ten best documents for every benchmark item."""
    return lexical_scan.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("item")


def op12_suffix_dedup(spark, sf_dir) -> DataFrame:
    """What every document loses if passages of 400 bytes that start twice or more are removed."""
    return suffix_buckets.without_repeated_passages(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256")
    )


def op13_embedding_whitening(spark, sf_dir) -> DataFrame:
    """Whitened embeddings, one row per vector and component."""
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


QUERIES = [
    op1_best_fit_packing, op2_sentencepiece, op3_quality_rules, op4_token_counts, op5_minhash_near_dedup, op6_secret_scans, op7_url_filters,
    op8_exact_dedup, op9_quality_classifier, op10_pii, op11_ranked_lexical_search,
    op12_suffix_dedup, op13_embedding_whitening,
]

ORACLE = {
    "op3_quality_rules": r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)),
      lambda x: regexp_replace(x, '[\x20\x09-\x0D]+', '', 'g') <> '') AS lines
  FROM documents
), starts AS (
  SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM d
), grams AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i], words[i + 1], words[i + 2]) AS n FROM starts
), covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
  FROM (SELECT doc_id, i, unnest([0, 1, 2]) AS k FROM grams WHERE n > 1) GROUP BY doc_id
), m AS (
  SELECT doc_id, len(words)::BIGINT AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, len(lines)::BIGINT AS n_lines,
    (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')))::BIGINT AS n_capitals
  FROM d LEFT JOIN covered USING (doc_id)
), b AS (
  SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END
    + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END
    + CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END
    + CASE WHEN word_chars < 3 * n_words THEN 16 ELSE 0 END
    + CASE WHEN word_chars > 12 * n_words THEN 32 ELSE 0 END
    + CASE WHEN 2 * n_capitals > word_chars THEN 64 ELSE 0 END)::BIGINT AS failed_rules FROM m
)
SELECT *, failed_rules & 3 <> 0 AS base_failed, failed_rules = 0 AS kept, 'production-1' AS policy,
  CASE failed_rules WHEN 1 THEN 'few_words' WHEN 2 THEN 'repeated_words' WHEN 4 THEN 'symbols' WHEN 8 THEN 'repeated_lines'
    WHEN 16 THEN 'short_words' WHEN 32 THEN 'long_words' WHEN 64 THEN 'capitals' END AS only_rule,
  CASE WHEN failed_rules IN (1, 2, 4, 8, 16, 32, 64) THEN
    (SELECT count(*) FROM b WHERE failed_rules = 0) + count(*) OVER (PARTITION BY failed_rules) END AS kept_without
FROM b
""",
    "op7_url_filters": r"""
WITH p AS (
  SELECT page_id, coalesce(url, '') AS url,
    CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), h AS (
  SELECT page_id, translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS url,
    translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p
), r(host, path, verdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
    ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), q(pattern, regex, verdict) AS (
  VALUES ('^casino^', '(?:[^0-9a-z]|^|$)casino(?:[^0-9a-z]|^|$)', 'block'),
    ('^casino-win^', '(?:[^0-9a-z]|^|$)casino-win(?:[^0-9a-z]|^|$)', 'block'),
    ('^free-bets^', '(?:[^0-9a-z]|^|$)free-bets(?:[^0-9a-z]|^|$)', 'block'),
    ('^poker^', '(?:[^0-9a-z]|^|$)poker(?:[^0-9a-z]|^|$)', 'block'),
    ('^xxx^', '(?:[^0-9a-z]|^|$)xxx(?:[^0-9a-z]|^|$)', 'block'),
    ('^payday*loan^', '(?:[^0-9a-z]|^|$)payday(?s:.*)loan(?:[^0-9a-z]|^|$)', 'block'),
    ('^utm_source=spam^', '(?:[^0-9a-z]|^|$)utm_source=spam(?:[^0-9a-z]|^|$)', 'block'),
    ('^archive^pdf^', '(?:[^0-9a-z]|^|$)archive(?:[^0-9a-z]|^|$)pdf(?:[^0-9a-z]|^|$)', 'allow')
), fit AS (
  SELECT page_id, h.host, h.path, h.url,
    (SELECT max({'n': length(r.host || r.path), 'm': length(r.host), 'rule': r.host || r.path, 'verdict': verdict})
     FROM r WHERE (h.host = r.host OR ends_with(h.host, '.' || r.host)) AND starts_with(h.path, r.path)) AS best,
    (SELECT max({'n': length(pattern), 'pattern': pattern, 'verdict': verdict})
     FROM q WHERE regexp_matches(h.url, regex)) AS found
  FROM h
)
SELECT page_id, host, path, best.rule AS rule, found.pattern AS pattern,
  coalesce(best.verdict, found.verdict, 'allow') AS verdict
FROM fit
""",
    "op8_exact_dedup": r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
), g AS (
  SELECT *, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
""",
    "op11_ranked_lexical_search": r"""
WITH d AS (
  SELECT row_number() OVER () AS doc, doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
), counted AS (
  SELECT doc, doc_id, term, count(*) AS tf FROM d GROUP BY ALL
), lengths AS (
  SELECT doc, sum(tf)::BIGINT AS n FROM counted GROUP BY doc
), total AS (
  SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM lengths
), weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM counted, total GROUP BY term, docs
), shares AS (
  SELECT doc, doc_id, term,
    w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // terms))) AS share
  FROM counted JOIN lengths USING (doc) JOIN weights USING (term), total
), asked AS (
  SELECT row_number() OVER () AS item, item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), scores AS (
  SELECT item, item_id, doc, doc_id, sum(share)::BIGINT AS score FROM asked JOIN shares USING (term) GROUP BY ALL
), placed AS (
  SELECT item_id, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank, doc_id, score
  FROM scores WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM placed WHERE rank <= 10
""",
}
