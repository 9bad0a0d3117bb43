"""Quality rules as a ledger of bits, in DataFrame functions only.

Every rule is evaluated once per document. The ledger keeps the measurements and one
bit per failed rule; a policy is a named, versioned set of bits, so that deciding with
another policy, or asking what a policy would keep without one of its rules, reads the
ledger and no text.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from sheaf.llm.common import SPACE_RUN, SPACES, as_struct, text_or_empty
from sheaf.session import stage

SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Rule name to the condition under which a document fails it; the place in this
#: mapping is the bit. Append only: ledgers on disk keep their meaning.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "repeated_lines": "2 * n_dup_lines > n_lines",
    "short_words": "word_chars < 3 * n_words",
    "long_words": "word_chars > 12 * n_words",
    "capitals": "2 * n_capitals > word_chars",
}

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals"]


@dataclass(frozen=True)
class Policy:
    """A document is kept when it fails none of ``rules``."""

    version: str
    rules: tuple[str, ...]

    def mask(self, rules: Mapping[str, str] = RULES) -> int:
        return sum(1 << list(rules).index(r) for r in self.rules)


BASE = Policy("base-1", ("few_words", "repeated_words"))
PRODUCTION = Policy("production-1", tuple(RULES))


def _words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE_RUN, -1), lambda w: w != "")


def _lost(text: Column, chars: str) -> Column:
    """How many characters of ``text`` are among ``chars``."""
    return F.length(text) - F.length(F.translate(text, chars, ""))


def with_measures(docs: DataFrame) -> DataFrame:
    """``docs`` with the columns ``MEASURES`` (bigint), replacing columns of these names.

    Null text has no words. ``n_repeat_words`` counts the words inside three-word windows
    that occur twice or more in the text. Windows are compared by 64-bit hash after one
    sort per document: equal windows become neighbours, so no pairs are formed, and a
    text of one repeated word costs what any text of its length does.
    """
    own = docs.drop(*MEASURES).withColumn("_text", text_or_empty())
    own = own.withColumn("_words", _words(F.col("_text"))).withColumn(
        "_lines", F.filter(F.split("_text", "\n", -1), lambda x: F.translate(x, SPACES, "") != "")
    )
    windows = F.transform(
        F.slice("_words", F.lit(1), F.greatest(F.size("_words") - 2, F.lit(0))),
        lambda w, i: F.struct(F.xxhash64(w, F.get("_words", i + 1), F.get("_words", i + 2)).alias("h"), i.alias("i")),
    )
    own = own.withColumn("_windows", F.sort_array(windows))
    repeated = F.filter(
        "_windows",
        lambda w, i: F.coalesce(F.get("_windows", i - 1)["h"] == w["h"], F.lit(False))
        | F.coalesce(F.get("_windows", i + 1)["h"] == w["h"], F.lit(False)),
    )
    own = own.withColumn("_starts", F.sort_array(F.transform(repeated, lambda w: w["i"])))
    # a window adds the words up to the next repeated window, three at most
    covered = F.aggregate(
        F.transform("_starts", lambda s, k: F.least(F.lit(3), F.coalesce(F.get("_starts", k + 1) - s, F.lit(3)))),
        F.lit(0), lambda total, n: total + n,
    )
    measured = {
        "n_words": F.size("_words"),
        "word_chars": F.length(F.translate("_text", SPACES, "")),
        "n_symbols": _lost(F.col("_text"), SYMBOLS),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": covered,
        "n_lines": F.size("_lines"),
        "n_capitals": _lost(F.col("_text"), CAPITALS),
    }
    kept = [c for c in own.columns if c not in ("_text", "_words", "_lines", "_windows", "_starts")]
    return own.select(*kept, *(m.cast("bigint").alias(n) for n, m in measured.items()))


def failure_bits(rules: Mapping[str, str] = RULES) -> Column:
    """Bit ``k`` is set when rule ``k`` fails; from the columns ``MEASURES``."""
    bits = F.lit(0).cast("bigint")
    for k, rule in enumerate(rules.values()):
        bits = bits.bitwiseOR(F.when(F.expr(rule), F.lit(1 << k)).otherwise(F.lit(0)).cast("bigint"))
    return bits


def ledger(docs: DataFrame, rules: Mapping[str, str] = RULES) -> DataFrame:
    """``doc_id``, the measurements and ``failed`` (bigint bits) for each row of ``docs``.

    Nothing has been written yet: :func:`sheaf.session.stage` it, and decide from that.
    """
    return with_measures(docs.select("doc_id", "text")).drop("text").withColumn("failed", failure_bits(rules))


def passes(policy: Policy, rules: Mapping[str, str] = RULES) -> Column:
    """Whether a row of a ledger is kept under the policy."""
    return F.col("failed").bitwiseAND(F.lit(policy.mask(rules)).cast("bigint")) == 0


def ablations(rows: DataFrame, policy: Policy, rules: Mapping[str, str] = RULES) -> DataFrame:
    """Per rule of the policy, over a ledger: documents that fail it, and those only it rejects.

    ``kept`` counts what the whole policy keeps, ``kept_without`` what it would keep
    without the rule. One pass and one row per rule; an empty ledger gives zeros.
    """
    mask = policy.mask(rules)
    failed = F.col("failed").bitwiseAND(F.lit(mask).cast("bigint"))
    bits = {r: 1 << list(rules).index(r) for r in policy.rules}
    counts = rows.agg(
        F.count_if(failed == 0).alias("kept"),
        *(F.count_if(failed.bitwiseAND(F.lit(b).cast("bigint")) != 0).alias(f"f_{r}") for r, b in bits.items()),
        *(F.count_if(failed == b).alias(f"o_{r}") for r, b in bits.items()),
    )
    per_rule = F.array(*(
        F.struct(
            F.lit(policy.version).alias("policy"), F.lit(r).alias("rule"), F.col(f"f_{r}").alias("failed"),
            F.col(f"o_{r}").alias("only"), F.col("kept"), (F.col("kept") + F.col(f"o_{r}")).alias("kept_without"),
        )
        for r in bits
    ))
    return counts.select(F.explode(per_rule).alias("r")).select("r.*")


def judged(rows: DataFrame, policy: Policy, rules: Mapping[str, str] = RULES) -> DataFrame:
    """A written ledger with the verdict of a policy (``kept``) and what each rejection hangs on.

    ``only_rule`` names the rule of the policy that alone rejects a document, null for
    others; ``kept_without`` is the number of documents the policy would keep without it.
    """
    bits = {r: F.lit(1 << list(rules).index(r)).cast("bigint") for r in policy.rules}
    failed = F.col("failed").bitwiseAND(F.lit(policy.mask(rules)).cast("bigint"))
    only = F.coalesce(*(F.when(failed == b, F.lit(r)) for r, b in bits.items()))
    # one row per rule
    without = F.broadcast(ablations(rows, policy, rules).select(F.col("rule").alias("only_rule"), "kept_without"))
    return rows.withColumns({"kept": passes(policy, rules), "only_rule": only}).join(without, "only_rule", "left")


def kept_documents(docs: DataFrame, policy: Policy = PRODUCTION) -> DataFrame:
    """The rows of ``docs`` that pass the policy, with exactly their columns.

    Their ledger is written with the rows, and the policy reads it from there.
    """
    measured = with_measures(docs.select(as_struct(docs).alias("_row"), "text")).drop("text")
    rows = stage(measured.withColumn("failed", failure_bits()), "quality-ledger")
    return rows.filter(passes(policy)).select("_row.*")
