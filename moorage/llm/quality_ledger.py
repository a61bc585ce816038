"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger stores the measurements
and one failure bit per rule; policies are masks over those bits, so a new
policy version or an ablation never reads a text again.

Defined results: a null text counts as an empty one; an empty text has zero
for all measurements and fails the rule for short texts; repeated rows are
judged each for itself; null ids are carried along; an empty table gives an
empty ledger; columns other than the id and the text are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moorage.llm.common import blank_words, map_rows

BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long, "
    "n_chars long, longest_word long"
)

#: Rule by rule, in the order of its bit: the condition under which a document fails.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "5 * n_symbols > word_chars",
    "repeated_lines": "2 * n_dup_lines > n_lines",
    "long_words": "word_chars > 25 * n_words",
    "one_huge_word": "2 * longest_word > n_chars",
}

#: Policies by version: the rules whose failure rejects a document.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_words"),
    "2": ("few_words", "repeated_words", "symbols", "repeated_lines"),
    "3": tuple(RULES),
}


def repeat_words(words: list[bytes]) -> int:
    """Words inside a three-word window that occurs twice or more, its first place included."""
    windows = list(zip(words, words[1:], words[2:]))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    covered, end = 0, 0
    for place, window in enumerate(windows):
        if counts[window] > 1:
            covered += place + 3 - max(place, end)
            end = place + 3
    return covered


def measure(text: str | None) -> tuple[int, ...]:
    """The measurements of one text, in the order of ``MEASURES``."""
    text = text or ""
    words = blank_words(text)
    lines = [line for line in text.encode().split(b"\n") if line.strip()]
    return (
        len(words),
        len(text) - sum(map(text.count, BLANKS)),
        sum(map(text.count, SYMBOLS)),
        len(lines),
        len(lines) - len(set(lines)),
        repeat_words(words),
        len(text),
        max(map(len, words), default=0),
    )


def ledger(docs: DataFrame, rules: Mapping[str, str] = RULES, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, measurements, and ``failed``: bit ``i`` is set if rule ``i`` fails."""
    kind = docs.schema[key].dataType.simpleString()
    measured = map_rows(docs, [key, text], lambda k, t: (k, *measure(t)), f"`{key}` {kind}, {MEASURES}")
    bits = [F.when(F.expr(rule), F.lit(1 << bit)).otherwise(0) for bit, rule in enumerate(rules.values())]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return measured.withColumn("failed", failed.cast("long"))


def mask(policy: str, rules: Mapping[str, str] = RULES) -> int:
    """The bits that a policy rejects."""
    names = list(rules)
    return sum(1 << names.index(rule) for rule in POLICIES[policy])


def verdict(policy: str, failed: str = "failed") -> Column:
    """True where no rule of the policy failed."""
    return F.col(failed).bitwiseAND(F.lit(mask(policy))) == 0


def ablations(book: DataFrame, policy: str) -> DataFrame:
    """Per rule of a policy: documents that fail it, and documents that only this rule rejects.

    One pass over the ledger; each task sends two counts per rule.
    """
    names, rejected = list(RULES), F.col("failed").bitwiseAND(F.lit(mask(policy)))
    sums = []
    for rule in POLICIES[policy]:
        bit = 1 << names.index(rule)
        sums += [
            F.count_if(rejected.bitwiseAND(F.lit(bit)) != 0).alias(f"{rule}_failed"),
            F.count_if(rejected == bit).alias(f"{rule}_only"),
        ]
    flat = book.agg(F.count_if(rejected != 0).alias("rejected"), *sums)
    rows = [
        F.struct(
            F.lit(rule).alias("rule"), F.col(f"{rule}_failed").alias("n_failed"), F.col(f"{rule}_only").alias("n_only"),
            F.col("rejected").alias("n_rejected"),
        )
        for rule in POLICIES[policy]
    ]
    return flat.select(F.inline(F.array(*rows)))
