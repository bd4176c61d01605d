"""Quality rules as a ledger: every rule is evaluated once per document, the
failures are bits of one integer beside the measurements, and any number of
policies is applied to the ledger afterwards without reading a text again.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftframe.llm.common import append_column, texts_of, with_outputs

SYMBOLS = b"#*$%&|<>"
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_alpha_words", "n_upper_words",
)


def _repeated(words: list[bytes]) -> int:
    """Words in windows of three that occur twice or more, the first included."""
    if len(words) < 4:
        return 0
    windows = list(zip(words, words[1:], words[2:], strict=False))
    found = Counter(windows)
    if len(found) == len(windows):
        return 0
    covered, upto = 0, 0
    for i, w in enumerate(windows):
        if found[w] > 1:
            covered += i + 3 - max(i, upto)
            upto = i + 3
    return covered


def _continued(text: bytes) -> int:
    """Bytes of UTF-8 that continue a code point."""
    return 0 if text.isascii() else len(text) - len(text.decode("utf-8"))


def measure(text: bytes) -> tuple[int, ...]:
    """The values of ``MEASURES`` for one whole text."""
    words = text.split()
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    joined = b"".join(words)
    return (
        len(words),
        len(joined) - _continued(joined),
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines),
        len(lines) - len(set(lines)),
        _repeated(words),
        sum(map(bytes.isalpha, words)) if text.isascii() else sum(w.decode("utf-8").isalpha() for w in words),
        sum(w.isupper() and len(w) > 1 for w in words),
    )


def measured(docs: DataFrame, column: str = "text") -> DataFrame:
    """``docs`` with one long column per measurement. Null and empty texts
    measure zero everywhere; columns of these names are replaced."""
    schema = with_outputs(docs.schema, [T.StructField(m, T.LongType(), False) for m in MEASURES])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = list(zip(*map(measure, texts_of(batch, column)), strict=True)) or [()] * len(MEASURES)
            for name, found in zip(MEASURES, values, strict=True):
                batch = append_column(batch, name, pa.array(found, pa.int64()))
            yield batch

    return docs.mapInArrow(run, schema)


@dataclass(frozen=True)
class Rule:
    """One bit of the ledger: ``fails`` is a condition on the measurements."""

    bit: int
    name: str
    fails: Callable[[], Column]


def _ratio(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(0.0)


# Bits are never reused: a changed rule gets a new one, so old ledgers stay readable.
RULES = (
    Rule(0, "few_words", lambda: F.col("n_words") < 50),
    Rule(1, "repeated_words", lambda: 100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
    Rule(2, "many_words", lambda: F.col("n_words") > 1_000_000),
    Rule(3, "word_length", lambda: ~_ratio("word_chars", "n_words").between(2.0, 20.0)),
    Rule(4, "symbols", lambda: 10 * F.col("n_symbols") > F.col("n_words")),
    Rule(5, "duplicate_lines", lambda: _ratio("n_dup_lines", "n_lines") > 0.3),
    Rule(6, "few_alphabetic", lambda: 100 * F.col("n_alpha_words") < 50 * F.col("n_words")),
    Rule(7, "shouting", lambda: 100 * F.col("n_upper_words") > 50 * F.col("n_words")),
)
BASE = ("few_words", "repeated_words")

# Policies by version: the rules that each enforces.
POLICIES = {
    "base": BASE,
    "2026-1": (*BASE, "many_words", "word_length", "symbols"),
    "2026-2": (*BASE, "many_words", "word_length", "symbols", "duplicate_lines", "few_alphabetic", "shouting"),
}
CURRENT = "2026-2"


def mask_of(names: tuple[str, ...], rules: tuple[Rule, ...] = RULES) -> int:
    bits = {r.name: 1 << r.bit for r in rules}
    return sum(bits[n] for n in set(names))


def ledger(docs: DataFrame, column: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with the measurements and ``failures``: bit b is set where the
    rule of bit b fails. A document without words fails ``few_words``."""
    bits = F.lit(0).cast("long")
    for rule in rules:
        bits = bits.bitwiseOR(F.when(rule.fails(), F.lit(1 << rule.bit)).otherwise(0).cast("long"))
    return measured(docs, column).withColumn("failures", bits)


def passes(policy: str = CURRENT, failures: str = "failures") -> Column:
    """True where no rule of the policy fails."""
    return F.col(failures).bitwiseAND(F.lit(mask_of(POLICIES[policy]))) == 0


def ablations(book: DataFrame, policies: dict[str, tuple[str, ...]] = POLICIES, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per policy and rule: documents failing it, and documents that only it
    removes (kept if the rule went). The ledger is first aggregated to its
    distinct bit patterns, at most 2^rules rows whatever the corpus."""
    patterns = book.groupBy("failures").agg(F.count("*").alias("n"))
    cells = [
        F.struct(F.lit(version).alias("policy"), F.lit(rule.name).alias("rule"), F.lit(mask_of(names, rules)).cast("long").alias("mask"), F.lit(1 << rule.bit).cast("long").alias("bit"))
        for version, names in policies.items()
        for rule in rules
        if rule.name in names
    ]
    rows = patterns.select("failures", "n", F.explode(F.array(*cells)).alias("c")).select("failures", "n", "c.*")
    hit = F.col("failures").bitwiseAND(F.col("mask"))
    return rows.groupBy("policy", "rule").agg(
        F.sum("n").alias("n_docs"),
        F.sum(F.when(hit.bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("n_failing"),
        F.sum(F.when(hit == F.col("bit"), F.col("n")).otherwise(0)).alias("n_only_here"),
        F.sum(F.when(hit == 0, F.col("n")).otherwise(0)).alias("n_kept"),
    )
