"""Quality rules as a ledger of bits.

Every document is measured once and every rule evaluated once: the ledger holds the measurements and
one bit per failed rule. Policies are versions of a mask over these bits, so another policy, or the
effect of leaving a rule out, is read off the ledger and no text is touched again.

All of it is per-row array functions of the JVM; nothing is shuffled to measure a document, so one
source or one passage may be as frequent as it likes. A text has to fit a row, as it does in its table.

Defined results: a null text has no words and fails ``few_words``. Repeated rows each have their
ledger row. Other columns of the documents are not looked at, whatever their names. 8-word windows
are told apart by a 64-bit hash within one document.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treeledger.llm.text import LOWER, UPPER, let, text_of, words

WINDOW = 8
SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Rule:
    bit: int
    name: str
    fails: str  # an expression over the measurements


@dataclass(frozen=True)
class Policy:
    """A document is kept if it fails none of ``rules``."""

    version: str
    rules: tuple[str, ...]


RULES = (
    Rule(0, "few_words", "n_words < 20"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    Rule(2, "symbols", "100 * n_symbols > 20 * n_words"),
    Rule(3, "capitals", "100 * n_capitals > 50 * word_chars"),
    Rule(4, "repeated_lines", "100 * n_dup_lines > 50 * n_lines"),
    Rule(5, "word_length", "word_chars < 2 * n_words or word_chars > 20 * n_words"),
)
BASE = Policy("base", ("few_words", "repeated_windows"))
CURRENT = Policy("2", ("few_words", "repeated_windows", "symbols", "capitals", "repeated_lines", "word_length"))


def _removed(text: Column, characters: str) -> Column:
    """How many of these characters the text has."""
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("bigint")


def _windows(hashes: Column) -> Column:
    """A hash of every run of WINDOW words, by position."""
    count = F.size(hashes) - WINDOW + 1
    each = F.transform(
        F.sequence(F.lit(0), count - 1),
        lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)]),
    )
    return F.when(count > 0, each).otherwise(F.array().cast("array<bigint>"))


def _covered(windows: Column) -> Column:
    """Words inside windows that occur twice or more: equal windows stand side by side once sorted,
    and their positions, in order, add what the last one has not covered."""
    def repeated(s):
        return F.transform(
            F.filter(
                s,
                lambda x, i: F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False))
                | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)),
            ),
            lambda x: x["p"],
        )

    places = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("p")))
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-WINDOW).alias("last"))
    return F.aggregate(
        F.sort_array(let(F.sort_array(places), repeated)),
        start,
        lambda acc, p: F.struct(
            (acc["n"] + F.least(F.lit(WINDOW), p - acc["last"])).alias("n"), p.alias("last")
        ),
        lambda acc: acc["n"],
    )


def measure(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_capitals)``."""
    body = F.col("_text")
    rows = docs.select(F.col(key), text_of(text).alias("_text"))
    rows = rows.select(
        key, "_text",
        F.transform(words(body), lambda w: F.xxhash64(w)).alias("_hashes"),
        F.filter(F.split(body, "\n"), lambda line: F.translate(line, WHITE, "") != "").alias("_lines"),
    )
    rows = rows.withColumn("_windows", _windows(F.col("_hashes")))
    windows = F.col("_windows")
    return rows.select(
        key,
        F.size("_hashes").cast("bigint").alias("n_words"),
        F.length(F.translate(body, WHITE, "")).cast("bigint").alias("word_chars"),
        _removed(body, SYMBOLS).alias("n_symbols"),
        F.size("_lines").cast("bigint").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        F.when(F.size(F.array_distinct(windows)) < F.size(windows), _covered(windows))
        .otherwise(F.lit(0).cast("bigint")).alias("n_repeat_words"),
        _removed(body, UPPER).alias("n_capitals"),
    )


def build_ledger(docs: DataFrame, key: str = "doc_id", text: str = "text", rules=RULES) -> DataFrame:
    """The measurements and ``failed``, the bits of all rules that fail."""
    failed = F.lit(0).cast("bigint")
    for rule in rules:
        bit = F.when(F.expr(rule.fails), F.lit(1 << rule.bit)).otherwise(F.lit(0)).cast("bigint")
        failed = failed.bitwiseOR(bit)
    return measure(docs, key, text).withColumn("failed", failed)


def mask(policy: Policy, rules=RULES) -> int:
    bits = {r.name: 1 << r.bit for r in rules}
    return sum(bits[name] for name in policy.rules)


def passes(policy: Policy, rules=RULES) -> Column:
    return F.col("failed").bitwiseAND(F.lit(mask(policy, rules)).cast("bigint")) == 0


def ablate(ledger: DataFrame, policies=(BASE, CURRENT), rules=RULES) -> DataFrame:
    """For each policy and each of its rules: documents that fail it, that fail it alone, and that the
    policy keeps without it. Ledger rows are first counted by their bits, of which there are at most
    2 to the number of rules."""
    counted = ledger.groupBy("failed").agg(F.count(F.lit(1)).alias("docs"))
    bits = {r.name: 1 << r.bit for r in rules}
    cases = [
        F.struct(
            F.lit(p.version).alias("policy"), F.lit(name).alias("rule"),
            F.lit(bits[name]).cast("bigint").alias("bit"), F.lit(mask(p, rules)).cast("bigint").alias("mask"),
        )
        for p in policies for name in p.rules
    ]
    hit = F.col("failed").bitwiseAND(F.col("mask"))
    without = hit.bitwiseAND(F.bitwise_not(F.col("bit")))
    return (
        counted.select("failed", "docs", F.inline(F.array(*cases)))
        .groupBy("policy", "rule")
        .agg(
            F.sum(F.when(hit.bitwiseAND(F.col("bit")) != 0, F.col("docs")).otherwise(0)).alias("failing"),
            F.sum(F.when(hit == F.col("bit"), F.col("docs")).otherwise(0)).alias("only_this"),
            F.sum(F.when(without == 0, F.col("docs")).otherwise(0)).alias("kept_without"),
            F.bit_or(F.col("failed")).alias("bits_seen"),
        )
    )
