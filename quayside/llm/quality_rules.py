"""Quality rules as a bitmask ledger.

Every rule is evaluated once for each document; the ledger keeps one bit for each failed rule beside the measurements. A
policy is a versioned mask over those bits: applying one, comparing two, or asking what each rule alone would change reads
only the ledger, never the texts again.

All of it is built-in expressions on one row: no shuffle, and any text length (a document's arrays are the only state).
Windows of words are compared by a 64-bit hash within one document.

Defined cases: a null or empty text has no words and fails `few_words`; null ids and repeated rows stay as they are; an
empty table gives an empty ledger; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import words

SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5

#: Rules by bit number: name and the condition under which a document fails, over the measurements.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 10"),
    ("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    ("symbols", "10 * n_symbols > word_chars"),
    ("repeated_lines", "n_lines >= 4 and 10 * n_dup_lines > 3 * n_lines"),
    ("short_words", "n_words >= 10 and word_chars < 2 * n_words"),
    ("long_words", "n_words >= 10 and word_chars > 15 * n_words"),
    ("shouting", "n_upper_words >= 10 and 2 * n_upper_words > n_words"),
)
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    """Which failed rules reject a document. The version names it in results."""

    version: str
    rules: tuple[str, ...] = field(default_factory=tuple)

    @property
    def mask(self) -> int:
        return sum(BIT[r] for r in self.rules)


BASE = Policy("base", ("few_words", "repeated_windows"))
V1 = Policy("v1", tuple(BIT))


def _measure(docs: DataFrame, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The measurements beside the columns named in keep."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    d = docs.select(*keep, text.alias("t"), words("text").alias("w"), lines.alias("ls"))
    d = d.select(*keep, "t", "w", F.size("ls").alias("n_lines"), (F.size("ls") - F.size(F.array_distinct("ls"))).alias("n_dup_lines"), F.size("w").alias("n_words"))
    hashes = F.when(
        F.col("n_words") >= WINDOW,
        F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.col("n_words") - (WINDOW - 1))), lambda i: F.xxhash64(F.slice("w", i, F.lit(WINDOW)))),
    ).otherwise(F.array().cast("array<bigint>"))
    d = d.select(
        *keep,
        "n_lines",
        "n_dup_lines",
        "n_words",
        F.aggregate("w", F.lit(0).cast("long"), lambda a, x: a + F.char_length(x)).alias("word_chars"),
        F.regexp_count("t", F.lit(SYMBOLS)).alias("n_symbols"),
        F.size(F.filter("w", lambda x: (F.char_length(x) >= 2) & (F.upper(x) == x) & (F.lower(x) != x))).alias("n_upper_words"),
        hashes.alias("h"),
    )
    # Sorting is only worth its time where some window is there twice.
    repeats = F.size("h") != F.size(F.array_distinct("h"))
    pairs = F.when(repeats, F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))
    d = d.withColumn("p", pairs).drop("h")

    def twin(x: Column, j: Column) -> Column:
        near = lambda k: F.coalesce(F.get("p", k)["h"] == x["h"], F.lit(False))
        return near(j - 1) | near(j + 1)

    d = d.withColumn("p", F.sort_array(F.transform(F.filter("p", twin), lambda x: x["i"])))
    covered = F.transform("p", lambda x, j: F.coalesce(F.least(F.lit(WINDOW), F.get("p", j + 1) - x), F.lit(WINDOW)).cast("long"))
    return d.withColumn("n_repeat_words", F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x)).drop("p")


def _failed(rules: tuple[tuple[str, str], ...]) -> Column:
    failed = F.lit(0)
    for i, (_, cond) in enumerate(rules):
        failed = failed.bitwiseOR(F.when(F.expr(cond), F.lit(1 << i)).otherwise(F.lit(0)))
    return failed.cast("long")


def ledger(docs: DataFrame, rules: tuple[tuple[str, str], ...] = RULES) -> DataFrame:
    """doc_id, the measurements (long), and failed: bit i is set if rule i fails."""
    measured = _measure(docs)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper_words")
    return measured.select("doc_id", *(F.col(n).cast("long").alias(n) for n in names), _failed(rules).alias("failed"))


def apply_policy(led: DataFrame, policy: Policy, out: str = "kept") -> DataFrame:
    return led.withColumn(out, F.col("failed").bitwiseAND(F.lit(policy.mask)) == 0)


def ablations(led: DataFrame, policy: Policy) -> DataFrame:
    """For each rule of the policy: documents failing it, failing it alone (they return if it is dropped), and kept without it.

    One aggregate over the ledger's bits; a row for each rule."""
    m = F.col("failed").bitwiseAND(F.lit(policy.mask))
    sums = [F.count(F.lit(1)).alias("n")]
    for r in policy.rules:
        sums += [F.count_if(m.bitwiseAND(F.lit(BIT[r])) != 0).alias(f"any_{r}"), F.count_if(m == BIT[r]).alias(f"only_{r}"), F.count_if(m.bitwiseAND(F.lit(policy.mask & ~BIT[r])) == 0).alias(f"kept_{r}")]
    one = led.agg(*sums)
    rows = [F.struct(F.lit(r).alias("rule"), F.col(f"any_{r}").alias("failing"), F.col(f"only_{r}").alias("failing_alone"), F.col(f"kept_{r}").alias("kept_without")) for r in policy.rules]
    return one.select(F.lit(policy.version).alias("policy"), "n", F.inline(F.array(*rows)))


def compare_policies(led: DataFrame, policies: Mapping[str, Policy]) -> DataFrame:
    """Kept documents under each policy, from one pass over the ledger."""
    aggs = [F.count_if(F.col("failed").bitwiseAND(F.lit(p.mask)) == 0).alias(k) for k, p in policies.items()]
    return led.agg(F.count(F.lit(1)).alias("n"), *aggs)


def kept_documents(docs: DataFrame, policy: Policy = V1) -> DataFrame:
    """The rows of docs, with their own columns, that fail no rule of the policy."""
    own = [f"_d_{i}" for i in range(len(docs.columns))]
    d = docs.select("text", *[F.col(c).alias(o) for c, o in zip(docs.columns, own, strict=True)])
    # The partition number keeps the filter above the measurements: pushed below, each would be spelt out anew in every rule.
    d = _measure(d, own).select(*own, _failed(RULES).alias("_failed"), F.spark_partition_id().alias("_part"))
    d = d.where((F.col("_failed").bitwiseAND(F.lit(policy.mask)) == 0) & (F.col("_part") >= 0))
    return d.select(*[F.col(o).alias(c) for c, o in zip(docs.columns, own, strict=True)])


def quality_query(docs: DataFrame, policy: Policy = V1) -> DataFrame:
    led = apply_policy(ledger(docs), policy)
    led = led.withColumn("base_failed", F.col("failed").bitwiseAND(F.lit(BASE.mask)) != 0)
    return led.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & F.col("kept")).alias("kept"), "failed", "n_lines", "n_upper_words")
