"""Quality rules as a ledger: every rule is evaluated once, its failure is a bit, its measurements are columns.

A policy names a version and the rules it enforces, as a mask over the bits, so that verdicts under several policies,
and what leaving out a rule would change, follow from the ledger without the texts. DataFrame functions only.

Words are runs of [^\\x20\\x09-\\x0D]. A null or empty text has no words and fails `too_short`. Repeated windows of three
words are found by their 64-bit hashes within one text."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .common import SPACES, row_of

SYMBOLS = "[#*$%&|<>]"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]

#: Name and condition on the measurements; the bit is the place in the list. Append only.
RULES: list[tuple[str, str]] = [
    ("too_short", "n_words < 50"),
    ("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    ("word_length", "word_chars < 2 * n_words OR word_chars > 25 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("repeated_lines", "100 * n_dup_lines > 50 * n_lines"),
]
BITS = {name: 1 << i for i, (name, _) in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    """The rules that a version enforces."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BITS[r] for r in self.rules)


BASE = Policy("base", ("too_short", "repeated_windows"))
POLICIES = {p.version: p for p in (
    BASE, Policy("1", (*BASE.rules, "symbols")), Policy("2", tuple(BITS)))}
CURRENT = POLICIES["2"]


def measured(docs: DataFrame, keep: Sequence[str], text: str = "text") -> DataFrame:
    """The kept columns and MEASURES (long). Each step is a projection of its own, so that arrays are made once."""
    filled = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    flat = F.translate(filled, SPACES, " " * len(SPACES))
    own = [F.col(f"`{c}`") for c in keep]
    lines = F.filter(F.split(filled, "\n", -1), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    parts = docs.select(*own, F.split(flat, " ", -1).alias("_p"), F.char_length(filled).alias("_chars"),
                        F.regexp_count(filled, F.lit(SYMBOLS)).alias("n_symbols"), lines.alias("_l"))
    words = parts.select(*own, "n_symbols", F.array_remove("_p", "").alias("_w"),
                         (F.col("_chars") - F.size("_p") + 1).alias("word_chars"),
                         F.size("_l").alias("n_lines"),
                         (F.size("_l") - F.size(F.array_distinct("_l"))).alias("n_dup_lines"))
    w, n = F.col("_w"), F.size("_w")
    none = F.array().cast("array<bigint>")
    grams = F.when(n >= 3, F.transform(
        F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))).otherwise(none)
    rest = [*own, "n_symbols", "word_chars", "n_lines", "n_dup_lines"]
    hashed = words.select(*rest, n.alias("n_words"), grams.alias("_g"))
    # Places by hash, where any hash occurs twice; then those that equal a neighbour, in the order of the text.
    g = F.col("_g")
    twice = F.size(F.array_distinct(g)) < F.size(g)
    placed = F.when(twice, F.sort_array(F.arrays_zip(g.alias("h"), F.sequence(F.lit(0), F.size(g) - 1).alias("i"))))
    rest += ["n_words"]
    ranked = hashed.select(*rest, placed.alias("_s"))
    s = F.col("_s")

    def equal_neighbour(x: Column, i: Column) -> Column:
        return (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"])

    found = F.sort_array(F.transform(F.filter(s, lambda x, i: F.coalesce(equal_neighbour(x, i), F.lit(False))),
                                     lambda x: x["i"]))
    windows = ranked.select(*rest, found.alias("_i"))
    at = F.col("_i")
    covered = F.when(F.size(at) > 0, F.aggregate(
        F.sequence(F.lit(0), F.size(at) - 1), F.lit(0),
        lambda total, k: total + F.least(F.lit(3), F.coalesce(F.get(at, k + 1) - F.get(at, k), F.lit(3)))))
    # As a generated row: a condition on the measurements is not moved down into the steps that make them.
    long = [F.col(c).cast("long").alias(c) for c in MEASURES if c != "n_repeat_words"]
    return windows.select(*own, F.inline(F.array(F.struct(
        *long, F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words")))))


def ledger(docs: DataFrame, keep: Sequence[str], text: str = "text") -> DataFrame:
    """measured() and `failures`, a bit for each rule that fails."""
    bits = sum((F.when(F.expr(rule), F.lit(BITS[name])).otherwise(F.lit(0)) for name, rule in RULES), F.lit(0))
    return measured(docs, keep, text).withColumn("failures", bits.cast("long"))


def passes(policy: Policy, failures: str = "failures") -> Column:
    return F.col(failures).bitwiseAND(F.lit(policy.mask)) == 0


def ablation(rows: DataFrame, policy: Policy) -> DataFrame:
    """Per rule of the policy: how many rows fail it, and how many would be kept if it alone were left out. Rows are
    first counted by their failure bits, of which there are 2^rules at most."""
    counts = rows.groupBy(F.col("failures").bitwiseAND(F.lit(policy.mask)).alias("f")).agg(F.count(F.lit(1)).alias("n"))
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(BITS[r]).cast("long").alias("bit")) for r in policy.rules])
    f, bit = F.col("f"), F.col("r.bit")
    return counts.select("f", "n", F.explode(rules).alias("r")).groupBy(F.col("r.rule").alias("rule")).agg(
        F.sum(F.when(f.bitwiseAND(bit) != 0, F.col("n")).otherwise(0)).alias("failed"),
        F.sum(F.when(f == bit, F.col("n")).otherwise(0)).alias("failed_alone"),
        F.sum("n").alias("rows"))


def verdicts(docs: DataFrame, key: str = "doc_id", text: str = "text", policy: Policy = CURRENT) -> DataFrame:
    """One row per document: key, measurements, failures, base_failed, kept."""
    rows = ledger(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), ["doc_id"])
    return rows.withColumns({"base_failed": ~passes(BASE), "kept": passes(BASE) & passes(policy)})


def keep_good(docs: DataFrame, text: str = "text", policy: Policy = CURRENT) -> DataFrame:
    """The rows that pass, with their columns."""
    whole = docs.select(row_of(docs), F.col(f"`{text}`").alias("_text"))
    return ledger(whole, ["_row"], "_text").filter(passes(BASE) & passes(policy)).select("_row.*")
