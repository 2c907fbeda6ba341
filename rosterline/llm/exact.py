"""Exact duplicates by progressive refinement: length, then hash of a prefix, then hash of the whole.

Texts are equal when they are identical after lowering A-Z. The lengths that several rows share are found first;
among their rows, the prefixes that several share; and only those rows are grouped by the hash of the whole text.
DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import ascii_lower, materialize, row_of, without_rows

PREFIX = 128


def normal(text: str) -> Column:
    """The text as it is compared; null counts as empty."""
    return ascii_lower(F.coalesce(F.col(text), F.lit("")))


def _shared(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """The key values of two or more rows."""
    return materialize(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(*keys), name)


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest key stays (nulls are smallest); of several with that key, one. The digest
    that each row reports is taken while its length and prefix are read, so texts are read once; groups are formed
    from the small table of digests. A group's size and winner are partial aggregates, and a group that holds many
    rows is split where it is joined back."""
    t = F.col("_t")
    digests = docs.select(F.col(key).alias("doc_id"), normal(text).alias("_t")).select(
        "doc_id", F.octet_length(t).alias("_len"), F.xxhash64(F.substring(t, 1, PREFIX)).alias("_pre"),
        F.sha2(t, 256).alias("text_sha256"), F.monotonically_increasing_id().alias("_row"))
    rows = materialize(digests, "digests")
    by_length = rows.join(_shared(rows, ["_len"], "lengths"), "_len", "left_semi")
    prefixes = _shared(by_length, ["_len", "_pre"], "prefixes")
    left = rows.join(prefixes, ["_len", "_pre"], "left_semi")
    winner = F.max(F.struct("doc_id", "_row"))
    groups = materialize(left.groupBy("text_sha256").agg(F.count(F.lit(1)).alias("_n"), winner.alias("_top"))
                         .filter("_n > 1"), "groups")
    many = F.col("_n").isNotNull()
    return rows.join(groups, "text_sha256", "left").select(
        "doc_id", F.when(many, F.col("_top.doc_id")).otherwise(F.col("doc_id")).alias("keep_id"),
        F.coalesce("_n", F.lit(1)).cast("long").alias("group_size"),
        (~many | (F.col("_top._row") == F.col("_row"))).alias("kept"), "text_sha256")


def drop_exact(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs that stay, with all their columns. Rows that share text and key can't be told apart by
    either; of those, the one with the largest values in the other columns stays."""
    found = materialize(exact_groups(docs, key, text).filter("group_size > 1"), "copies")
    keys = [F.col(f"`{key}`"), F.sha2(normal(text), 256)]
    names = ["doc_id", "text_sha256"]
    gone = found.filter("NOT kept").select(*names).distinct()
    twice = materialize(found.groupBy(*names).agg(F.max("kept").alias("_k"), F.count(F.lit(1)).alias("_n"))
                        .filter("_k AND _n > 1").select(*names), "repeats")
    rest = without_rows(docs, keys, without_rows(gone, [F.col(n) for n in names], twice))
    if not twice.limit(1).count():
        return rest
    marked = rest.select(row_of(rest), *[k.alias(f"_q{i}") for i, k in enumerate(keys)])
    cond = marked["_q0"].eqNullSafe(twice["doc_id"]) & (marked["_q1"] == twice["text_sha256"])
    again = marked.join(twice, cond, "left_semi").groupBy("_q0", "_q1").agg(F.max("_row").alias("_row")).select("_row.*")
    return without_rows(rest, keys, twice).unionByName(again)
