"""From raw documents to packed training sequences: STAGES, each a function of (spark, docs, sf_dir), and run().

run() writes what each stage returns as Parquet in the shared folder and gives the next stage what it reads there. All
stages but the last return the columns of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rosterline.llm import exact, packing, pii, quality, simhash
from rosterline.llm.common import documents, materialize, one_row_each, text_keys, without_rows


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy of quality rules keeps."""
    return quality.keep_good(docs)


def unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id."""
    return exact.drop_exact(docs)


def distinct_enough(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts whose SimHash fingerprints of four-word shingles are linked by at most 4 differing bits, the
    row with the smallest doc_id (nulls are largest); of several with that, the one whose text has the smallest hash; of
    rows that share both, the one with the largest other columns."""
    names = ["doc_id", "_k1", "_k2"]
    rows = simhash.with_fingerprint(docs.select("doc_id", *text_keys("text"), "text"), names)
    grouped = materialize(simhash.near_groups(materialize(rows, "fingerprints"), "doc_id"), "near")
    own = F.struct(F.col("doc_id").isNull().alias("none"), *names)
    first = grouped.groupBy("label").agg(F.min(own).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    several = materialize(grouped.join(first, "label").select(*names, own.eqNullSafe(F.col("first")).alias("kept")), "several")
    gone = materialize(several.filter("NOT kept").select(*names).distinct(), "gone")
    twice = materialize(several.filter("kept").groupBy(*names).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
                        .select(*names), "repeats")
    keys = [F.col("doc_id"), *text_keys("text")]
    return one_row_each(without_rows(docs, keys, gone), keys, twice)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of a document and its place in a sequence."""
    return packing.packed_pieces(docs, hold=False)


STAGES = [("quality rules", good), ("exact dedup", unique), ("SimHash near-dedup", distinct_enough),
          ("PII", private), ("packing", packed)]

ORACLE_SQL = None  # fingerprints, contexts and tokens are beyond SQL; tests/llm has brute force for each


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
