"""Shard numbers by jump consistent hashing (Lamping and Veach, 2014): no ring table, and one more shard takes
rows only into itself.

The shard of a row follows from its key and the number of shards alone. Null keys share one shard. Rows with equal
keys share a shard by definition; their slots are still dealt out over many tasks."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from ..session import rank_buckets
from .common import materialize


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard 0..shards-1 of each 64-bit key."""
    if shards < 1:
        raise ValueError("there must be a shard at least")
    key = keys.astype(np.uint64, copy=True)
    at = np.zeros(len(key), np.int64)  # the shard before the last jump
    to = np.zeros(len(key), np.int64)
    open_ = np.arange(len(key))
    while len(open_):
        at[open_] = to[open_]
        key[open_] = key[open_] * np.uint64(2862933555777941757) + np.uint64(1)
        step = float(1 << 31) / ((key[open_] >> np.uint64(33)).astype(np.float64) + 1.0)
        to[open_] = ((at[open_] + 1) * step).astype(np.int64)
        open_ = open_[to[open_] < shards]
    return at.astype(np.int32)


def shard_of(shards: int):
    """A column function: hash of the key -> shard."""
    @F.pandas_udf("int")
    def of(h: pd.Series) -> pd.Series:
        return pd.Series(jump(h.to_numpy().view(np.uint64), shards))
    return of


def assign_shards(df: DataFrame, keys: Sequence[str], shards: int, name: str = "shard") -> DataFrame:
    """Adds the shard of each row by its key columns of any type."""
    return df.withColumn(name, shard_of(shards)(F.xxhash64(*[F.col(f"`{k}`") for k in keys])))


def number_in_shard(df: DataFrame, shard: str, row: str, name: str = "slot") -> DataFrame:
    """Adds gapless numbers from 0 within each shard. row is a unique long of a written table. Rows are dealt out
    over hash buckets of it, numbered there, and moved up by what the buckets before hold, so no task gets a shard.
    The table of bucket sizes has shards x buckets rows at most, whatever the input, and is broadcast."""
    buckets = rank_buckets(df.sparkSession)
    dealt = df.withColumn("_b", F.pmod(F.xxhash64(row), F.lit(buckets)).cast("int"))
    before = Window.partitionBy(shard).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy(shard, "_b").agg(F.count(F.lit(1)).alias("_n")) \
        .select(shard, "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(shard, "_b").orderBy(row)
    return dealt.withColumn("_i", F.row_number().over(inside)).join(F.broadcast(sizes), [shard, "_b"]) \
        .withColumn(name, F.col("_i") + F.col("_before") - 1).drop("_b", "_i", "_before")


def shard_table(docs: DataFrame, shards: int = 16, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, size (UTF-8 bytes of the text plus 1), text_crc32, law, shard, slot and
    grown_shard, the shard if there were one more. A null text has size 1 and the checksum of the empty string; other
    columns of docs are left out."""
    filled = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("doc_id"), (F.octet_length(filled) + 1).cast("long").alias("size"),
                       F.crc32(filled.cast("binary")).alias("text_crc32"),
                       F.monotonically_increasing_id().alias("_row"))
    placed = materialize(assign_shards(assign_shards(rows, ["doc_id"], shards), ["doc_id"], shards + 1, "grown_shard"),
                         "shards")
    return number_in_shard(placed, "shard", "_row").select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        "grown_shard")


def write_shards(docs: DataFrame, path: str, keys: Sequence[str], shards: int, files: int = 1) -> str:
    """Write the rows as Parquet, a folder per shard with up to `files` files, so that one shard is not one task. Gives
    the name of the folders' column: `shard`, or the first of `shard_1`, `shard_2` and so on that no column of docs has in any
    case, so all columns of docs are kept."""
    taken = {c.lower() for c in docs.columns}
    name, n = "shard", 0
    while name in taken:
        n += 1
        name = f"shard_{n}"
    spread = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(files))
    assign_shards(docs, keys, shards, name).repartition(shards * files, name, spread) \
        .write.partitionBy(name).parquet(path)
    return name
