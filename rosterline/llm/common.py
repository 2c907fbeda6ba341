"""What the text operators share: the input, written intermediate tables, text normal forms, connected components."""

from __future__ import annotations

import contextlib
import string
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import scratch_path

UPPER, LOWER = string.ascii_uppercase, string.ascii_lowercase
SPACES = "\t\n\x0b\x0c\r"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def tokenizer_file(name: str) -> str:
    """Place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


_passing: list[str] | None = None  # tables written in a passing() block


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: later steps neither recompute it nor depend on an
    executor, and its size is known to the planner."""
    path = scratch_path(df.sparkSession, name)
    if _passing is not None:
        _passing.append(path)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written = path
    return out


@contextlib.contextmanager
def passing(spark: SparkSession, keep: Sequence[str] = (), last: DataFrame | None = None) -> Iterator[None]:
    """Tables that the block writes, but for those of the names to keep, and a kept one that the block is the last to read, are deleted at its end, and so are the shuffle files of plans that nothing
    holds any more: Spark deletes those when the driver's garbage is collected, which may be after the query. Blocks don't overlap."""
    global _passing
    _passing = [] if last is None else [last._written]
    try:
        yield
    finally:
        paths, _passing = [p for p in _passing if p.rsplit("/", 1)[1].rsplit("-", 1)[0] not in keep], None
        jvm = spark._jvm
        for path in map(jvm.org.apache.hadoop.fs.Path, paths):
            path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
        jvm.System.gc()


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def text_keys(text: str) -> list[Column]:
    """Two independent 64-bit hashes of a text (null counts as empty): rows with equal texts, and only those, share
    both but for a chance of 2^-128 a pair."""
    filled = F.coalesce(F.col(text), F.lit(""))
    return [F.xxhash64(filled).alias("_k1"), F.xxhash64(F.lit(1), filled).alias("_k2")]


def row_of(docs: DataFrame) -> Column:
    """The whole row as one column `_row`, next to which other columns can have any name."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")


def without_rows(docs: DataFrame, keys: Sequence[Column], dropped: DataFrame) -> DataFrame:
    """The rows of docs whose keys aren't among the dropped; dropped has a column per key, in that order. Null keys
    compare as equal. Always by shuffle: dropped grows with docs, and the plan that is tried on a small table is the
    one that runs on a large one."""
    names = [f"_d{i}" for i in range(len(keys))]
    gone = dropped.toDF(*names).hint("merge")
    marked = docs.select(row_of(docs), *[k.alias(f"_q{i}") for i, k in enumerate(keys)])
    cond = [marked[f"_q{i}"].eqNullSafe(gone[n]) for i, n in enumerate(names)]
    return marked.join(gone, cond, "left_anti").select("_row.*")


def one_row_each(docs: DataFrame, keys: Sequence[Column], repeated: DataFrame) -> DataFrame:
    """docs with one row for each of the repeated keys, the one with the largest values in all columns. repeated has a
    column per key, in that order. Null keys compare as equal."""
    if not repeated.limit(1).count():
        return docs
    names = [f"_d{i}" for i in range(len(keys))]
    twice = repeated.toDF(*names)
    marked = docs.select(row_of(docs), *[k.alias(f"_q{i}") for i, k in enumerate(keys)])
    cond = [marked[f"_q{i}"].eqNullSafe(twice[n]) for i, n in enumerate(names)]
    again = marked.join(twice.hint("merge"), cond, "left_semi").groupBy(*[f"_q{i}" for i in range(len(keys))]) \
        .agg(F.max("_row").alias("_row")).select("_row.*")
    return without_rows(docs, keys, repeated).unionByName(again)


def spread_join(left: DataFrame, right: DataFrame, keys: Sequence[str], many: str, how: str = "left", most: int = 1000,
                salts: int = 64) -> DataFrame:
    """left joined with right, a written table with one row per key and a column `many`, the number of left's rows that
    will meet it, which is left out. how: left or inner. Keys with more than `most` are copied to salts, over which
    left's rows are dealt, so no task gets all rows of one key. The copies are a small share of left, as each stands for
    `most` rows."""
    more = [c for c in right.columns if c not in keys and c != many]
    light = right.filter(F.col(many) <= most).select(*keys, *more).hint("merge")
    heavy = right.filter(F.col(many) > most)
    if not heavy.limit(1).count():
        return left.join(light, list(keys), how).select(*left.columns, *more)
    copies = heavy.select(*keys, *more, F.lit(True).alias("_met"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"))
    salt = F.pmod(F.xxhash64(*left.columns), F.lit(salts)).cast("int")
    first = left.withColumn("_salt", salt).join(copies.hint("merge"), [*keys, "_salt"], "left").select(*left.columns, *more, "_met")
    first = materialize(first, "spread")
    rest = first.filter("_met IS NULL").select(*left.columns).join(light, list(keys), how).select(*left.columns, *more)
    return first.filter("_met").select(*left.columns, *more).union(rest)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, label): the smallest node reachable. edges has long columns a and b.

    Each round every node hooks onto its smallest neighbour if that is smaller, hooks are followed one step on, and
    the links are redrawn between the nodes hooked onto, without those that have become one. So the links shrink round
    by round. Tables are written each round; the driver learns whether links are left, and nothing else."""
    live = materialize(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                       .filter("a < b").distinct(), "links")
    labels = None
    for _ in range(max_rounds):
        both = live.union(live.select("b", "a"))
        hook = materialize(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("to"))
                           .select("node", F.least("node", "to").alias("to")), "hooks")
        onward = hook.select(F.col("node").alias("to"), F.col("to").alias("far"))
        jump = materialize(hook.join(onward, "to").select("node", F.col("far").alias("to")), "jumps")
        if labels is None:
            labels = jump.select("node", F.col("to").alias("label"))
        else:
            on = jump.select(F.col("node").alias("label"), "to")
            labels = labels.join(on, "label", "left").select("node", F.coalesce("to", "label").alias("label"))
        ends = [jump.select(F.col("node").alias(c), F.col("to").alias(f"_{c}")) for c in "ab"]
        live = materialize(live.join(ends[0], "a").join(ends[1], "b").filter("_a != _b")
                           .select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct(), "links")
        if not live.limit(1).count():
            return labels
        labels = materialize(labels, "labels")
    raise RuntimeError(f"links are left after {max_rounds} rounds")
