"""The prefix trie of rebuilt conversations, by composable fingerprints.

A rebuilt conversation is the head of another one, followed by its own turns after its head. It is never put together: a
turn is known by a reference of 120 bits of the SHA-256 of its role and text, and a sequence of turns by two
products, each a polynomial of its turns' references modulo 2^61 - 1. Products compose: that of a sequence followed by another
follows from both products and the second's length. So the fingerprint of any prefix of a rebuilt conversation is that of the base's head
combined with that of a segment of its own turns, which in turn is the difference of two prefixes.

Rows with equal depth and fingerprint are one node. All must name the same last turn and the same parent; if any don't, the
fingerprints are built anew from other bases. By induction over depths equal nodes then are equal sequences of references.

A conversation may hold most of the turns. Turns are sorted into ranges; products are added up inside a range, and what a
conversation brings from the ranges before it is combined from one product per range. Sums over subtrees are sums over
members: each node's own figure is put on its smallest member, summed from there to the root within blocks of turns."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import materialize, spread_join

PRIME = (1 << 61) - 1
BASES = [(0x1B873593CC9E2D51 % PRIME, 0x5851F42D4C957F2D % PRIME), (0x2545F4914F6CDD1D % PRIME, 0x14057B7EF767814F % PRIME),
         (0x369DEA0F31A53F85 % PRIME, 0x27BB2EE687B0B0FD % PRIME)]  # the second pair onwards: after a collision
HEAD = 8  # turns a head can have at most
GROUP = 5  # a conversation's base is the one whose id is the next multiple below
BLOCK = 4096  # turns of a conversation that are summed in one window
PIECE = 1 << 16  # ids that are joined to one string on the way to a digest


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/conversations.parquet")


def head_length(conv: Column) -> Column:
    """Turns that a rebuilt conversation takes from its base."""
    return (F.crc32(conv.cast("string")) % (HEAD + 1)).cast("int")


def _reference(role: Column, text: Column) -> list[Column]:
    """Two numbers of 60 bits, the digest of a turn."""
    sha = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    return [F.conv(F.substring(sha, at, 15), 16, 10).cast("long").alias(name) for at, name in ((1, "k1"), (16, "k2"))]


def _ordered(talks: DataFrame, bases: tuple[int, int]) -> DataFrame:
    """A row for each turn: conv_id, part (its range), at (its place among the conversation's turns in that range, from 1),
    k1, k2, bytes, and f1, f2, the products of the conversation's turns in the range up to this one."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turns = talks.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", *_reference(role, text),
        F.octet_length(text).cast("long").alias("bytes"))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("k1"), F.col("k2")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        own, at, f1, f2 = None, 0, 0, 0
        for batch in batches:
            places, first, second = [], [], []
            for conv, k1, k2 in zip(*(batch.column(c).to_pylist() for c in (0, 1, 2)), strict=True):
                if conv != own:
                    own, at, f1, f2 = conv, 0, 0, 0
                at += 1
                f1, f2 = (f1 * bases[0] + k1) % PRIME, (f2 * bases[1] + k2) % PRIME
                places.append(at), first.append(f1), second.append(f2)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([part] * len(places), pa.int32()), pa.array(places, pa.int64()), batch.column(1),
                 batch.column(2), batch.column(3), pa.array(first, pa.int64()), pa.array(second, pa.int64())],
                names=["conv_id", "part", "at", "k1", "k2", "bytes", "f1", "f2"])

    return turns.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "k1", "k2", "bytes").mapInArrow(
        run, "conv_id long, part int, at long, k1 long, k2 long, bytes long, f1 long, f2 long")


def _joined(head: tuple[int, ...], tail: tuple[int, ...], length: int, bases: tuple[int, int]) -> tuple[int, ...]:
    """Products of a sequence followed by one of the given length."""
    return tuple((h * pow(b, length, PRIME) + t) % PRIME for h, t, b in zip(head, tail, bases, strict=True))


def _segment(whole: tuple[int, ...], head: tuple[int, ...], length: int, bases: tuple[int, int]) -> tuple[int, ...]:
    """Products of the last `length` of a sequence's elements, from those of all and of the ones before."""
    return tuple((w - h * pow(b, length, PRIME)) % PRIME for w, h, b in zip(whole, head, bases, strict=True))


def _placed(ordered: DataFrame, bases: tuple[int, int]) -> DataFrame:
    """ordered with places and products over the whole conversation. Only a conversation that goes on in another range
    changes; there are at most two per range, so what they bring along is a small dictionary."""
    ends = ordered.groupBy("conv_id", "part").agg(F.max(F.struct("at", "f1", "f2")).alias("end"))
    many = ends.groupBy("conv_id").agg(F.collect_list(F.struct("part", "end")).alias("ends"), F.count(F.lit(1)).alias("n")) \
        .filter("n > 1")
    carried: dict[tuple[int, int], tuple[int, tuple[int, int]]] = {}
    for r in many.collect():
        n, products = 0, (0, 0)
        for part, (at, f1, f2) in sorted(r["ends"]):
            carried[r["conv_id"], part] = (n, products)
            n, products = n + at, _joined(products, (f1, f2), at, bases)
    if not carried:
        return ordered

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = {c: batch.column(c).to_pylist() for c in ("conv_id", "part", "at", "f1", "f2")}
            for i, key in enumerate(zip(cols["conv_id"], cols["part"], strict=True)):
                if key in carried:
                    before, products = carried[key]
                    cols["f1"][i], cols["f2"][i] = _joined(products, (cols["f1"][i], cols["f2"][i]), cols["at"][i], bases)
                    cols["at"][i] += before
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[c], pa.int64()) if c in ("at", "f1", "f2") else batch.column(c) for c in batch.schema.names],
                names=batch.schema.names)

    return ordered.mapInArrow(run, ordered.schema)


MEMBERS = "conv_id long, depth long, f1 long, f2 long, q1 long, q2 long, k1 long, k2 long, bytes long, last boolean"


def members(talks: DataFrame, bases: tuple[int, int]) -> DataFrame:
    """A row for each prefix of each rebuilt conversation, the empty one included: conv_id, depth, its products f1 and f2,
    those of its parent q1 and q2, its last turn's reference k1 and k2 and bytes, and whether the conversation ends there."""
    ordered = materialize(_ordered(talks, bases), "turns")
    turns = _placed(ordered, bases)
    turn = F.struct("at", "k1", "k2", "bytes", "f1", "f2")
    convs = materialize(turns.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.when(F.col("at") <= HEAD, turn))).alias("head"), F.max("at").alias("n")), "heads")
    own = convs.select("conv_id", "n", "head", head_length(F.col("conv_id")).alias("h"),
                       (F.col("conv_id") - F.col("conv_id") % GROUP).alias("base"))
    base = convs.filter(F.col("conv_id") % GROUP == 0).select(F.col("conv_id").alias("base"), F.col("head").alias("_b"))
    taken = F.slice(F.coalesce("_b", F.array().cast(convs.schema["head"].dataType)), 1, F.greatest("h", F.lit(1)))
    none = F.struct(F.lit(0).cast("long").alias("f1"), F.lit(0).cast("long").alias("f2"))
    product = lambda turns, i: F.when((i > 0) & (F.size(turns) >= i), F.struct(
        F.element_at(turns, F.greatest(i, F.lit(1)))["f1"].alias("f1"), F.element_at(turns, F.greatest(i, F.lit(1)))["f2"].alias("f2"))) \
        .otherwise(none)
    plan = own.join(base.hint("merge"), "base", "left").withColumn("taken", F.filter(taken, lambda t: t["at"] <= F.col("h"))) \
        .withColumn("m", F.size("taken")).select(
            "conv_id", "n", "h", "m", "taken", product(F.col("taken"), F.col("m")).alias("front"),
            product(F.col("head"), F.col("h")).alias("cut"),
            (F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"))
    plan = materialize(plan, "plan")
    zero = [F.lit(0).cast("long").alias(c) for c in ("f1", "f2", "q1", "q2", "k1", "k2", "bytes")]
    roots = plan.select("conv_id", F.lit(0).cast("long").alias("depth"), *zero, (F.col("length") == 0).alias("last"))
    before = F.when(F.col("i") > 0, F.col("taken")[F.greatest(F.col("i") - 1, F.lit(0))])
    heads = plan.filter("m > 0").select("conv_id", "length", "taken", F.posexplode("taken").alias("i", "t")).select(
        "conv_id", (F.col("i") + 1).cast("long").alias("depth"), "t.f1", "t.f2",
        F.coalesce(before["f1"], F.lit(0)).alias("q1"), F.coalesce(before["f2"], F.lit(0)).alias("q2"), "t.k1", "t.k2", "t.bytes",
        (F.col("i") + 1 == F.col("length")).alias("last"))
    # A conversation of many turns lies in many ranges: what all its turns need is joined range by range.
    spans = turns.groupBy("conv_id", "part").agg(F.max("at").alias("_top")).join(
        plan.filter("n > h").select("conv_id", "h", "m", "front", "cut", "length"), "conv_id").filter(F.col("_top") > F.col("h"))
    rest = turns.join(spans, ["conv_id", "part"]).filter(F.col("at") > F.col("h")).select(
        "conv_id", "at", "k1", "k2", "bytes", "f1", "f2", "h", "m", "length", F.col("front.f1").alias("a1"),
        F.col("front.f2").alias("a2"), F.col("cut.f1").alias("c1"), F.col("cut.f2").alias("c2"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        backward = tuple(pow(b, -1, PRIME) for b in bases)
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                front, cut, step = (r["a1"], r["a2"]), (r["c1"], r["c2"]), r["at"] - r["h"]
                full = (r["f1"], r["f2"])
                earlier = tuple((f - k) * b % PRIME for f, k, b in zip(full, (r["k1"], r["k2"]), backward, strict=True))
                f = _joined(front, _segment(full, cut, step, bases), step, bases)
                q = _joined(front, _segment(earlier, cut, step - 1, bases), step - 1, bases)
                depth = step + r["m"]
                out.append((r["conv_id"], depth, *f, *q, r["k1"], r["k2"], r["bytes"], depth == r["length"]))
            cols = list(zip(*out, strict=True)) or [[]] * 10
            yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in cols[:9]], pa.array(cols[9], pa.bool_())],
                                             names=[c.split()[0] for c in MEMBERS.split(", ")])

    return materialize(roots.union(heads).union(rest.mapInArrow(run, MEMBERS)), "members")


NODE = ["depth", "f1", "f2"]


def _nodes(rows: DataFrame) -> DataFrame:
    """A row for each node: its smallest member, members, parent, last turn, and whether all rows agree about the latter
    two."""
    least, most = ([f(c).alias(f"{n}{c}") for c in ("q1", "q2", "k1", "k2")] for n, f in (("", F.min), ("_", F.max)))
    same = F.lit(True)
    for c in ("q1", "q2", "k1", "k2"):
        same = same & (F.col(c) == F.col(f"_{c}"))
    return rows.groupBy(*NODE).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
                                   F.max("bytes").alias("bytes"), *least, *most) \
        .select(*NODE, "conv_id", "n_convs", "bytes", "q1", "q2", same.alias("same"))


def _below(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """(depth, f1, f2, n_leaves, saved_tokens): sums over subtrees."""
    own = nodes.select("conv_id", "depth", ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"),
                       (F.col("n_children") == 0).cast("long").alias("leaf"))
    zero = F.lit(0).cast("long")
    each = rows.select("conv_id", *NODE).join(own.hint("merge"), ["conv_id", "depth"], "left").select(
        "conv_id", *NODE, F.coalesce("saved", zero).alias("saved"), F.coalesce("leaf", zero).alias("leaf"),
        F.floor(F.col("depth") / BLOCK).alias("block"))
    each = materialize(each, "own-figures")
    later = Window.partitionBy("conv_id").orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    blocks = each.groupBy("conv_id", "block").agg(F.sum("saved").alias("_s"), F.sum("leaf").alias("_l")).select(
        "conv_id", "block", F.coalesce(F.sum("_s").over(later), zero).alias("_s"), F.coalesce(F.sum("_l").over(later), zero).alias("_l"))
    blocks = materialize(blocks.filter("_s > 0 OR _l > 0"), "blocks")  # of conversations with several blocks alone
    inside = Window.partitionBy("conv_id", "block").orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, 0)
    down = each.select("conv_id", "block", *NODE, F.sum("saved").over(inside).alias("saved"), F.sum("leaf").over(inside).alias("leaf")) \
        .join(blocks.hint("merge"), ["conv_id", "block"], "left")
    return down.groupBy(*NODE).agg(F.sum(F.col("leaf") + F.coalesce("_l", zero)).alias("n_leaves"),
                                   F.sum(F.col("saved") + F.coalesce("_s", zero)).alias("saved_tokens"))


def _ends(rows: DataFrame) -> DataFrame:
    """(depth, f1, f2, ends_sha256) of nodes at which conversations end. Ids are sorted into ranges and joined to strings
    there, so that many that end at one node are dealt over tasks; the digest itself is taken string by string."""
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, held = None, []

        def flush() -> pa.RecordBatch:
            row = [*node, held[0], ",".join(map(str, held))]
            kinds = [pa.int64()] * 4 + [pa.string()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=[*NODE, "first", "ids"])

        for batch in batches:
            for *key, conv in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True):
                if held and (key != node or len(held) == PIECE):
                    yield flush()
                    held = []
                node = key
                held.append(conv)
        if held:
            yield flush()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sha = None, None
        row = lambda: pa.RecordBatch.from_arrays([*[pa.array([v], pa.int64()) for v in node], pa.array([sha.hexdigest()])],
                                                 names=[*NODE, "ends_sha256"])
        for batch in batches:
            for *key, ids in zip(*(batch.column(c).to_pylist() for c in (0, 1, 2, 4)), strict=True):
                if key != node:
                    if node is not None:
                        yield row()
                    node, sha = key, hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
        if node is not None:
            yield row()

    order = [*NODE, "conv_id"]
    strings = rows.filter("last").select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        pieces, "depth long, f1 long, f2 long, first long, ids string")
    return strings.repartition(*NODE).sortWithinPartitions(*NODE, "first").mapInArrow(
        digests, "depth long, f1 long, f2 long, ends_sha256 string")


def conversation_trie(talks: DataFrame) -> DataFrame:
    """One row per node of the trie of rebuilt conversations: conv_id (its smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256.

    talks has conv_id, turn, role and text; other columns are left out. Null roles and texts count as empty, null turns
    come first, turns with equal numbers are ordered by their digest, so repeated rows are turns of their own. Rows
    without a conv_id belong to no conversation. Without rows there is no node. Of conversations of negative id the
    base is the next multiple towards zero."""
    for bases in BASES:
        rows = members(talks, bases)
        nodes = materialize(_nodes(rows), "nodes")
        if not nodes.filter("NOT same").limit(1).count():
            break
    else:
        raise RuntimeError("different conversations share their fingerprints under all bases")
    children = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("q1").alias("f1"),
                                                 F.col("q2").alias("f2")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = materialize(nodes.join(children.hint("merge"), NODE, "left").withColumn(
        "n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "nodes")
    parents = nodes.filter("n_children > 0").select(F.col("depth").alias("_d"), F.col("f1").alias("q1"), F.col("f2").alias("q2"),
                                                    F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("_many"))
    named = spread_join(nodes.withColumn("_d", F.col("depth") - 1), parents, ["_d", "q1", "q2"], "_many")
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return named.join(_below(rows, nodes).hint("merge"), NODE).join(_ends(rows).hint("merge"), NODE, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", nothing).alias("ends_sha256"))
