"""Near-duplicates by SimHash and meet-in-the-middle ball hashing.

Two 64-bit fingerprints at 4 or fewer differing bits have a common point within 2 bits of each. So every distinct
fingerprint emits the points of its ball of half the radius, points are shuffled together, and fingerprints that meet
in a point are linked; as they are within 2 bits of it, they are within 4 of each other. A ball has 2081 points, and
most fingerprints meet nobody, so points are emitted in two steps. With radius 4, the two halves of a point can't
both be 2 bits away: each fingerprint first emits, for either half, the 33 values within one bit. Only where such a
value has company does it emit the points that complete it within its ball. All points of all pairs in reach are
emitted nonetheless, and a point's group has at most 2081 distinct fingerprints, so it is linked to its smallest as a
star, without all pairs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import components, materialize

WORDS = 4
SEED = 42
RADIUS = 4


def shingle_hashes(text: bytes, size: int) -> Iterator[np.ndarray]:
    """Hashes of the shingles of so many words, with repeats, by blocks of bounded size: A-Z lowered, words by ASCII
    white space. A shorter text is one shingle, one without words has none."""
    words = text.lower().split()
    if not words:
        return
    joined = b" ".join(words)
    hashed = xxhash.xxh64_intdigest
    if len(words) < size:
        yield np.array([hashed(joined, SEED)], np.uint64)
        return
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts, n = np.concatenate(([0], ends[:-1] + 1)), len(words) - size + 1
    for at in range(0, n, 65536):  # bounded memory for very long texts
        spans = zip(starts[at:min(at + 65536, n)].tolist(), ends[at + size - 1:at + size - 1 + 65536].tolist())
        yield np.array([hashed(joined[a:b], SEED) for a, b in spans], np.uint64)


def fold(blocks: Iterable[np.ndarray]) -> int:
    """SimHash of the hashes as an unsigned integer."""
    votes, n = np.zeros(64, np.int64), 0
    for h in blocks:
        votes += np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
        n += len(h)
    return int.from_bytes(np.packbits(2 * votes > n).tobytes(), "big")


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """SimHash of a UTF-8 text as an unsigned integer, over shingles with repeats."""
    return fold(shingle_hashes(text, words))


def with_fingerprint(docs: DataFrame, keep: list[str], text: str = "text", name: str = "fp") -> DataFrame:
    """The kept columns and the fingerprint as a signed long. A null text counts as empty, its fingerprint is zero."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(keep)).to_pylist()
            fps = np.fromiter(map(fingerprint, texts), np.uint64, len(texts)).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(fps)], names=[*keep, name])

    rows = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).cast("binary").alias("_text"))
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    return rows.mapInArrow(run, ", ".join([*kinds, f"`{name}` long"]))


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def _flips(half: int, most: int) -> list[int]:
    """Signed masks of up to `most` flipped bits in one half."""
    one = [1 << (32 * half + i) for i in range(32)]
    two = [a | b for i, a in enumerate(one) for b in one[:i]]
    return [_signed(m) for m in [0, *one * (most > 0), *two * (most > 1)]]


def links(fps: DataFrame) -> DataFrame:
    """(a, b): of the distinct longs in column fp, those at 4 or fewer differing bits, as stars of each meeting point:
    a is the point's smallest fingerprint. Pairs that aren't listed are connected through others within reach."""
    masks = [F.lit(0xFFFFFFFF), F.lit(_signed(0xFFFFFFFF << 32))]

    def halves() -> DataFrame:
        """(fp, half, flip, value): for either half of the fingerprint, its values within one bit."""
        def value(half: int):
            return lambda flip: F.struct(F.lit(half).alias("half"), flip.alias("flip"),
                                         F.col("fp").bitwiseXOR(flip).bitwiseAND(masks[half]).alias("value"))

        emitted = [F.transform(F.array(*[F.lit(m) for m in _flips(h, 1)]), value(h)) for h in (0, 1)]
        return fps.select("fp", F.explode(F.concat(*emitted)).alias("p")).select("fp", "p.*")

    company = materialize(halves().groupBy("half", "value").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi"))
                          .filter("lo < hi").select("half", "value"), "company")
    # Always by shuffle, also where the table is small: the plan that is tried is the one that runs at any size.
    met = halves().join(company.hint("merge"), ["half", "value"])
    # The other half completes the point: within 2 bits if this one is unchanged, within 1 otherwise.
    rest = F.lit(None).cast("array<long>")
    for half in (0, 1):
        for changed, most in ((False, 2), (True, 1)):
            here = (F.col("half") == half) & ((F.col("flip") != 0) == F.lit(changed))
            rest = F.when(here, F.array(*[F.lit(m) for m in _flips(1 - half, most)])).otherwise(rest)
    points = met.select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("near"), F.explode(rest).alias("other")) \
        .select("fp", F.col("near").bitwiseXOR(F.col("other")).alias("point"))
    groups = points.groupBy("point").agg(F.collect_set("fp").alias("fps")).filter(F.size("fps") > 1)
    return groups.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).filter("a < b").distinct() \
        .filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS)


def near_groups(rows: DataFrame, key: str) -> DataFrame:
    """Adds component_id, the smallest key reachable over links between fingerprints, the row's own included, and label,
    the smallest fingerprint reachable: keys may be null or repeated, so only the label tells components apart. rows
    is a written table with columns fp and key."""
    fps = materialize(rows.groupBy("fp").agg(F.min(key).alias("first")), "fps")
    pairs = materialize(links(fps.select("fp")), "pairs")
    labels = materialize(components(pairs), "members").select(F.col("node").alias("fp"), "label")
    own = fps.join(labels, "fp", "left").select("fp", "first", F.coalesce("label", "fp").alias("label"))
    least = own.groupBy("label").agg(F.min("first").alias("component_id"))
    table = materialize(own.join(least, "label").select("fp", "component_id", "label"), "classes")
    return rows.join(table, "fp")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, fingerprint (16 hex digits), component_id. Null texts count as empty; empty texts
    share fingerprint zero and are linked like any other. A null key is no smallest key unless all of its component's
    are null. Other columns are left out."""
    named = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    rows = materialize(with_fingerprint(named, ["doc_id"]), "fingerprints")
    return near_groups(rows, "doc_id").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
