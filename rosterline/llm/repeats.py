"""Removal of byte strings that repeat anywhere in a corpus, by suffix arrays over shards.

Every window of `length` bytes holds a 32-byte gram whose hash is the smallest in it, its anchor; equal windows have
equal anchors at the same place. So the windows of a text fall into runs that share an anchor, each run being one
region of text, and only regions with the same anchor can hold equal windows. Anchors are counted first. Where all
regions of an anchor are equal, or a region itself occurs twice, all its windows repeat. What remains, regions that
differ but share an anchor, mostly at the edges of copied passages, is dealt into shards by anchor, one copy of each
region; each shard's suffix array is induced, and its common prefixes tell the windows that occur twice. An anchor
with more text than a task should hold has its windows counted by hash instead, over all tasks.

Texts are known by their hash and length between steps, regions by two 64-bit hashes; matches never cross texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .common import materialize
from .suffixes import repeated_starts

GRAM = 32
SHARD_BYTES = 1 << 19  # text of a suffix array, on average
GROUP_BYTES = 1 << 21  # text of an anchor that a task's memory holds (some 170 bytes a byte); beyond, see above
BATCH_BYTES = 4 << 20
CHUNK = 4 << 20  # windows of one text that are looked at together
POSITION_BITS = 24


def _runs(text: np.ndarray, lasts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For concatenated texts, `lasts` being their ends: first window, last window and anchor hash of each run."""
    n = len(text)
    if n < length:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    padded = np.concatenate((text, np.zeros(8, np.uint8)))
    word = np.ndarray(n, "<u8", padded.data, strides=(1,))
    with np.errstate(over="ignore"):
        h = word * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        h = h[:-8] * np.uint64(0xBF58476D1CE4E5B9) + h[8:]
        h ^= h >> np.uint64(32)
        h = h[:-16] * np.uint64(0x94D049BB133111EB) + h[16:]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xD6E8FEB86659FD93)
    h = h[:n - GRAM + 1]
    low = np.uint64((1 << POSITION_BITS) - 1)
    least = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    wide, span = length - GRAM + 1, 1
    while 2 * span <= wide:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if wide > span:
        least = np.minimum(least[:span - wide], least[wide - span:])
    chosen = (least & low).astype(np.int64)  # for each window, its anchor; the leftmost of equals
    inside = np.ones(len(chosen), bool)
    for last in lasts[lasts < n].tolist():
        inside[max(0, last - length + 1):last] = False
    new = np.concatenate(([True], (chosen[1:] != chosen[:-1]) | ~inside[:-1])) & inside
    first = np.flatnonzero(new)
    ended = np.concatenate(((chosen[1:] != chosen[:-1]) | ~inside[1:], [True])) & inside
    return first, np.flatnonzero(ended), h[chosen[first]]


def regions(texts: list[bytes], length: int) -> Iterator[tuple[int, int, int, int, int]]:
    """(text, start, size, anchor, hash) of the regions of texts, hashes as signed 64-bit numbers."""
    at = 0
    while at < len(texts):
        upto, held = at, 0
        while upto < len(texts) and (upto == at or held + len(texts[upto]) <= BATCH_BYTES):
            held += len(texts[upto])
            upto += 1
        joined = b"".join(texts[at:upto])
        lasts = np.cumsum(np.fromiter(map(len, texts[at:upto]), np.int64, upto - at))
        whole = np.frombuffer(joined, np.uint8)
        for chunk in range(0, max(1, len(whole)), CHUNK):
            part = whole[chunk:chunk + CHUNK + length - 1]
            first, final, anchor = _runs(part, lasts - chunk, length)
            if chunk + CHUNK < len(whole):  # windows beyond the chunk are the next one's
                keep = first < CHUNK
                first, final, anchor = first[keep], np.minimum(final[keep], CHUNK - 1), anchor[keep]
            first, final = first + chunk, final + chunk
            text = np.searchsorted(lasts, first, side="right")
            begins = np.concatenate(([0], lasts))[text]
            for t, b, f, e, a in zip(text.tolist(), begins.tolist(), first.tolist(), (final + length).tolist(),
                                     anchor.view(np.int64).tolist(), strict=True):
                own = xxhash.xxh3_64_intdigest(joined[f:e])
                yield at + t, f - b, e - f, a, own - (1 << 64) if own >> 63 else own
        at = upto


TEXT_KEY = ["_k", "_n"]


def _keyed(docs: DataFrame, text: str, *more: Column) -> DataFrame:
    filled = F.coalesce(F.col(text), F.lit(""))
    return docs.select(*more, F.xxhash64(filled).alias("_k"), F.octet_length(filled).alias("_n"),
                       filled.cast("binary").alias("_text"))


def _all_regions(texts: DataFrame, length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(regions(batch.column("_text").to_pylist(), length))
            text, start, size, anchor, own = (np.array(c, np.int64) for c in zip(*found, strict=True)) if found else \
                [np.zeros(0, np.int64)] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor), pa.array(own), batch.column("_k").take(pa.array(text)),
                 batch.column("_n").take(pa.array(text)), pa.array(start.astype(np.int32)),
                 pa.array(size.astype(np.int32))], names=["anchor", "region", "_k", "_n", "start", "size"])

    return texts.filter(F.col("_n") >= length).select("_k", "_n", "_text").mapInArrow(
        run, "anchor long, region long, _k long, _n int, start int, size int")


def _pieces(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes of each wanted region, once: wanted has the text key, start, size, anchor, region and more."""
    info = [c for c in wanted.columns if c not in TEXT_KEY]
    lists = wanted.groupBy(*TEXT_KEY).agg(F.collect_list(F.struct(*info)).alias("_w"))
    kinds = {f.name: f.dataType.simpleString() for f in wanted.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("_w")
            flat = rows.flatten()
            of = np.repeat(np.arange(len(rows)), np.diff(rows.offsets.to_numpy()))
            bodies = batch.column("_text").to_pylist()
            spans = zip(of.tolist(), flat.field("start").to_pylist(), flat.field("size").to_pylist(), strict=True)
            cut = [bodies[t][s:s + n] for t, s, n in spans]
            at = pa.array(of)
            yield pa.RecordBatch.from_arrays(
                [batch.column(k).take(at) for k in TEXT_KEY] + [flat.field(c) for c in info]
                + [pa.array(cut, pa.binary())], names=[*TEXT_KEY, *info, "piece"])

    schema = ", ".join(f"`{c}` {kinds[c]}" for c in [*TEXT_KEY, *info]) + ", piece binary"
    found = texts.join(lists, TEXT_KEY).select(*TEXT_KEY, "_text", "_w").mapInArrow(run, schema)
    # Copies of a text give the same piece; it is needed once.
    return found.groupBy(*TEXT_KEY, *info).agg(F.first("piece").alias("piece"))


SPANS = "_k long, _n int, start int, end int"


def _spans_of(frame: pd.DataFrame, places: list[np.ndarray], length: int) -> pd.DataFrame:
    """A row for each run of repeated windows in the regions that occur once."""
    rows = []
    for k, n, start, single, at in zip(frame["_k"], frame["_n"], frame["start"], frame["single"], places, strict=True):
        if single and len(at):
            cuts = np.flatnonzero(np.diff(at) > 1)
            firsts, finals = at[np.concatenate(([0], cuts + 1))], at[np.concatenate((cuts, [len(at) - 1]))]
            rows += [(k, n, start + a, start + b + length) for a, b in zip(firsts.tolist(), finals.tolist(), strict=True)]
    return pd.DataFrame(rows, columns=["_k", "_n", "start", "end"]).astype(
        {"_k": "int64", "_n": "int32", "start": "int32", "end": "int32"})


def _by_suffixes(pieces: DataFrame, shards: int, length: int) -> DataFrame:
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        return _spans_of(frame, repeated_starts(frame["piece"].tolist(), length), length)

    shard = F.pmod(F.xxhash64("anchor"), F.lit(shards))
    return pieces.withColumn("_shard", shard).groupBy("_shard").applyInPandas(
        lambda frame: run(frame.drop(columns="_shard")), SPANS)


def _by_windows(pieces: DataFrame, length: int) -> DataFrame:
    """Windows counted by a 128-bit hash, as (low, high): no group of an anchor's regions meets in one task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            frame = batch.to_pandas()
            for k, n, start, single, piece in zip(frame["_k"], frame["_n"], frame["start"], frame["single"],
                                                  frame["piece"], strict=True):
                both = b"".join(xxhash.xxh3_128_digest(piece[i:i + length]) for i in range(len(piece) - length + 1))
                halves = np.frombuffer(both, "<i8").reshape(-1, 2)
                m = len(halves)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy()), pa.array(np.full(m, k)),
                     pa.array(np.full(m, n, np.int32)), pa.array(np.arange(start, start + m, dtype=np.int32)),
                     pa.array(np.full(m, single))], names=["low", "high", "_k", "_n", "start", "single"])

    windows = materialize(pieces.select("_k", "_n", "start", "single", "piece").mapInArrow(
        run, "low long, high long, _k long, _n int, start int, single boolean"), "windows")
    twice = materialize(windows.groupBy("low", "high").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
                        .select("low", "high"), "repeated")
    return windows.filter("single").join(twice, ["low", "high"], "left_semi") \
        .select("_k", "_n", "start", (F.col("start") + length).alias("end"))


def repeated_spans(texts: DataFrame, length: int, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """(_k, _n, spans): per distinct text, the sorted spans covered by strings of `length` bytes that start elsewhere
    too. texts: _keyed()."""
    found = _all_regions(texts, length)
    shared = materialize(found.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("n"), (F.min("region") == F.max("region")).alias("uniform"))
        .filter("n > 1").select("anchor", "uniform"), "anchors")
    hits = materialize(found.join(shared, "anchor"), "regions")
    mixed = materialize(hits.filter("NOT uniform").groupBy("anchor", "region").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("_k", "_n", "start", "size")).alias("at")), "mixed")
    whole = hits.filter("uniform").select(*TEXT_KEY, "start", "size").union(
        hits.filter("NOT uniform").join(mixed.filter("n > 1").select("anchor", "region"), ["anchor", "region"],
                                        "left_semi").select(*TEXT_KEY, "start", "size")) \
        .select(*TEXT_KEY, "start", (F.col("start") + F.col("size")).alias("end"))

    groups = materialize(mixed.groupBy("anchor").agg(F.sum("at.size").alias("bytes"), F.min("n").alias("least"))
                         .filter("least = 1").select("anchor", (F.col("bytes") > group_bytes).alias("heavy"), "bytes"),
                         "groups")
    light = groups.filter("NOT heavy").agg(F.sum("bytes")).first()[0] or 0
    wanted = mixed.join(groups.select("anchor", "heavy"), "anchor").select(
        F.col("at._k").alias("_k"), F.col("at._n").alias("_n"), F.col("at.start").alias("start"),
        F.col("at.size").alias("size"), "anchor", "region", (F.col("n") == 1).alias("single"), "heavy")
    pieces = materialize(_pieces(texts, wanted), "pieces")
    edges = _by_suffixes(pieces.filter("NOT heavy").drop("heavy"), max(1, -(-light // SHARD_BYTES)), length)
    spans = materialize(whole.union(edges).union(_by_windows(pieces.filter("heavy"), length)), "spans")
    return spans.groupBy(*TEXT_KEY).agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("spans"))


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    """Sorted spans as maximal runs."""
    out: list[tuple[int, int]] = []
    for s in spans:
        if out and s["start"] <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], s["end"]))
        else:
            out.append((s["start"], s["end"]))
    return out


def without_repeats(docs: DataFrame, keep: list[str], text: str = "text", length: int = 200) -> DataFrame:
    """The kept columns, n_bytes, n_removed, n_spans and `rest`, the bytes that stay (which need not be whole UTF-8
    characters). A null text counts as empty."""
    texts = _keyed(docs, text)
    rows = _keyed(docs, text, *[F.col(f"`{c}`") for c in keep]) \
        .join(materialize(repeated_spans(texts, length), "removed"), TEXT_KEY, "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, gone, runs, rest = [], [], [], []
            for body, spans in zip(batch.column("_text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                cut = merged(spans or [])
                edges = [0, *[x for c in cut for x in c], len(body)]
                rest.append(b"".join(body[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)) if cut else body)
                sizes.append(len(body))
                gone.append(len(body) - len(rest[-1]))
                runs.append(len(cut))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()),
                 pa.array(runs, pa.int64()), pa.array(rest, pa.binary())],
                names=[*keep, "n_bytes", "n_removed", "n_spans", "rest"])

    kinds = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep]
    return rows.select(*keep, "_text", "spans").mapInArrow(
        run, ", ".join([*kinds, "n_bytes long, n_removed long, n_spans long, rest binary"]))


def removal_report(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 200) -> DataFrame:
    """One row per document: key, n_bytes, n_removed, n_spans and kept_sha256."""
    named = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    return without_repeats(named, ["doc_id"], "text", length).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("rest", 256).alias("kept_sha256"))
