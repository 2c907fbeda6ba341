"""Packing of documents into sequences of a fixed capacity by Karmarkar-Karp multiway differencing.

Each task encodes its documents and cuts them: windows of full capacity stand alone, the rest is cut into pieces of at
most `piece` ids. Pieces are gathered into blocks of some hundred windows. Those below a 64th of the capacity are first put
together, in their order, to bundles of up to that size, so that a block has as many windows with short documents as
with long ones. For a block, every piece or bundle starts as a partial partition of its own, and the two whose window
sums are most uneven are merged, largest sums onto smallest, until one is left. Its windows are nearly equal. If one of
them exceeds the capacity, the block is packed anew into one window more. Nothing is shuffled and a block's size is
bounded, so any row may be as long or as frequent as it likes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from heapq import heapify, heappop, heappushpop

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import tokenizer_file
from .wordids import WIDE, word_encoder


BUNDLE = 64
KEEP_PARTS = 1_500_000  # distinct parts of texts that a worker remembers


def difference(sizes: list[int], windows: int) -> list[list[int]]:
    """Indexes of the sizes, dealt to `windows` windows by largest differencing.

    A partial partition is held as its non-empty windows, sums descending: (sums, members). Its unevenness is the
    largest sum less the smallest, which is 0 as long as a window is empty."""
    parts: dict[int, tuple[np.ndarray, list]] = {}
    agenda = []
    for i, s in enumerate(sizes):
        parts[i] = (np.array([s], np.int64), [i])
        agenda.append((-s if windows > 1 else 0, i))
    heapify(agenda)
    fresh = len(sizes)
    if agenda:
        top = heappop(agenda)
        while agenda:
            other = heappop(agenda)
            sums, who = parts.pop(top[1])
            sums2, who2 = parts.pop(other[1])
            a, b = len(sums), len(sums2)
            over = a + b - windows
            if over <= 0:
                sums, who = np.concatenate((sums, sums2)), who + who2
            else:
                # window a-1-j of the first meets window b-over+j of the second: small onto large
                merged = sums[a - over:] + sums2[b - over:][::-1]
                pairs = list(zip(who[a - over:], reversed(who2[b - over:]), strict=True))
                sums = np.concatenate((sums[:a - over], sums2[:b - over], merged))
                who = who[:a - over] + who2[:b - over] + pairs
            order = np.argsort(-sums, kind="stable")
            sums, who = sums[order], [who[i] for i in order.tolist()]
            uneven = sums[0] - (sums[-1] if len(sums) == windows else 0)
            parts[fresh] = (sums, who)
            top = heappushpop(agenda, (-int(uneven), fresh))
            fresh += 1
        who = parts[top[1]][1]
    else:
        who = []
    out = []
    for w in who:
        members, stack = [], [w]
        while stack:
            x = stack.pop()
            if isinstance(x, tuple):
                stack += x
            else:
                members.append(x)
        out.append(sorted(members))
    return out


def pack(sizes: list[int], capacity: int) -> list[list[int]]:
    """Windows of indexes, none above the capacity; as few as the sums allow, then one more at a time."""
    if max(sizes, default=0) > capacity:
        raise ValueError("a piece is larger than a window")
    windows = -(-sum(sizes) // capacity)
    while windows:
        dealt = difference(sizes, windows)
        if all(sum(sizes[i] for i in w) <= capacity for w in dealt):
            return dealt
        windows += 1
    return []


def bundled(sizes: list[int], least: int) -> list[list[int]]:
    """Indexes of the sizes: one alone if it is `least` or more, smaller ones together up to `least`, in their order."""
    out, open_, held = [], [], 0
    for i, s in enumerate(sizes):
        if s >= least:
            out.append([i])
            continue
        if held + s > least:
            out.append(open_)
            open_, held = [], 0
        open_.append(i)
        held += s
    return [*out, open_] if open_ else out


def cut(length: int, capacity: int, piece: int) -> Iterator[tuple[int, int]]:
    """(start, length) of a document's pieces: full windows, then pieces of at most `piece`."""
    at = 0
    while length - at >= capacity:
        yield at, capacity
        at += capacity
    while at < length:
        n = min(piece, length - at)
        yield at, n
        at += n


PIECES = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def packed_pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = 4096, piece: int = 1024,
                  block: int = 128, end_id: int = 2, model: str | None = None, with_ids: bool = False,
                  hold: bool = True) -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset; with_ids adds the ids.

    A null text counts as empty and gives the end id alone. capacity: ids of a sequence; block: windows packed
    together at least, but at a partition's end. hold: workers remember words from task to task, some 250 MB each;
    without it they give them back, for what else runs on the executor afterwards. Sequence ids are unique; they and the windows follow the
    partitioning of the input, the pieces of a document do not."""
    path = model or tokenizer_file("word_bpe_49k.json")
    end = np.array([end_id], WIDE).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = word_encoder(path, KEEP_PARTS)
        sequence = (TaskContext.get().partitionId()) << 32
        keys: list = []
        rows: list[tuple[int, int, int, int]] = []  # start, length, crc, tokens of the document
        ids: list[bytes] = []
        weight = whole = 0  # ids to pack, and windows that are full already

        def flush() -> pa.RecordBatch:
            nonlocal sequence, weight, whole
            full = [i for i, r in enumerate(rows) if r[1] == capacity]
            rest = [i for i, r in enumerate(rows) if r[1] < capacity]
            seq, off = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
            seq[full] = sequence + np.arange(len(full))
            sequence += len(full)
            units = bundled([rows[i][1] for i in rest], max(1, capacity // BUNDLE))
            for window in pack([sum(rows[rest[j]][1] for j in u) for u in units], capacity):
                at = 0
                for i in (rest[j] for u in window for j in units[u]):
                    seq[i], off[i] = sequence, at
                    at += rows[i][1]
                sequence += 1
            cols = [pa.array([r[c] for r in rows], pa.int64()) for c in range(4)]
            out = [pa.array(keys, key_type), *cols, pa.array(seq), pa.array(off)]
            out += [pa.array(ids, pa.binary())] if with_ids else []
            keys.clear(), rows.clear(), ids.clear()
            weight = whole = 0
            return pa.RecordBatch.from_arrays(out, names=names)

        for batch in batches:
            key_type = batch.column(0).type
            for own, body in zip(batch.column(0).to_pylist(), enc.bodies(batch.column(1)), strict=True):
                body = memoryview(body + end)
                total = len(body) // 4
                for start, n in cut(total, capacity, piece):
                    part = body[4 * start:4 * (start + n)]
                    keys.append(own)
                    rows.append((start, n, zlib.crc32(part), total))
                    if with_ids:
                        ids.append(bytes(part))
                    weight += n if n < capacity else 0
                    whole += n == capacity
                    if weight >= block * capacity or whole >= 32 * block:
                        yield flush()
        if rows:
            yield flush()
        if not hold:
            enc.forget()

    names = ["doc_id", *[c.split()[0] for c in PIECES.split(", ")], *["ids"] * with_ids]
    rows_in = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = rows_in.schema["doc_id"].dataType.simpleString()
    return rows_in.mapInArrow(run, f"doc_id {kind}, {PIECES}" + ", ids binary" * with_ids)


def sequences(pieces: DataFrame, capacity: int = 4096) -> DataFrame:
    """(sequence_id, length, ids): the packed sequences of packed_pieces(..., with_ids=True). A sequence has at most
    `capacity` ids, so a group is bounded."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(ordered, F.lit(b""), lambda acc, x: F.concat(acc, x["ids"]))
    return pieces.groupBy("sequence_id").agg(F.sum("length").alias("length"), joined.alias("ids"))
