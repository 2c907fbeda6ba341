"""A Bloom filter of fixed size, built by Spark and handed to tasks: what it holds back is surely not wanted, what it
lets through is checked by whoever uses it. So its size bounds what is broadcast, and never changes a result."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame

FILTER_BITS = 27  # 16 MiB, whatever the number of keys
STEP = 1 << 16  # hashes that are looked up together
PROBES = 4
_SLICE_BITS = 20


def _places(h: np.ndarray) -> Iterator[np.ndarray]:
    step = (h >> np.uint64(32)) | np.uint64(1)
    for i in range(PROBES):
        yield (h + np.uint64(i) * step) & np.uint64((1 << FILTER_BITS) - 1)


def contains(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Whether each of the unsigned 64-bit hashes may be among the keys."""
    out = np.ones(len(h), bool)
    for first in range(0, len(h), STEP):  # places of all at once would take many times their size
        some = out[first:first + STEP]
        for at in _places(h[first:first + STEP]):
            some &= (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
    return out


def opened(filter_bits: Broadcast) -> np.ndarray:
    return np.frombuffer(filter_bits.value, np.uint8)


def bloom(keys: DataFrame) -> Broadcast:
    """The filter of the 64-bit hashes in the one column of keys, for opened(). The driver gets its bits in slices."""
    name = keys.columns[0]

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            at = np.unique(np.concatenate(list(_places(h)))).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at >> _SLICE_BITS), pa.array(at & ((1 << _SLICE_BITS) - 1))],
                                             names=["slice", "at"])

    def packed(frame: pd.DataFrame) -> pd.DataFrame:
        flags = np.zeros(1 << _SLICE_BITS, np.uint8)
        flags[frame["at"].to_numpy()] = 1
        return pd.DataFrame({"slice": [frame["slice"].iloc[0]], "bits": [np.packbits(flags, bitorder="little").tobytes()]})

    found = keys.select(name).mapInArrow(places, "slice long, at long").distinct()  # so a slice is bounded
    bits = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    width = 1 << (_SLICE_BITS - 3)
    for r in found.groupBy("slice").applyInPandas(packed, "slice long, bits binary").collect():
        bits[r["slice"] * width:(r["slice"] + 1) * width] = np.frombuffer(r["bits"], np.uint8)
    return keys.sparkSession.sparkContext.broadcast(bits.tobytes())
