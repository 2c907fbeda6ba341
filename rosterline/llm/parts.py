"""Columns of texts cut into parts, each distinct part looked up once, and results put together for a whole column."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

COLUMN_BYTES = 8 << 20
SPACE = "▁"


class Cut:
    """Distinct parts of a column, where each part of each text is among them, and where each text's parts begin and
    end."""

    def __init__(self, lists: pa.ListArray):
        coded = lists.flatten().dictionary_encode()
        self.parts: list[str] = coded.dictionary.to_pylist()
        self.at = coded.indices.to_numpy(zero_copy_only=False)
        offsets = lists.offsets.to_numpy()
        self.ends = offsets - offsets[0]

    def joined(self, of_parts: list[bytes], kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
        """(values, ends): the values of all parts one after the other, and where each text's begin and end. of_parts
        has the values of each distinct part."""
        sizes = np.fromiter(map(len, of_parts), np.int64, len(of_parts)) // kind.itemsize
        values = np.frombuffer(b"".join(of_parts), kind)
        size = sizes[self.at]
        ends = np.concatenate(([0], np.cumsum(size)))
        shift = (np.cumsum(sizes) - sizes)[self.at] - ends[:-1]  # from a place in the result to that in the values
        return values[np.repeat(shift, size) + np.arange(ends[-1])], ends[self.ends]

    def summed(self, of_parts: list[int]) -> np.ndarray:
        """The sum over each text's parts."""
        total = np.concatenate(([0], np.cumsum(np.array(of_parts, np.int64)[self.at])))
        return total[self.ends[1:]] - total[self.ends[:-1]]


def cut_at_blanks(texts: pa.Array) -> Cut:
    """Cut at each space, tab and line end, which are left out."""
    for mark in "\n\t\r":
        texts = pc.replace_substring(texts, mark, " ")
    return Cut(pc.split_pattern(texts, " "))


def cut_before_spaces(texts: pa.Array) -> Cut:
    """Spaces written as SPACE, one put in front of a text that isn't empty, and a cut before each run of them. The
    first part of a text is empty."""
    full = pc.if_else(pc.equal(pc.binary_length(texts), 0), "", pc.binary_join_element_wise(" ", texts, ""))
    full = pc.replace_substring(full, " ", SPACE)
    free = next(c for c in map(chr, range(0xE000, 0x110000)) if not pc.any(pc.match_substring(full, c)).as_py())
    return Cut(pc.split_pattern(pc.replace_substring_regex(full, f"({SPACE}+)", f"{free}\\1"), free))


def column_slices(texts: pa.Array, most: int = COLUMN_BYTES) -> Iterator[pa.Array]:
    """The column in runs of a bounded number of bytes, a longer text alone."""
    sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(texts):
        upto = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + most, side="right")))
        yield texts.slice(at, upto - at)
        at = upto
