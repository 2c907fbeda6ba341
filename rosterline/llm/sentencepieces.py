"""Encoding and decoding with merge-type SentencePiece vocabularies.

A text is cut before each run of spaces. No piece of a vocabulary that is accepted here goes on past such a cut, so
the parts are encoded one by one, each distinct part once per worker as long as the bounded memory holds it. Within a
part, an agenda holds the adjacent pairs that form a piece; the best score, and of equals the leftmost, is merged
first. Every newly encoded part is compared with the sentencepiece library's own result, a batch at a time.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import tokenizer_file
from .parts import SPACE, column_slices, cut_before_spaces

KEEP_PARTS = 1_000_000
KEEP_LENGTH = 64


class Vocabulary:
    """The pieces of a merge-type model file and the merging order."""

    def __init__(self, path: str):
        import sentencepiece

        self.lib = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.lib.get_piece_size()
        if any(self.lib.is_unused(i) for i in range(n)):
            raise ValueError("vocabularies with unused pieces are not supported")
        normal = [i for i in range(n) if not (self.lib.is_unknown(i) or self.lib.is_control(i) or self.lib.is_byte(i))]
        self.pieces = [self.lib.id_to_piece(i) for i in range(n)]
        self.ids = {self.pieces[i]: i for i in normal}
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.ids):
            raise ValueError("a piece goes on past a space, so parts can't be encoded one by one")
        scores = sorted({self.lib.get_score(i) for i in normal}, reverse=True)
        order = {s: k for k, s in enumerate(scores)}
        self.rank = {self.pieces[i]: order[self.lib.get_score(i)] for i in normal}
        self.bytes = {int(self.pieces[i][3:5], 16): i for i in range(n) if self.lib.is_byte(i)}
        self.end = self.lib.eos_id()
        self.unknown = self.lib.unk_id()
        self.same = self.lib.encode(f"a  {SPACE}b ", out_type=str) != [] and self._unchanged()

    def _unchanged(self) -> bool:
        """The model must leave texts as they are, but for the space in front."""
        probe = " Ａﬁ  é\n\tx "
        if self.lib.decode(self.lib.encode(probe)) != probe:
            raise ValueError("vocabularies that normalise texts are not supported")
        return True

    def part(self, part: str) -> list[int]:
        """Ids of one part."""
        rank = self.rank
        sym: list[str] = list(part)
        n = len(sym)
        if n > 1:
            agenda = []
            for i in range(n - 1):
                r = rank.get(sym[i] + sym[i + 1])
                if r is not None:
                    agenda.append((r << 40) | i)
            if agenda:
                heapify(agenda)
                after = list(range(1, n + 1))
                before = list(range(-1, n - 1))
                mask = (1 << 40) - 1
                while agenda:
                    top = heappop(agenda)
                    i = top & mask
                    left = sym[i]
                    if not left:
                        continue
                    j = after[i]
                    if j >= n:
                        continue
                    both = left + sym[j]
                    r = rank.get(both)
                    if r is None or r != top >> 40:
                        continue  # one of the two has grown since
                    sym[i] = both
                    sym[j] = ""
                    k = after[i] = after[j]
                    if k < n:
                        before[k] = i
                        r = rank.get(both + sym[k])
                        if r is not None:
                            heappush(agenda, (r << 40) | i)
                    p = before[i]
                    if p >= 0:
                        r = rank.get(sym[p] + both)
                        if r is not None:
                            heappush(agenda, (r << 40) | p)
        out: list[int] = []
        for s in sym:
            if s:
                known = self.ids.get(s)
                if known is not None:
                    out.append(known)
                elif self.bytes:
                    out.extend(self.bytes[b] for b in s.encode())
                elif not out or out[-1] != self.unknown:
                    out.append(self.unknown)
        return out


class Encoder:
    """Texts to ids. known holds the ids of short parts that were met, up to a bound, then starts anew."""

    def __init__(self, path: str, keep: int = KEEP_PARTS):
        self.vocabulary, self.keep = Vocabulary(path), keep
        self.known: dict[str, bytes] = {"": b""}

    def learn(self, parts: list[str]) -> dict[str, bytes]:
        """Ids of distinct parts, checked against the library."""
        got = {p: self.vocabulary.part(p) for p in parts}
        # The library puts a space in front by itself.
        wanted = self.vocabulary.lib.encode([p[1:].replace(SPACE, " ") for p in parts], num_threads=1)
        for p, ids in zip(parts, wanted, strict=True):
            if got[p] != ids and p != SPACE:
                raise AssertionError(f"the library encodes {p!r} as {ids}, not {got[p]}")
        return {p: array("i", ids).tobytes() for p, ids in got.items()}

    def of_parts(self, parts: list[str]) -> list[bytes]:
        """Ids of distinct parts, in their order, remembered."""
        if len(self.known) > self.keep:
            self.known = {"": b""}
        table = dict(zip(parts, map(self.known.get, parts), strict=True))
        found = self.learn([p for p, ids in table.items() if ids is None])
        table.update(found)
        self.known.update((p, ids) for p, ids in found.items() if len(p) <= KEEP_LENGTH)
        return list(table.values())

    def bodies(self, texts: pa.Array) -> Iterator[list[int]]:
        """Ids of each text of a column, without an end id."""
        for some in column_slices(texts):
            cut = cut_before_spaces(some)
            ids, ends = cut.joined(self.of_parts(cut.parts), np.dtype(np.int32))
            yield from (ids[a:b].tolist() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True))

    def encode(self, texts: list[str]) -> list[list[int]]:
        return list(self.bodies(pa.array(texts, pa.string())))

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.vocabulary.lib.decode(ids) if ids else []


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per worker process."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def piece_digests(docs: DataFrame, key: str = "doc_id", text: str = "text", model: str | None = None) -> DataFrame:
    """One row per document: key, n_tokens with the end id, and SHA-256 of the ids and of the decoded text. A null
    text counts as empty; an empty text has the end id alone."""
    path = model or tokenizer_file("piece_bpe_32k.model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        end = enc.vocabulary.end
        digits = [str(i) for i in range(len(enc.vocabulary.pieces))]

        def sha(text: str) -> str:
            return hashlib.sha256(text.encode()).hexdigest()

        for batch in batches:
            counts: list[int] = []
            names: list[str] = []
            decoded: list[str] = []
            for ids in enc.bodies(batch.column(1)):
                ids.append(end)
                counts.append(len(ids))
                names.append(sha(" ".join(map(digits.__getitem__, ids))))
                decoded.append(sha(enc.vocabulary.lib.decode(ids)))
            keys = batch.column(0)
            yield pa.RecordBatch.from_arrays(
                [keys, pa.array(counts, pa.int64()), pa.array(names, pa.string()), pa.array(decoded, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
