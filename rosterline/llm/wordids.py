"""Ids by the tokenizers library, each distinct part of a text encoded once per worker as long as it is held."""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex

from .parts import column_slices, cut_at_blanks

KEEP_PARTS = 750_000
KEEP_LENGTH = 64
WIDE = np.dtype("<u4")


#: Printable ASCII and Latin letters: composed already, with one lower case each that all Unicode versions share.
PLAIN = re.compile(f"[!-~À-įı-ɏ]{{1,{KEEP_LENGTH}}}")


class WordEncoder:
    """Ids of whole texts for a tokenizer that lower-cases, drops white space and never looks across it, as
    word_bpe_49k.json.

    Texts are cut at spaces, tabs and line ends. Parts of up to KEEP_LENGTH characters are remembered, up to a bound,
    then memory starts anew; longer parts go to the library each time. A new part of Latin letters and ASCII marks is
    lower-cased and cut by the tokenizer's own pattern first, so that a word is encoded once for all its cases and
    the marks around it. All else goes to the library as it is."""

    def __init__(self, path: str, keep: int = KEEP_PARTS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a task per core already
        from tokenizers import Tokenizer

        self.lib, self.keep = Tokenizer.from_file(path), keep
        probe = ["ab", "'ll", "7", "éa", "ab7'LL\n\tABÉa"]
        a, b, c, d, e = (x.ids for x in self.lib.encode_batch(probe, add_special_tokens=False))
        spec = json.loads(self.lib.to_str())
        split = [p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        self.pattern = regex.compile(split[0]["pattern"]["Regex"])
        self.marks = re.compile("|".join(re.escape(t["content"]) for t in spec["added_tokens"]) or "(?!)")
        # The model reads bytes as characters: those that print as themselves, the others from 256 on.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.to_bytes = {b: 256 + i for i, b in enumerate(x for x in range(256) if x not in shown)}
        self.forget()
        if e != [*a, *c, *b, *self.lib.encode("abéa", add_special_tokens=False).ids] or \
                self.by_model(["éa"])["éa"] != np.array(d, WIDE).tobytes():
            raise ValueError("the tokenizer doesn't lower-case and drop white space")

    def forget(self) -> None:
        self.known: dict[str, bytes] = {"": b""}
        self.words: dict[str, bytes] = {}

    def by_library(self, parts: list[str]) -> dict[str, bytes]:
        """Ids of any parts. A few thousand at a time: the library's results are much larger than the ids."""
        found: dict[str, bytes] = {}
        for at in range(0, len(parts), 4096):
            some = parts[at:at + 4096]
            for part, e in zip(some, self.lib.encode_batch_fast(some, add_special_tokens=False), strict=True):
                found[part] = np.array(e.ids, WIDE).tobytes()
        return found

    def by_model(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words as the pattern cuts them, by the tokenizer's model alone."""
        tokenize, to_bytes = self.lib.model.tokenize, self.to_bytes
        return {w: array("I", [t.id for t in tokenize(
            w if w.isascii() else w.encode().decode("latin-1").translate(to_bytes))]).tobytes() for w in words}

    def learn(self, parts: list[str]) -> dict[str, bytes]:
        """Ids of distinct parts."""
        words, plain, marked = self.words, PLAIN.fullmatch, self.marks.search
        some = [p for p in parts if plain(p)]
        one = {p: p.lower() for p in some if p.isalpha()}  # a letter run is one word of the pattern
        cut = {p: self.pattern.findall(p.lower()) for p in some if p not in one and not marked(p)}
        need = set(one.values())
        need.update(chain.from_iterable(cut.values()))
        words.update(self.by_model(list(need.difference(words))))
        found = self.by_library([p for p in parts if p not in one and p not in cut])
        found.update(zip(one, map(words.__getitem__, one.values()), strict=True))
        for p, own in cut.items():
            found[p] = b"".join(map(words.__getitem__, own))
        return found

    def of_parts(self, parts: list[str]) -> list[bytes]:
        """Ids of distinct parts, in their order, remembered."""
        if len(self.known) > self.keep:
            self.forget()
        table = dict(zip(parts, map(self.known.get, parts), strict=True))
        found = self.learn([p for p, ids in table.items() if ids is None])
        table.update(found)
        self.known.update(found if max(map(len, found), default=0) <= KEEP_LENGTH else
                          {p: ids for p, ids in found.items() if len(p) <= KEEP_LENGTH})
        return list(table.values())

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        return list(self.bodies(pa.array(texts, pa.string())))

    def bodies(self, texts: pa.Array) -> Iterator[bytes]:
        """The same of a column of any length, a bounded number of bytes at a time."""
        for some in column_slices(texts):
            cut = cut_at_blanks(some)
            ids, ends = cut.joined(self.of_parts(cut.parts), WIDE)
            yield from (ids[a:b].tobytes() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True))


_encoders: dict[str, WordEncoder] = {}


def word_encoder(path: str, keep: int = KEEP_PARTS) -> WordEncoder:
    """One per worker process, which remembers up to `keep` parts from task to task."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    _encoders[path].keep = keep
    return _encoders[path]
