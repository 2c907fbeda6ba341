"""Token counts of whole texts under unigram piece scores, by dynamic programming over a trie of words.

The best segmentation of a word is the one with the largest sum of piece scores; of equal sums, the one with the
fewest tokens. The forward score of a prefix is the same in all words that share it, so the distinct words of a batch
are walked as a trie: sorted, they are its depth-first order, and a stack holds the scores of the prefixes on the
path, one per depth. What lies below the common prefix with the word before is computed, once; the rest stands on the
stack. Counts at word ends are remembered per worker, up to a bound.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import tokenizer_file
from .parts import column_slices, cut_before_spaces

KEEP_WORDS = 1_000_000
KEEP_LENGTH = 64
UNKNOWN_PENALTY = 10.0


class UnigramCounter:
    """scores: piece -> score. A character that no piece covers counts as its UTF-8 bytes."""

    def __init__(self, scores: dict[str, float], keep: int = KEEP_WORDS):
        self.scores, self.keep = scores, keep
        self.longest = max(map(len, scores), default=1)
        self.unknown = min(scores.values(), default=0.0) - UNKNOWN_PENALTY
        self.known: dict[str, int] = {}

    def learn(self, words: list[str]) -> Iterator[tuple[str, int]]:
        """(word, tokens) of distinct words; a word's last state is its terminal count."""
        scores, longest = self.scores, self.longest
        best: list[tuple[float, int]] = [(0.0, 0)]  # (score, -tokens) of the prefixes on the path
        last = ""
        for word in sorted(words):
            shared, most = 0, min(len(word), len(last))
            while shared < most and word[shared] == last[shared]:
                shared += 1
            del best[shared + 1:]
            for end in range(shared + 1, len(word) + 1):
                s, n = best[end - 1]
                c = word[end - 1]
                top = (s + self.unknown, n - len(c.encode())) if c not in scores else (s + scores[c], n - 1)
                for start in range(max(0, end - longest), end - 1):
                    own = scores.get(word[start:end])
                    if own is not None:
                        s, n = best[start]
                        if (s + own, n - 1) > top:
                            top = (s + own, n - 1)
                best.append(top)
            yield word, -best[-1][1]
            last = word

    def of_words(self, words: list[str]) -> list[int]:
        """Tokens of distinct words, in their order, remembered."""
        if len(self.known) > self.keep:
            self.known = {}
        table = dict(zip(words, map(self.known.get, words), strict=True))
        found = dict(self.learn([w for w, n in table.items() if n is None]))
        table.update(found)
        self.known.update((w, n) for w, n in found.items() if len(w) <= KEEP_LENGTH)
        return list(table.values())

    def count(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(words, tokens) of each text of a column."""
        words, tokens = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for some in column_slices(texts):
            cut = cut_before_spaces(some)
            words.append(cut.summed([w != "" for w in cut.parts]))
            tokens.append(cut.summed(self.of_words(cut.parts)))
        return np.concatenate(words), np.concatenate(tokens)


def model_scores(path: str) -> dict[str, float]:
    """Scores of the ordinary pieces of a SentencePiece model file."""
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=path)
    return {lib.id_to_piece(i): lib.get_score(i) for i in range(lib.get_piece_size())
            if not (lib.is_unknown(i) or lib.is_control(i) or lib.is_byte(i) or lib.is_unused(i))}


_counters: dict[str, UnigramCounter] = {}


def counter(path: str) -> UnigramCounter:
    """One per worker process."""
    if path not in _counters:
        _counters[path] = UnigramCounter(model_scores(path))
    return _counters[path]


def token_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", model: str | None = None) -> DataFrame:
    """One row per document: key, n_words (runs of spaces with what follows) and n_tokens. Null and empty texts have
    neither."""
    path = model or tokenizer_file("piece_bpe_32k.model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path).count
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, count(batch.column(1)))],
                                             names=["doc_id", "n_words", "n_tokens"])

    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_words long, n_tokens long")
