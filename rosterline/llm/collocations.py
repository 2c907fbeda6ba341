"""Phrase collocations by the stripes pattern.

A stripe is a prefix of 0 to 4 words with a counter of the words that follow it; the end of a piece is one more entry.
Tasks count stripes of their own texts, and stripes of the same prefix are merged entry by entry. A merged stripe gives all
that scoring needs: its entries are the counts of phrases one word longer, and the largest of them tells whether a longer phrase
covers the prefix. The count of the prefix is an entry of the level before.

Levels go from the empty prefix up. A phrase can only be frequent if the phrases without its first and without its last
word are, so a level counts prefixes that were frequent on the level before, and following words whose own
phrase was; other words, and prefixes that only they follow, leave their tasks on no level. What was frequent reaches the tasks as a
Bloom filter of fixed size: it lets some phrases through in vain, but never holds one back, and counts are exact.

The stripe of a very common prefix can be as long as the vocabulary, so it is dealt into parts by a hash of the following word.
Which prefixes are that common, the filter tells as well; those it lets through in vain are dealt into parts by all tasks alike.
Parts are merged in the order of a sort, one at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window, functions as F

from .blooms import bloom, contains, opened
from .common import materialize

LEAST = 100  # occurrences of a candidate
LONGEST = 5  # words
TOP = 2000  # of each language
COVER = 100  # percent of a phrase's occurrences within a longer one that drop it
UNKNOWN = "und"

BREAKS = b".,;:!?\n\x0b\x0c\r"
END, RARE = ".", ","  # neither can be in a word
_TO_END = bytes.maketrans(BREAKS, b"." * len(BREAKS))

ROOT_PARTS, PARTS = 1024, 32
COMMON = 200_000  # occurrences from which a prefix's stripe is dealt into parts, and so the most entries of one that isn't
CHUNK_BYTES = 8 << 20  # of texts that are counted together in a task
ROWS = 20_000  # of a batch handed to Spark

STRIPES = "lang string, prefix string, part int, nexts array<string>, counts array<long>"


# --- which phrases were frequent -----------------------------------------------------

def _mixed(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase with one more word."""
    h = h + word
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    return h


def _hashed(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


_COMMON = np.uint64(0x5851F42D4C957F2D)  # turns a phrase's hash into that of its being common


def phrase_filter(phrases: DataFrame) -> Broadcast:
    """The Bloom filter of phrases (lang, phrase, a), which also knows those that are common."""
    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for lang, phrase, n in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                h = _hashed([lang.encode()])
                for word in _hashed(phrase.encode().split(b" ")):
                    h = _mixed(h, word)
                out += [h, _mixed(h, _COMMON)] if n >= COMMON else [h]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, np.uint64), *out]).view(np.int64))], names=["h"])

    return bloom(phrases.select("lang", "phrase", "a").mapInArrow(hashes, "h long"))


# --- counting in tasks ---------------------------------------------------------------

def _tokens(texts: list[bytes]) -> pa.DictionaryArray:
    """Words of the texts, with an END after each piece (and some more), as places in their vocabulary. Arrow cuts them: an
    object a word would take several times the text."""
    body = (b".".join(texts) + b".").lower().translate(_TO_END).replace(b".", b" . ").strip()
    whole = pa.Array.from_buffers(pa.large_string(), 1, [None, pa.py_buffer(np.array([0, len(body)], np.int64)), pa.py_buffer(body)])
    cut = pc.ascii_split_whitespace(whole).flatten().dictionary_encode()
    return pa.DictionaryArray.from_arrays(cut.indices, cut.dictionary.cast(pa.large_binary()).cast(pa.binary()))


def _listed(lang: str, prefixes: pa.Array, owner: np.ndarray, part: np.ndarray, names: pa.Array, entry: np.ndarray,
            counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Entries (places in names), sorted by owner (a place in prefixes) and part, as stripes."""
    if not len(owner):
        return
    new = np.flatnonzero(np.concatenate(([True], (owner[1:] != owner[:-1]) | (part[1:] != part[:-1]))))
    edges = np.append(new, len(owner)).astype(np.int32)
    for at in range(0, len(new), ROWS):
        first, last = edges[at], edges[min(at + ROWS, len(new))]
        offsets = pa.array(edges[at:at + ROWS + 1] - first)
        rows = new[at:at + ROWS]
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(rows), pa.string()), prefixes.take(pa.array(owner[rows])).cast(pa.string()),
             pa.array(part[rows].astype(np.int32)),
             pa.ListArray.from_arrays(offsets, names.take(pa.array(entry[first:last])).cast(pa.string())),
             pa.ListArray.from_arrays(offsets, pa.array(counts[first:last].astype(np.int64)))],
            names=["lang", "prefix", "part", "nexts", "counts"])


def _ranks(ids: np.ndarray, many: int) -> np.ndarray:
    """The place of each number among the distinct ones, all of which are below `many`."""
    seen = np.zeros(many, bool)
    seen[ids] = True
    return (np.cumsum(seen) - 1)[ids]


def stripes_of(lang: str, texts: list[bytes], size: int, bits: np.ndarray | None, ends: bool = True) -> Iterator[pa.RecordBatch]:
    """Stripes of prefixes of `size` words of the texts. Without ends, entries of what can't be part of a frequent phrase are left out."""
    coded = _tokens(texts)
    ids, words = coded.indices.to_numpy(), coded.dictionary
    del coded
    known = words.to_pylist()
    hashes = _hashed(known)
    end = known.index(END.encode())
    if not size:
        counts = np.bincount(ids, minlength=len(known))
        kept = np.array([i for i in range(len(known)) if i != end], np.int64)
        part = (hashes[kept] % np.uint64(ROOT_PARTS)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        yield from _listed(lang, pa.array([b""]), np.zeros(len(kept), np.int64), part[order], words, kept[order], counts[kept[order]])
        return
    n = len(ids) - size
    if n <= 0:
        return
    # Hash of the phrase of `size` words that begins at each place, the last one included that can follow a prefix.
    whole = np.ones(n + 1, bool)
    h = np.full(n + 1, _hashed([lang.encode()])[0])
    for j in range(size):
        here = ids[j:j + n + 1]
        whole &= here != end
        h = _mixed(h, hashes[here])
    frequent = np.zeros(n + 2, bool)
    at = np.flatnonzero(whole)
    frequent[at] = contains(bits, h[at])
    at = np.flatnonzero(frequent[:n] if ends else frequent[:n] & frequent[1:n + 1] & (ids[size:] != end))
    del whole
    wide = len(known) + 2
    owner = _ranks(ids[at], len(known))  # words are numbered already, so they need no sorting
    for j in range(1, size):
        owner *= wide
        owner += ids[at + j]
        owner = np.unique(owner, return_inverse=True)[1]
    sample = np.zeros(owner.max(initial=-1) + 1, np.int64)
    sample[owner[::-1]] = at[::-1]  # a place of each prefix
    common = contains(bits, _mixed(h[sample], _COMMON))
    del h
    follow = ids[at + size]
    follow[~frequent[at + 1] & (follow != end)] = len(known) + 1
    follow[follow == end] = len(known)
    del at, frequent
    pairs = owner  # in its place
    pairs *= wide
    pairs += follow
    del owner, follow
    prefixes = [words.take(pa.array(ids[sample + j])) for j in range(size)]
    prefix = pc.binary_join_element_wise(*prefixes, b" ") if size > 1 else prefixes[0]
    pairs, counts = np.unique(pairs, return_counts=True)
    owner = (pairs // wide).astype(np.int32)
    pairs -= owner * np.int64(wide)
    entry, counts = pairs.astype(np.int32), counts.astype(np.int32)
    del pairs
    part = np.zeros(len(owner), np.int8)
    spread = common[owner]
    if spread.any():  # else they are in order
        part[spread] = np.concatenate(((hashes % np.uint64(PARTS)).astype(np.int8), np.zeros(2, np.int8)))[entry[spread]]
        order = np.lexsort((part, owner))
        owner, part, entry, counts = owner[order], part[order], entry[order], counts[order]
        del order
    names = pa.concat_arrays([words, pa.array([END.encode(), RARE.encode()])])
    yield from _listed(lang, prefix, owner, part, names, entry, counts)


def _scan(size: int, bits) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        weight = 0
        flags = opened(bits) if bits is not None else None

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, texts in held.items():
                yield from stripes_of(lang, texts, size, flags, ends=False)
                texts.clear()
                pa.default_memory_pool().release_unused()
            held.clear()

        for batch in batches:
            for lang, body in zip(batch.column(0), batch.column(1), strict=True):  # an object at a time, not for the whole batch
                text = body.as_py()
                held.setdefault(lang.as_py(), []).append(text)
                weight += len(text)
                if weight >= CHUNK_BYTES:
                    yield from flush()
                    weight = 0
        yield from flush()
    return run


# --- merging -------------------------------------------------------------------------

def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stripes sorted by (lang, prefix, part), those of one part added up entry by entry. One part is held at a time."""
    held: tuple | None = None  # key, nexts, counts
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = list(zip(*[batch.column(c).to_pylist() for c in range(3)], strict=True))
        lists = batch.column(3)
        nexts, counts = lists.flatten(), batch.column(4).flatten()
        sizes = np.diff(lists.offsets.to_numpy())
        if held is not None:
            keys = [held[0], *keys]
            nexts, counts = pa.concat_arrays([held[1], nexts]), pa.concat_arrays([held[2], counts])
            sizes = np.concatenate(([len(held[1])], sizes))
        new = np.array([True, *[a != b for a, b in zip(keys, keys[1:])]])
        firsts = np.flatnonzero(new)
        run = np.repeat(np.cumsum(new) - 1, sizes)
        summed = pa.table({"run": pa.array(run), "next": nexts, "count": counts}).group_by(["run", "next"]) \
            .aggregate([("count", "sum")]).sort_by("run")
        run = summed["run"].to_numpy()
        nexts, counts = summed["next"].combine_chunks(), summed["count_sum"].combine_chunks()
        edges = np.searchsorted(run, np.arange(len(firsts) + 1)).astype(np.int32)
        last = int(edges[len(firsts) - 1])
        done = [keys[i] for i in firsts[:-1]]
        if done:
            offsets = pa.array(edges[:len(firsts)])
            yield _rows(done, pa.ListArray.from_arrays(offsets, nexts[:last]), pa.ListArray.from_arrays(offsets, counts[:last]))
        held = (keys[firsts[-1]], nexts[last:], counts[last:])
    if held is not None:
        offsets = pa.array([0, len(held[1])], pa.int32())
        yield _rows([held[0]], pa.ListArray.from_arrays(offsets, held[1]), pa.ListArray.from_arrays(offsets, held[2]))


def _rows(keys: list[tuple], nexts: pa.Array, counts: pa.Array) -> pa.RecordBatch:
    lang, prefix, part = zip(*keys, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(prefix, pa.string()), pa.array(part, pa.int32()),
                                       nexts, counts], names=["lang", "prefix", "part", "nexts", "counts"])


def _entries(stripes: DataFrame, least: int) -> DataFrame:
    """(lang, phrase, a): the frequent phrases that a level's stripes count."""
    each = stripes.select("lang", "prefix", F.explode(F.arrays_zip("nexts", "counts")).alias("e"))
    phrase = F.when(F.col("prefix") == "", F.col("e.nexts")).otherwise(F.concat_ws(" ", "prefix", "e.nexts"))
    return each.filter((F.col("e.counts") >= least) & ~F.col("e.nexts").isin(END, RARE)) \
        .select("lang", phrase.alias("phrase"), F.col("e.counts").alias("a"))


def stripe_levels(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST,
                  longest: int = LONGEST) -> list[DataFrame]:
    """The merged stripes of prefixes of 0 to longest - 1 words, as written tables (lang, prefix, part, nexts, counts).
    Stripes of the empty prefix hold all words; later ones only words that make a phrase with `least` occurrences."""
    rows = docs.select(F.coalesce(F.col(f"`{lang}`"), F.lit(UNKNOWN)).cast("string").alias("lang"),
                       F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("text"))
    levels: list[DataFrame] = []
    bits = None
    for size in range(longest):
        order = ["lang", "prefix", "part"]
        merged = rows.mapInArrow(_scan(size, bits), STRIPES).repartition(*order).sortWithinPartitions(*order) \
            .mapInArrow(_merge, STRIPES)
        if size:  # nothing asks for rare entries any more
            entries = F.filter(F.arrays_zip("nexts", "counts"), lambda e: e["counts"] >= least)
            merged = merged.select("lang", "prefix", "part", entries.alias("e")).filter(F.size("e") > 0) \
                .select("lang", "prefix", "part", F.col("e.nexts").alias("nexts"), F.col("e.counts").alias("counts"))
        levels.append(materialize(merged, f"stripes-{size}"))
        if size + 1 < longest:
            bits = phrase_filter(_entries(levels[-1], least))
    return levels


# --- scores --------------------------------------------------------------------------

def floor_score(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 a n / (l r)) on whole numbers of up to 38 digits."""
    wide = lambda c: c.cast("decimal(19,0)")
    over, under = wide(a) * wide(n) * F.lit(1000).cast("decimal(4,0)"), wide(left) * wide(right)
    return ((over - over % under) / under).cast("long")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST,
                 top: int = TOP, cover: int = COVER) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of 2 to `longest` words of each language.

    A null text counts as empty, a null language as `und`. A phrase needs `least` occurrences. It is dropped if `cover`
    percent of them lie in one longer phrase; a longer phrase that covers it has one of one word more in between, so
    stripes one level up tell. Scores are those of the worst cut, the first of equal ones. Ties of score and count are ordered by
    the phrase's bytes. Without texts there are no rows. Other columns are left out."""
    levels = stripe_levels(docs, text, lang, least, longest)
    total = F.aggregate("counts", F.lit(0).cast("long"), lambda acc, x: acc + x)
    own = F.filter(F.arrays_zip("nexts", "counts"), lambda e: ~e["nexts"].isin(END, RARE))
    best = F.array_max(F.transform(own, lambda e: e["counts"]))
    words = levels[0].groupBy("lang").agg(F.sum(total).alias("n"))
    longer = [t.groupBy("lang", F.col("prefix").alias("phrase")).agg(F.max(best).alias("longer")) for t in levels[1:]]
    longer = materialize(reduce(DataFrame.union, longer).filter(F.col("longer") >= least), "longer")
    found = materialize(reduce(DataFrame.union, [_entries(t, least) for t in levels[1:]]), "phrases")
    known = materialize(_entries(levels[0], least), "words").union(found).select("lang", "phrase", F.col("a").alias("f"))
    tail = F.expr("substring(phrase, instr(phrase, ' ') + 1)")
    before = found.groupBy("lang", tail.alias("phrase")).agg(F.max("a").alias("earlier"))
    covered = F.greatest(F.coalesce("longer", F.lit(0)), F.coalesce("earlier", F.lit(0)))
    covered = F.when(covered >= least, covered).otherwise(F.lit(0))  # only a candidate can cover
    kept = found.join(longer.hint("merge"), ["lang", "phrase"], "left") \
        .join(before.hint("merge"), ["lang", "phrase"], "left").filter(100 * covered < cover * F.col("a")) \
        .select("lang", "phrase", "a", F.split("phrase", " ").alias("w"))
    cut = kept.select("lang", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", F.array_join(F.slice("w", 1, F.col("k")), " ").alias("first"),
        F.array_join(F.slice("w", F.col("k") + 1, F.size("w") - F.col("k")), " ").alias("rest"))
    parts = [known.select("lang", F.col("phrase").alias(c), F.col("f").alias(f)).hint("merge") for c, f in (("first", "l"), ("rest", "r"))]
    # Every language has one total; it is copied to as many salts as its phrases are spread over.
    salts = 64
    spread = words.select("lang", "n", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    scored = cut.join(parts[0], ["lang", "first"]).join(parts[1], ["lang", "rest"]) \
        .withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(salts)).cast("int")) \
        .join(spread.hint("merge"), ["lang", "salt"]) \
        .withColumn("score", floor_score(F.col("a"), F.col("n"), F.col("l"), F.col("r")))
    worst = scored.groupBy("lang", "phrase", "salt", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("m")) \
        .select("lang", "phrase", "salt", "a", "n", "m.score", "m.l", "m.r")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    # The first of each salt, then the first of those: no task ranks a whole language.
    near = worst.withColumn("_r", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("_r") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    return near.withColumn("rank", rank.cast("long")).filter(F.col("rank") <= top) \
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
