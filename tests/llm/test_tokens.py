"""Piece encoding, word ids, packing, trie counts and the id store against the libraries and brute force."""

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from llm_cases import corpus, odd_texts  # noqa: F401

from rosterline.llm import idstore as I, packing as K, sentencepieces as SP, triecounts as TC, wordids as W
from rosterline.llm.common import tokenizer_file

PIECES, WORDS = tokenizer_file("piece_bpe_32k.model"), tokenizer_file("word_bpe_49k.json")
TEXT = st.text(st.one_of(st.sampled_from("aAbteEhis \n\t.,'▁<|>09éÉßñ"), st.characters(codec="utf-8")), max_size=60)


@pytest.fixture(scope="module")
def words_library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(WORDS)


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXT, max_size=6))
def test_pieces_as_the_library(texts):
    enc = SP.encoder(PIECES)
    ids = enc.encode(texts)
    assert ids == enc.vocabulary.lib.encode(texts)


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXT, max_size=6))
def test_word_ids_as_the_library(texts):
    enc = W.word_encoder(WORDS)
    want = [e.ids for e in enc.lib.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(b, "<u4").tolist() for b in enc.encode(texts)] == want


def test_memory_is_bounded_and_forgetting_changes_nothing(odd_texts):
    texts = [t or "" for t in odd_texts]
    for make in (SP.Encoder, W.WordEncoder):
        path = PIECES if make is SP.Encoder else WORDS
        small, large = make(path, keep=3), make(path)
        assert [small.encode([t])[0] for t in texts for _ in range(2)] == [large.encode([t])[0] for t in texts for _ in range(2)]
        assert all(len(p) <= 64 for p in large.known)


def test_a_wrong_part_is_found_out():
    enc = SP.Encoder(PIECES)
    enc.vocabulary.rank = {p: r for p, r in enc.vocabulary.rank.items() if p != "▁the"}
    with pytest.raises(AssertionError):
        enc.encode(["the"])


def test_piece_digests(corpus, odd_texts):
    lib = SP.encoder(PIECES).vocabulary.lib
    for r in SP.piece_digests(corpus(odd_texts).withColumn("n_tokens", F.lit(0))).collect():
        ids = lib.encode(odd_texts[r.doc_id] or "") + [lib.eos_id()]
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(lib.decode(ids).encode()).hexdigest()
    assert SP.piece_digests(corpus([])).collect() == []


# --- packing ---------------------------------------------------------------------------

@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=40), st.integers(1, 9))
def test_differencing_deals_every_item_once(sizes, windows):
    dealt = K.difference(sizes, windows)
    assert sorted(i for w in dealt for i in w) == list(range(len(sizes)))
    assert len(dealt) <= windows


def test_differencing_evens_out():
    # The textbook case: largest differencing leaves 2 between the sums, where greedy dealing leaves 4.
    assert sorted(sum([8, 7, 6, 5, 4][i] for i in w) for w in K.difference([8, 7, 6, 5, 4], 2)) == [14, 16]
    sizes = np.random.default_rng(3).integers(1, 1000, 400).tolist()
    sums = [sum(sizes[i] for i in w) for w in K.difference(sizes, 20)]
    assert max(sums) - min(sums) <= 5


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=40))
def test_windows_rise_until_nothing_is_over(sizes):
    dealt = K.pack(sizes, 50)
    assert all(sum(sizes[i] for i in w) <= 50 for w in dealt)
    assert sorted(i for w in dealt for i in w) == list(range(len(sizes)))


def test_packed_pieces(corpus, odd_texts, words_library):
    texts = [*odd_texts, None, *["one two three"] * 50]
    docs = corpus(texts, partitions=2).withColumn("offset", F.lit("x")).withColumn("start", F.lit("y"))
    out = K.packed_pieces(docs, capacity=512, piece=128, block=4, with_ids=True)
    rows = out.collect()
    ids = {i: [*words_library.encode(t or "", add_special_tokens=False).ids, 2] for i, t in enumerate(texts)}
    found = {i: [] for i in ids}
    by_sequence = {}
    for r in rows:
        part = ids[r.doc_id][r.start:r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes()) and r.doc_tokens == len(ids[r.doc_id])
        assert np.frombuffer(r.ids, "<u4").tolist() == part
        found[r.doc_id].append((r.start, r.length))
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for i, parts in found.items():
        at = 0
        for start, n in sorted(parts):
            assert start == at
            at += n
        assert at == len(ids[i])
    for parts in by_sequence.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 512
    joined = {r.sequence_id: r for r in K.sequences(out).collect()}
    assert {s: r.length for s, r in joined.items()} == {s: sum(n for _, n in p) for s, p in by_sequence.items()}
    assert all(len(r.ids) == 4 * r.length for r in joined.values())
    assert K.packed_pieces(corpus([])).collect() == []


def test_little_padding(corpus):
    rng = np.random.default_rng(5)
    texts = [" ".join(["word"] * int(n)) for n in rng.integers(5, 3000, 1500)]
    rows = K.packed_pieces(corpus(texts, partitions=1)).collect()
    assert sum(r.length for r in rows) / (4096 * len({r.sequence_id for r in rows})) > 0.97


@pytest.mark.parametrize("least, most", [(1, 2), (1, 4), (3, 8), (8, 16), (60, 70)])
def test_little_padding_of_short_documents(corpus, least, most):
    rng = np.random.default_rng(6)
    texts = [" ".join(["word"] * int(n - 1)) for n in rng.integers(least, most + 1, 200_000 // (least + most))]
    rows = K.packed_pieces(corpus(texts, partitions=1)).toPandas()
    windows = rows.groupby("sequence_id")["length"].sum()
    assert len(rows) == len(texts) and windows.max() <= 4096
    assert len(windows) <= rows["length"].sum() / 4096 * 1.01 + 1


def test_bundles_keep_order_and_size():
    assert K.bundled([9, 3, 4, 8, 1, 2, 6, 12, 1], 8) == [[0], [3], [1, 2, 4], [7], [5, 6], [8]]
    assert K.bundled([], 8) == [] and K.bundled([1, 1, 1], 1) == [[0], [1], [2]]


# --- unigram counts --------------------------------------------------------------------

def slow_count(word, scores, unknown):
    best = [(0.0, 0)] + [None] * len(word)
    for end in range(1, len(word) + 1):
        options = []
        for start in range(end):
            piece = word[start:end]
            s, n = best[start]
            if piece in scores:
                options.append((s + scores[piece], n - 1))
            elif end - start == 1:
                options.append((s + unknown, n - len(piece.encode())))
        best[end] = max(options)
    return -best[-1][1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("abcé▁", max_size=9), max_size=30),
       st.dictionaries(st.text("abc▁", min_size=1, max_size=4), st.integers(-9, -1).map(float), max_size=12))
def test_trie_walk_against_each_word_by_itself(words, scores):
    c = TC.UnigramCounter(scores)
    got = dict(c.learn(list(set(words))))
    assert got == {w: slow_count(w, scores, c.unknown) for w in set(words)}


def test_counts_as_the_unigram_model(corpus, odd_texts):
    """Another library's unigram model finds segmentations of the same total score."""
    from tokenizers import Tokenizer, models

    scores = TC.model_scores(PIECES)
    vocabulary = [("<unk>", 0.0), *scores.items()]
    lib = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=False))
    c = TC.counter(PIECES)
    for word in ["▁the", "▁reading", "▁international", "▁unbelievable", "▁thshereanted", "▁Zusammenhang"]:
        pieces = lib.encode(word).tokens
        assert "".join(pieces) == word
        [tokens] = c.count(pa.array([word[1:]]))[1]
        assert tokens <= len(pieces) and tokens == slow_count(word, scores, c.unknown)


def test_token_counts(corpus, odd_texts):
    c = TC.counter(PIECES)
    small = TC.UnigramCounter(TC.model_scores(PIECES), keep=2)
    for r in TC.token_counts(corpus(odd_texts)).collect():
        text = odd_texts[r.doc_id] or ""
        words = re.findall("▁+[^▁]*", (" " + text).replace(" ", "▁")) if text else []
        long = len(text) > 1000
        want = tuple(int(n[0]) for n in small.count(pa.array([text]))) if long else \
            (len(words), sum(slow_count(w, c.scores, c.unknown) for w in words))
        assert (r.n_words, r.n_tokens) == want
    assert TC.token_counts(corpus([])).collect() == []


# --- id store --------------------------------------------------------------------------

@pytest.mark.parametrize("n", [1, 2, 3, 10, 1000, 20000])
def test_perfect_hash(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 1 << 64, n, dtype=np.uint64))
    entries = np.zeros(len(keys), I.SLOT)
    entries["at"] = np.arange(len(keys))
    part = I.index_part(keys, entries)
    found, there = I.look_up(part, keys)
    assert there.all() and found["at"].tolist() == list(range(len(keys)))
    strange = keys + np.uint64(1)
    assert I.look_up(part, strange[~np.isin(strange, keys)])[1].sum() == 0
    # One slot a key, and a seed for every few keys.
    assert len(part) == 16 + 4 * -(-len(keys) // 4) + I.SLOT.itemsize * len(keys)


def test_store_round_trip(spark, corpus, odd_texts, words_library, tmp_path):
    texts = [*odd_texts, *["copy of one key"] * 40]
    ids = [*range(len(odd_texts) - 1), None, *[99] * 40]
    docs = corpus(texts, ids=ids).withColumn("shard", F.lit("x")).withColumn("key", F.lit(0))
    rows = I.id_report(docs).collect()
    coded = sorted(((-1 if i is None else i), [*words_library.encode(t or "", add_special_tokens=False).ids, 1])
                   for i, t in zip(ids, texts, strict=True))
    at, want = 0, []
    for i, own in coded:
        want.append((i, at, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
        at += len(own)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in rows) == want
    assert I.id_report(corpus([])).collect() == []


def test_keyed_access(spark, corpus, words_library, tmp_path):
    texts = [f"text number {i} of some" for i in range(300)]
    I.write_store(corpus(texts), str(tmp_path / "store"), shards=5)
    asked = spark.createDataFrame([(7,), (250,), (10**9,)], "key long")
    found = I.read_ids(spark, str(tmp_path / "store"), I.places_of(spark, str(tmp_path / "store"), asked), with_ids=True)
    got = {r.key: np.frombuffer(r.ids, "<u4").tolist() for r in found.collect()}
    assert got == {i: [*words_library.encode(texts[i], add_special_tokens=False).ids, 1] for i in (7, 250)}
