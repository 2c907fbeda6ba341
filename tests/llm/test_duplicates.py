"""Exact groups, SimHash groups and repeated strings against brute force."""

import hashlib
import random
import string
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from llm_cases import corpus, odd_texts  # noqa: F401

from rosterline.llm import exact as X, repeats as R, simhash as H, suffixes as U
from rosterline.llm.common import components, materialize

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


# --- exact -----------------------------------------------------------------------------

def test_exact_groups(corpus, odd_texts):
    long = "z" * 300
    texts = [*odd_texts, "Same Text", "sAME tEXT", "É", "é", long + "1", long + "2", long + "1", None]
    rows = X.exact_groups(corpus(texts).withColumn("kept", F.lit(1)).withColumn("_n", F.lit(2))).collect()
    groups = defaultdict(list)
    for i, t in enumerate(texts):
        groups[(t or "").translate(LOWER)].append(i)
    for r in rows:
        t = (texts[r.doc_id] or "").translate(LOWER)
        own = groups[t]
        assert (r.keep_id, r.group_size, r.kept) == (max(own), len(own), r.doc_id == max(own))
        assert r.text_sha256 == hashlib.sha256(t.encode()).hexdigest()
    assert X.exact_groups(corpus([])).collect() == []


def test_repeated_rows_keep_one(corpus):
    rows = X.exact_groups(corpus(["t"] * 6 + ["u"], ids=[5, 5, 5, None, None, 1, None])).collect()
    kept = [(r.doc_id, r.keep_id) for r in rows if r.kept]
    assert sorted(kept, key=str) == [(5, 5), (None, None)]
    assert {r.group_size for r in rows} == {6, 1}


def test_drop_exact(corpus):
    texts = ["a b", "A b", "c", "c", None, "", "d", "d"]
    docs = corpus(texts, ids=[1, 2, 3, 3, 4, 5, 6, 7]).withColumn("group_size", F.lit("x"))
    out = X.drop_exact(docs)
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect()) == [2, 3, 5, 7]
    assert X.drop_exact(corpus([])).collect() == []


# --- near ------------------------------------------------------------------------------

def slow_fingerprint(text):
    import re

    import xxhash

    words = re.findall(r"[^\x20\x09-\x0D]+", text.translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprint(odd_texts):
    for t in odd_texts:
        assert H.fingerprint((t or "").encode()) == slow_fingerprint(t or "")


def slow_components(fps):
    """Smallest index reachable over differences of at most 4 bits."""
    n, label = len(fps), list(range(len(fps)))
    moved = True
    while moved:
        moved = False
        for i in range(n):
            for j in range(n):
                if (fps[i] ^ fps[j]).bit_count() <= 4 and label[j] < label[i]:
                    label[i], moved = label[j], True
    return label


@pytest.mark.parametrize("seed", [1, 2])
def test_links_of_fingerprints_at_all_distances(spark, seed):
    rng = random.Random(seed)
    fps = []
    for _ in range(12):
        base = rng.getrandbits(64)
        for distance in range(0, 8):  # also 4 bits in one half, where only the other half's values meet
            bits = rng.sample(range(32), distance) if rng.random() < 0.5 else rng.sample(range(64), distance)
            fps.append(base ^ sum(1 << b for b in bits))
    rows = materialize(spark.createDataFrame(
        [(i, H._signed(f)) for i, f in enumerate(fps)], "doc_id long, fp long"), "t")
    got = {r.doc_id: r.component_id for r in H.near_groups(rows, "doc_id").collect()}
    assert [got[i] for i in range(len(fps))] == slow_components(fps)


def test_near_duplicates(corpus, odd_texts):
    base = " ".join(f"w{i}" for i in range(400))
    near = [base + f" tail{i}" for i in range(30)]
    texts = [*odd_texts, base, *near, *["copy copy"] * 20]
    docs = corpus(texts).withColumn("fp", F.lit(1)).withColumn("component_id", F.lit("x"))
    rows = {r.doc_id: r for r in H.near_duplicates(docs).collect()}
    fps = [slow_fingerprint(t or "") for t in texts]
    want = slow_components(fps)
    assert [rows[i].fingerprint for i in range(len(texts))] == [f"{f:016x}" for f in fps]
    assert [rows[i].component_id for i in range(len(texts))] == want
    assert H.near_duplicates(corpus([])).collect() == []


def test_near_duplicates_with_null_and_repeated_keys(corpus):
    rows = H.near_duplicates(corpus(["a b c d e"] * 4 + ["z"], ids=[7, None, 7, 9, None])).collect()
    assert sorted(((r.doc_id, r.component_id) for r in rows), key=str) == [(7, 7), (7, 7), (9, 7), (None, 7), (None, None)]


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(200, 260)]
    edges = spark.createDataFrame([*chain, *star, (300, 260), (260, 5), (9, 9)], "a long, b long")
    got = {r.node: r.label for r in components(edges).collect()}
    assert {got[i] for i in range(100, 161)} == {100}
    assert {got[i] for i in (7, *range(200, 260))} == {7}
    assert (got[300], got[260], got[5]) == (5, 5, 5)
    assert components(edges.limit(0)).collect() == []


# --- repeated strings ------------------------------------------------------------------

@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 3), max_size=60))
def test_suffix_array_and_common_prefixes(symbols):
    s = [*symbols, 0]
    sa = U.suffix_array(np.array(s), 4).tolist()
    assert sa == sorted(range(len(s)), key=lambda i: s[i:])
    plcp = U.common_prefixes(np.array(s), np.array(sa))
    for a, b in zip(sa, sa[1:]):
        shared = 0
        while shared < min(len(s) - a, len(s) - b) and s[a + shared] == s[b + shared]:
            shared += 1
        assert plcp[b] == shared


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(max_size=40).map(lambda b: bytes(x % 2 + 97 for x in b)), max_size=6))
def test_repeated_starts(pieces):
    count = Counter(p[i:i + 5] for p in pieces for i in range(len(p) - 4))
    want = [[i for i in range(len(p) - 4) if count[p[i:i + 5]] > 1] for p in pieces]
    assert [x.tolist() for x in U.repeated_starts(pieces, 5)] == want


def test_regions_cover_every_window_once_wherever_batches_end(monkeypatch):
    rng = random.Random(4)
    texts = [bytes(rng.choice(b"abcd") for _ in range(rng.choice([0, 10, 199, 200, 201, 1500]))) for _ in range(40)]
    whole = sorted(R.regions(texts, 200))
    for t, body in enumerate(texts):
        starts = sorted((s, n) for i, s, n, _, _ in whole if i == t)
        assert [s + k for s, n in starts for k in range(n - 199)] == list(range(max(0, len(body) - 199)))
    monkeypatch.setattr(R, "BATCH_BYTES", 700)
    assert sorted(R.regions(texts, 200)) == whole
    monkeypatch.setattr(R, "CHUNK", 300)
    cut = sorted(R.regions(texts, 200))
    assert sum(n - 199 for _, _, n, _, _ in cut) == sum(n - 199 for _, _, n, _, _ in whole)


def slow_removal(texts, length=200):
    bodies = [(t or "").encode() for t in texts]
    count = Counter(b[i:i + length] for b in bodies for i in range(len(b) - length + 1))
    out = []
    for b in bodies:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if count[b[i:i + length]] > 1:
                gone[i:i + length] = True
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((len(b), int(gone.sum()), spans, hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~gone])).hexdigest()))
    return out


@pytest.mark.parametrize("group_bytes", [R.GROUP_BYTES, 300])
def test_removal(spark, corpus, odd_texts, monkeypatch, group_bytes):
    rng = random.Random(7)
    prose = lambda n: "".join(rng.choice("abcdefgh éü") for _ in range(n))
    passage, line = prose(450), prose(210)
    texts = [*odd_texts, "y" * 450, *[prose(rng.randint(0, 300)) + passage + prose(rng.randint(0, 300)) for _ in range(12)],
             *[line + prose(50) + line for _ in range(3)], *[passage[20:260] + prose(5)] * 2, prose(700)]
    texts += [texts[-1], texts[-1][:-1] + "!", prose(199), prose(200)]
    monkeypatch.setattr(R.repeated_spans, "__defaults__", (group_bytes,))
    docs = corpus(texts).withColumn("n_removed", F.lit("x")).withColumn("_k", F.lit(1))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in R.removal_report(docs).collect()}
    want = slow_removal(texts)
    assert [got[i] for i in range(len(texts))] == want
    assert R.removal_report(corpus([])).collect() == []
