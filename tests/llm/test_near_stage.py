"""The pipeline's near-duplicate stage against brute force over all pairs of fingerprints."""

import random

import corpus_pipeline as P
from llm_cases import corpus  # noqa: F401
from test_duplicates import slow_components, slow_fingerprint


def copies(rng, n_bases=25):
    """Texts, each with copies in which words are replaced so that fingerprints lie on both sides of 4 bits."""
    out = []
    for _ in range(n_bases):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.randint(60, 300))]
        out.append(" ".join(words))
        for share in (0.002, 0.005, 0.01, 0.02, 0.05):
            copy = [f"x{rng.randrange(5000)}" if rng.random() < share else w for w in words]
            out.append(" ".join(copy).replace("w1", "W1"))
    return out


def test_one_document_of_each_group_stays(spark, corpus):
    texts = [*copies(random.Random(3)), "", " \n", "one two", "one  Two", "one two three", None]
    want = slow_components([slow_fingerprint(t or "") for t in texts])
    sizes = [want.count(c) for c in set(want)]
    assert sizes.count(1) > 10 and sum(s > 1 for s in sizes) > 10
    assert {r.doc_id for r in P.distinct_enough(spark, corpus(texts), "").collect()} == set(want)


def test_a_crowd_of_look_alikes_loses_no_link(spark, corpus):
    rng = random.Random(4)
    template = [f"t{i}" for i in range(400)]
    texts = [" ".join(w if rng.random() > 0.004 else f"o{rng.randrange(10 ** 6)}" for w in template) for _ in range(400)]
    want = slow_components([slow_fingerprint(t) for t in texts])
    assert {r.doc_id for r in P.distinct_enough(spark, corpus(texts), "").collect()} == set(want)


def test_shared_passages_alone_are_no_copies(spark, corpus):
    rng = random.Random(5)
    line = " ".join(f"l{i}" for i in range(40))
    texts = [line + " " + " ".join(f"u{rng.randrange(10 ** 6)}" for _ in range(80)) for _ in range(60)]
    assert P.distinct_enough(spark, corpus(texts), "").count() == 60
