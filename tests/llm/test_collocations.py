"""Collocations against a plain count of all phrases, and their parts."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from llm_cases import corpus, odd_texts  # noqa: F401

from rosterline.llm import collocations as C

LOWER = {i: i + 32 for i in range(65, 91)}


def slow(rows, least, longest=5, top=2000, cover=100):
    """rows: (text, lang)."""
    f, n = {}, Counter()
    for text, lang in rows:
        own = f.setdefault(lang or "und", Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            for m in range(1, longest + 1):
                own.update(tuple(words[i:i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, own in f.items():
        cands = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        inside = Counter()
        for p, a in cands.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    inside[p[i:i + m]] = max(inside[p[i:i + m]], a)
        scored = []
        for p, a in cands.items():
            if inside[p] and 100 * inside[p] >= cover * a:
                continue
            score, k = min((1000 * a * n[lang] // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def phrases(rng, n):
    words = ["alpha", "Beta", "gamma", "delta", "é", "x-y", "zeta", "|"]
    fixed = ["alpha beta gamma delta zeta", "x-y é x-y é", "zeta zeta zeta zeta zeta zeta zeta"]
    out = []
    for _ in range(n):
        parts = [rng.choice(fixed) if rng.random() < 0.4 else " ".join(rng.choices(words, k=rng.randint(0, 7))) for _ in range(4)]
        out.append("".join(p + rng.choice([". ", ", ", "\n", "\t", "  ", "\x0b", "!?"]) for p in parts))
    return out


@pytest.mark.parametrize("least, cover", [(2, 100), (5, 100), (3, 60)])
def test_as_counted_plainly(spark, least, cover):
    rng = random.Random(least)
    rows = [(t, rng.choice(["en", "de", None, "und"])) for t in phrases(rng, 60)] + [(None, "en"), ("", None), ("one", "xx")]
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(5)
    got = sorted(tuple(r) for r in C.collocations(docs, least=least, cover=cover).collect())
    assert got == slow(rows, least, cover=cover)


def test_the_best_alone_and_ties_by_bytes(spark):
    rows = [("ab cd. ef gh. éa zz. zz éa", "en")] * 3
    docs = spark.createDataFrame(rows, "text string, lang string")
    for top in (1, 2, 5):
        got = sorted(tuple(r) for r in C.collocations(docs, least=3, top=top).collect())
        assert got == slow(rows, 3, top=top) and len(got) == min(top, 4)


def test_odd_texts_and_clashing_columns(spark, corpus, odd_texts):
    docs = corpus(odd_texts * 2).withColumns({c: F.lit("x") for c in ("phrase", "prefix", "part", "a", "n", "rank", "score")})
    got = sorted(tuple(r) for r in C.collocations(docs, least=2).collect())
    assert got == slow([(t, "en") for t in odd_texts * 2], 2)


def test_no_rows_and_no_words(spark, corpus):
    assert C.collocations(corpus([])).count() == 0
    assert C.collocations(corpus([None, "", ". ,", "one"]), least=1).count() == 0


def test_long_prefixes_are_merged_from_many_parts(spark, monkeypatch):
    """A very common word, followed by many words, in texts that are counted in many chunks."""
    monkeypatch.setattr(C, "CHUNK_BYTES", 500)
    monkeypatch.setattr(C, "COMMON", 1000)
    rng = random.Random(1)
    rows = [(" ".join(f"the w{rng.randrange(40)}" for _ in range(30)), "en") for _ in range(80)]
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(7)
    levels = C.stripe_levels(docs, least=5)
    the = levels[1].filter("prefix = 'the'")
    assert the.count() > 5 and the.groupBy("part").count().filter("count > 1").count() == 0
    total = the.select(F.explode("counts").alias("c")).agg(F.sum("c")).first()[0]
    assert total == 80 * 30
    got = sorted(tuple(r) for r in C.collocations(docs, least=5).collect())
    assert got == slow(rows, 5)


def test_whole_numbers_beyond_64_bits(spark):
    cases = [(98765432109876, 198765432109876, 9876543217, 9876543211), (5, 7, 2, 3), (10 ** 13, 10 ** 13, 10 ** 13, 10 ** 13)]
    df = spark.createDataFrame(cases, "a long, n long, l long, r long")
    got = [r[0] for r in df.select(C.floor_score(*map(F.col, "anlr"))).collect()]
    assert got == [1000 * a * n // (le * r) for a, n, le, r in cases]


def test_counting_a_chunk_takes_a_few_times_its_text():
    """Found by the reviewer: a Python object a word, in each of an executor's workers, took the executor's memory."""
    import tracemalloc

    rng = random.Random(7)
    texts = [" ".join(f"w{rng.randint(0, 5000)}" for _ in range(100_000)).encode() + b". Last\tone\x0b" for _ in range(4)]
    size = sum(map(len, texts))
    C._tokens(texts[:1])
    tracemalloc.start()
    try:
        tokens = C._tokens(texts)
        assert tracemalloc.get_traced_memory()[1] < 6 * size
    finally:
        tracemalloc.stop()
    want = " ".join(t.decode().lower().replace(".", " . ").replace("\x0b", " . ") + " . " for t in texts).split()
    assert [t.decode() for t in tokens.to_pylist()] == want


def test_stripes_of_a_chunk_as_counted_plainly():
    import numpy as np

    rng = random.Random(3)
    texts = [t.encode() for t in phrases(rng, 40)] + [b"", b" . ", b"\t"]
    everything = np.full(1 << 24, 255, np.uint8)  # all phrases pass, all prefixes are common
    for size in (1, 2, 3):
        got = Counter()
        for batch in C.stripes_of("en", texts, size, everything):
            for prefix, nexts, counts in zip(*(batch.column(c).to_pylist() for c in (1, 3, 4)), strict=True):
                got.update({(prefix, n): c for n, c in zip(nexts, counts, strict=True)})
        want = Counter()
        for text in texts:
            for piece in re.split(rb"[.,;:!?\x0A-\x0D]", text.lower()):
                words = [w.decode() for w in re.findall(rb"[^\x20\x09]+", piece)] + [C.END]
                want.update((" ".join(words[i:i + size]), words[i + size]) for i in range(len(words) - size))
        assert got == want
    assert not list(C.stripes_of("en", [b"", b" \t"], 1, everything))
    assert sum(b.num_rows for b in C.stripes_of("en", [b"", b" \t"], 0, None)) == 0


def test_what_cannot_be_frequent_leaves_no_task(spark):
    """Prefixes that only rare words or ends of pieces follow have no stripes; counts of prefixes come from the level before."""
    rng = random.Random(2)
    rows = [(". ".join(f"often seen word{i}{j}" for j in range(3)), "en") for i in range(20)] + [("often seen", "en")] * 5
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "text string, lang string")
    levels = C.stripe_levels(docs, least=10)
    assert [tuple(r) for r in levels[1].select("prefix", "nexts", "counts").collect()] == [("often", ["seen"], [65])]
    assert not any(t.count() for t in levels[2:])
    assert sorted(tuple(r) for r in C.collocations(docs, least=10).collect()) == slow(rows, 10)


def test_stripes_of_a_chunk_take_few_bytes_a_word():
    import tracemalloc

    import numpy as np

    from rosterline.llm import blooms

    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(20000)]
    texts = [" ".join(rng.choices(words, k=400)).encode() for _ in range(1000)]
    rare = np.zeros(1 << (blooms.FILTER_BITS - 3), np.uint8)
    rare[:] = 0b01111111  # most prefixes are frequent, and few of them common
    whole = np.full(1 << (blooms.FILTER_BITS - 3), 255, np.uint8)
    for bits, most in ((rare, 55), (whole, 80)):
        tracemalloc.start()
        try:
            assert sum(b.num_rows for b in C.stripes_of("en", texts, 1, bits, ends=False)) > 0
            assert tracemalloc.get_traced_memory()[1] < most * 400_000
        finally:
            tracemalloc.stop()
