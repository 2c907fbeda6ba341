"""The trie of rebuilt conversations against one that is put together."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from rosterline.llm import convtrie as C

TALKS = "conv_id long, turn long, role string, text string"


def slow(rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            sha = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            by[conv].append(((turn is not None, turn or 0, int(sha[:15], 16), int(sha[15:30], 16)), (role, text)))
    own = {c: [x for _, x in sorted(v, key=lambda p: p[0])] for c, v in by.items()}
    rebuilt = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = own.get(c - c % 5, [])[:h] + own[c][h:]
    members, children = defaultdict(list), defaultdict(list)
    for c, s in rebuilt.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    for k in members:
        if k:
            children[k[:-1]].append(k)
    leaves, saved, out = {}, {}, []
    for k in sorted(members, key=len, reverse=True):
        leaves[k] = sum(leaves[x] for x in children[k]) or 1
        saved[k] = ((len(members[k]) - 1) * len(k[-1][1].encode()) if k else 0) + sum(saved[x] for x in children[k])
    for k, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(rebuilt[c]) == len(k))))
        out.append((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(children[k]), leaves[k], saved[k],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: r[:2])


def run(spark, rows, partitions=4):
    out = C.conversation_trie(spark.createDataFrame(rows, TALKS).repartition(partitions))
    return sorted([tuple(r) for r in out.collect()], key=lambda r: r[:2])


def talks(rng, n, longest=14):
    rows = []
    for c in rng.sample(range(3 * n), n):
        for t in range(rng.randint(1, longest)):
            rows.append((c, t, rng.choice(["user", "assistant"]) if t else "user", rng.choice(["hi", "yes", "né", f"{rng.randrange(4)}"])))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_as_put_together(spark, seed):
    rows = talks(random.Random(seed), 60)
    assert run(spark, rows) == slow(rows)


def test_nulls_ties_repeats_and_missing_bases(spark):
    rows = [(1, None, None, None), (1, 0, "user", None), (1, None, "a", "b"), (2, 5, "user", "x"), (2, 5, "user", "x"),
            (3, 1, "user", ""), (None, 0, "user", "nobody"), (7, 1, "a", "bc"), (8, 1, "ab", "c"), (5, 0, "", ""), (6, 0, "", "")]
    assert run(spark, rows) == slow(rows)


def test_turnless_conversations_and_no_rows(spark):
    lone = [(c, 0, "user", "only") for c in range(1, 200) if c % 5]  # bases are absent, heads are cut off
    got = run(spark, lone)
    assert got == slow(lone) and got[0][1] == 0 and got[0][7] != hashlib.sha256(b"").hexdigest()
    assert run(spark, []) == []


def test_one_conversation_holds_most_turns(spark, monkeypatch):
    monkeypatch.setattr(C, "BLOCK", 16)
    rng = random.Random(4)
    for giant in (10, 11):  # a base and one with a base
        rows = talks(rng, 20, 6) + [(giant + 100, t, "user", rng.choice("ab")) for t in range(700)]
        assert run(spark, rows) == slow(rows)


def test_many_equal_conversations_and_digests_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(C, "PIECE", 7)
    rows = [(c, t, "user", "same") for c in range(0, 1500, 5) for t in range(2)] + [(c, 0, "user", f"u{c}") for c in range(3, 6000, 5)]
    assert run(spark, rows) == slow(rows)


def test_equal_fingerprints_of_different_turns_are_noticed(spark, monkeypatch):
    rows = talks(random.Random(9), 30) + [(200, 0, "a", "x"), (200, 1, "a", "y"), (205, 0, "a", "y"), (205, 1, "a", "x")]
    monkeypatch.setattr(C, "BASES", [(1, 1), *C.BASES])  # under which the order of turns doesn't count
    assert run(spark, rows) == slow(rows)
    monkeypatch.setattr(C, "BASES", [(1, 1)])
    with pytest.raises(RuntimeError):
        run(spark, rows)


def test_clashing_columns(spark):
    rows = talks(random.Random(3), 25)
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], TALKS + ", depth long, last string, part int")
    assert sorted([tuple(r) for r in C.conversation_trie(df).collect()], key=lambda r: r[:2]) == slow(rows)
