"""Suffix arrays by induced sorting, and common prefixes by the permuted order, with whole buckets moved at a time.

A suffix is S-type if it is smaller than the next one, else L-type; an S-type suffix behind an L-type one is leftmost-
smaller. Sorting the leftmost-smaller suffixes is enough: one pass over the buckets from the left induces the L-types
from them, one from the right the S-types. They are sorted by their substrings first (induced alike), which are named,
and where names repeat, the string of names is sorted in turn: by recursion while its alphabet is small, else by
doubling of ranks, which array operations do faster than a pass over as many buckets as there are suffixes."""

from __future__ import annotations

import numpy as np

BUCKETS = 4096  # largest alphabet that is sorted bucket by bucket


def _types(s: np.ndarray) -> np.ndarray:
    """True for S-type. The last symbol is the smallest and occurs once."""
    n = len(s)
    step = np.zeros(n, np.int8)
    step[:-1] = (s[1:] > s[:-1]).astype(np.int8) - (s[1:] < s[:-1])
    step[-1] = 1
    at = np.where(step != 0, np.arange(n, dtype=np.int32), np.int32(n))
    following = np.minimum.accumulate(at[::-1])[::-1]  # where the next step that isn't level is
    return step[following] > 0


def _induce(s: np.ndarray, small: np.ndarray, ends: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Suffix array from the leftmost-smaller suffixes in the given order."""
    n, k = len(s), len(ends)
    starts = np.concatenate(([0], ends[:-1]))
    sa = np.full(n, -1, np.int32)

    # Leftmost-smaller suffixes at their buckets' ends, kept apart while L-types are induced.
    first = s[order]
    grouped = order[np.argsort(first, kind="stable")]
    sizes = np.bincount(first, minlength=k)
    upto = np.cumsum(sizes)
    head = starts.copy()

    def scatter(at: np.ndarray) -> np.ndarray:
        """Append suffixes to the heads of their buckets in order; returns the counts."""
        c = s[at]
        turn = np.argsort(c, kind="stable")
        c, at = c[turn], at[turn]
        counts = np.bincount(c, minlength=k)
        before = np.cumsum(counts) - counts
        sa[head[c] + np.arange(len(c)) - before[c]] = at
        np.add(head, counts, out=head)
        return counts

    for c in range(k):
        lo = starts[c]
        while lo < head[c]:  # the bucket's L-types, with those it gives to itself
            hi = head[c]
            at = sa[lo:hi] - 1
            at = at[at >= 0]
            at = at[~small[at]]
            lo = hi
            if len(at):
                scatter(at)
        at = grouped[upto[c] - sizes[c]:upto[c]] - 1
        at = at[at >= 0]
        at = at[~small[at]]
        if len(at):
            scatter(at)

    large = head  # the L-types of a bucket end here
    tail = ends.copy()

    def scatter_down(at: np.ndarray) -> None:
        c = s[at]
        turn = np.argsort(c, kind="stable")
        c, at = c[turn], at[turn]
        counts = np.bincount(c, minlength=k)
        before = np.cumsum(counts) - counts
        sa[tail[c] - 1 - (np.arange(len(c)) - before[c])] = at
        np.subtract(tail, counts, out=tail)

    sa[0] = n - 1  # the end symbol
    for c in range(k - 1, -1, -1):
        hi = ends[c]
        while hi > tail[c]:
            lo = tail[c]
            at = sa[lo:hi][::-1] - 1
            at = at[at >= 0]
            at = at[small[at]]
            hi = lo
            if len(at):
                scatter_down(at)
        at = sa[starts[c]:large[c]][::-1] - 1
        at = at[at >= 0]
        at = at[small[at]]
        if len(at):
            scatter_down(at)
    sa[0] = n - 1
    return sa


def _same_substrings(s: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether s[a:a+length] equals s[b:b+length], pair by pair."""
    same = np.ones(len(a), bool)
    open_ = np.arange(len(a))
    for o in range(64):
        open_ = open_[length[open_] > o]
        if not len(open_):
            return same
        equal = s[a[open_] + o] == s[b[open_] + o]
        same[open_[~equal]] = False
        open_ = open_[equal]
    for i in open_[length[open_] > 64].tolist():
        same[i] = np.array_equal(s[a[i] + 64:a[i] + length[i]], s[b[i] + 64:b[i] + length[i]])
    return same


def _by_doubling(names: np.ndarray) -> np.ndarray:
    """Suffix array of a string of names by doubling; only suffixes that still share their rank are sorted on."""
    n = len(names)
    rank = np.unique(names, return_inverse=True)[1].astype(np.int64)
    counts = np.bincount(rank)
    rank = (np.cumsum(counts) - counts)[rank]  # the place of the first of equals
    open_ = np.flatnonzero(counts[np.searchsorted(np.cumsum(counts) - counts, rank)] > 1) if len(counts) < n else []
    h = 1
    while len(open_):
        later = open_ + h
        second = np.where(later < n, rank[np.minimum(later, n - 1)], -1)
        order = np.lexsort((second, rank[open_]))
        at, one, two = open_[order], rank[open_][order], second[order]
        fresh_one = np.concatenate(([True], one[1:] != one[:-1]))
        fresh = fresh_one | np.concatenate(([True], two[1:] != two[:-1]))
        i = np.arange(len(at))
        group = np.maximum.accumulate(np.where(fresh_one, i, 0))
        lead = np.maximum.accumulate(np.where(fresh, i, 0))
        rank[at] = one + (lead - group)
        alone = fresh & np.concatenate((fresh[1:], [True]))
        open_ = at[~alone]
        h *= 2
    sa = np.empty(n, np.int64)
    sa[rank] = np.arange(n)
    return sa


def suffix_array(s: np.ndarray, alphabet: int) -> np.ndarray:
    """Order of the suffixes of s, symbols below `alphabet`; the last symbol must be 0 and the only 0."""
    n = len(s)
    if n <= 2 or alphabet > BUCKETS:
        return _by_doubling(s)
    s = s.astype(np.uint16)
    ends = np.cumsum(np.bincount(s, minlength=alphabet))
    small = _types(s)
    lms = (np.flatnonzero(small[1:] & ~small[:-1]) + 1).astype(np.int32)
    rough = _induce(s, small, ends, lms)
    mark = np.zeros(n, bool)
    mark[lms] = True
    lms_sorted = rough[mark[rough]]
    place = np.empty(n, np.int32)
    place[lms] = np.arange(len(lms))
    nxt = np.concatenate((lms[1:], [n - 1]))
    length = (nxt - lms + 1)[place[lms_sorted]]
    same = np.zeros(len(lms_sorted), bool)
    pairs = np.flatnonzero(length[1:] == length[:-1]) + 1
    same[pairs] = _same_substrings(s, lms_sorted[pairs - 1], lms_sorted[pairs], length[pairs])
    names = np.empty(len(lms), np.int64)
    names[place[lms_sorted]] = np.cumsum(~same) - 1
    count = int((~same).sum())
    if count == len(lms):
        return _induce(s, small, ends, lms_sorted)
    return _induce(s, small, ends, lms[suffix_array(names, count)])


def common_prefixes(s: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """For each place of s, the length that its suffix shares with the one before it in the suffix array (0 for the
    first), the permuted array of common prefixes. Where the symbols in front of both agree and they stand next to
    each other's predecessors, it is one less than in the place before; only the other places are compared."""
    n = len(s)
    phi = np.full(n, -1, np.int32)
    phi[sa[1:]] = sa[:-1]
    place = np.arange(n, dtype=np.int32)
    reducible = np.zeros(n, bool)
    reducible[1:] = (phi[1:] > 0) & (phi[1:] == phi[:-1] + 1) & (s[:-1] == s[np.maximum(phi[1:], 1) - 1])
    plcp = np.zeros(n, np.int32)
    open_ = np.flatnonzero(~reducible & (phi >= 0))
    got = np.zeros(len(open_), np.int64)
    who = np.arange(len(open_))
    width = 4
    while len(who):
        a, b = open_[who] + got[who], phi[open_[who]] + got[who]
        span = np.arange(width)
        x, y = a[:, None] + span, b[:, None] + span
        differ = (x >= n) | (y >= n) | (s[np.minimum(x, n - 1)] != s[np.minimum(y, n - 1)])
        stop = differ.any(1)
        got[who] += np.where(stop, differ.argmax(1), width)
        who = who[~stop]
        width = min(64, width * 2)
    plcp[open_] = got
    lead = np.maximum.accumulate(np.where(reducible, 0, place))
    return np.where(reducible, plcp[lead] - (place - lead), plcp)


def repeated_starts(pieces: list[bytes], length: int) -> list[np.ndarray]:
    """For each piece, the places at which a string of `length` bytes starts that starts elsewhere in the pieces too."""
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    if not sizes.sum():
        return [np.zeros(0, np.int64) for _ in pieces]
    # Bytes are symbols 2..257; 1 ends a piece, 0 ends the text.
    joined = np.frombuffer(b"\0".join(pieces) + b"\0\0", np.uint8).astype(np.uint16) + 2
    ends = np.cumsum(sizes + 1) - 1
    joined[ends] = 1
    joined[-1] = 0
    sa = suffix_array(joined, 258)
    shared = common_prefixes(joined, sa)[sa] >= length
    hit = np.zeros(len(joined), bool)
    hit[sa[shared]] = True
    hit[sa[np.flatnonzero(shared) - 1]] = True
    first = ends - sizes
    # A string that runs past its piece isn't one.
    return [np.flatnonzero(hit[a:max(a, b - length + 1)]) for a, b in zip(first.tolist(), ends.tolist(), strict=True)]
