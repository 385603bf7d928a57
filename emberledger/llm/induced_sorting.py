"""Suffix arrays by induced sorting, on numpy arrays.

Suffixes are classified as smaller (S) or larger (L) than their right
neighbour; leftmost S suffixes (LMS) are sorted through the names of their
substrings, recursively where names repeat; all others are induced from them
in one pass for L and one for S. On byte texts a pass goes through the buckets
of first symbols and moves a whole run of a bucket at once. In the recursion, on
names, it goes through columns of the runs of one type, or, where such runs are
long, suffix by suffix.
"""

from __future__ import annotations

import numpy as np

BYTES = 256
#: Length of a run of one type up to which the recursion works by columns.
LONGEST = 100


def classify(s: np.ndarray) -> np.ndarray:
    """Which suffixes are of type S; the last one is of type L."""
    n = len(s)
    out = np.zeros(n, bool)
    if n < 2:
        return out
    up, same = s[:-1] < s[1:], s[:-1] == s[1:]
    # a run of equal symbols is decided by the first that differs
    at = np.where(same, n - 1, np.arange(n - 1))
    at = np.minimum.accumulate(at[::-1])[::-1]
    out[:-1] = np.append(up, False)[at]
    return out


def _induce_runs(s: np.ndarray, is_s: np.ndarray, lms: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All suffixes from LMS suffixes in order, bucket by bucket."""
    n = len(s)
    ends = np.cumsum(counts)
    starts = ends - counts
    s_counts = np.bincount(s[is_s], minlength=BYTES)
    middles = ends - s_counts  # where the S suffixes of a bucket begin
    lms_counts = np.bincount(s[lms], minlength=BYTES)
    sa = np.full(n, -1, np.int32)
    order = np.argsort(s[lms], kind="stable")
    first = np.cumsum(lms_counts) - lms_counts
    symbols = s[lms][order]
    sa[middles[symbols] + np.arange(len(lms)) - first[symbols]] = lms[order]

    def put(q: np.ndarray, at: np.ndarray, step: int) -> None:
        symbols = s[q]
        by = np.argsort(symbols, kind="stable")
        symbols = symbols[by]
        many = np.bincount(symbols, minlength=BYTES)
        place = np.arange(len(q)) - (np.cumsum(many) - many)[symbols]
        sa[at[symbols] + place if step > 0 else at[symbols] - 1 - place] = q[by]
        at += step * many

    used = np.flatnonzero(counts)
    at = starts.copy()
    sa[at[s[n - 1]]] = n - 1
    at[s[n - 1]] += 1
    for c in used.tolist():
        done = starts[c]
        while done < at[c]:  # a run of equal symbols comes back to its bucket
            q = sa[done : at[c]] - 1
            done = at[c]
            q = q[q >= 0]
            q = q[~is_s[q]]
            if len(q):
                put(q, at, 1)
        if lms_counts[c]:
            put(sa[middles[c] : middles[c] + lms_counts[c]] - 1, at, 1)  # what precedes an LMS suffix is L
    at = ends.copy()
    for c in used[::-1].tolist():
        done = ends[c]
        while at[c] < done:
            q = sa[at[c] : done][::-1] - 1
            done = at[c]
            q = q[q >= 0]
            q = q[is_s[q]]
            if len(q):
                put(q, at, -1)
        if middles[c] > starts[c]:
            q = sa[starts[c] : middles[c]][::-1] - 1
            q = q[q >= 0]
            q = q[is_s[q]]
            if len(q):
                put(q, at, -1)
    return sa


def _stable_order(keys: np.ndarray) -> np.ndarray:
    """A stable order of small integers, sixteen bits at a time."""
    order = np.argsort(keys.astype(np.uint16), kind="stable")
    if int(keys.max(initial=0)) >> 16:
        order = order[np.argsort((keys >> 16).astype(np.uint16)[order], kind="stable")]
    return order


def _by_runs(text: np.ndarray, start: np.ndarray, stop: np.ndarray, rank: np.ndarray, stop_bit: int) -> np.ndarray:
    """Suffixes that run through one type and stop at a ranked suffix of the
    other, in order: column by column from the right, each suffix entering at
    the column where it stops. Of equal symbols type L sorts before type S."""
    length = stop - start
    order = np.lexsort((rank[stop], length))
    start, length = start[order], length[order]
    most = int(length[-1]) if len(length) else 0
    edges = np.searchsorted(length, np.arange(most + 2))
    now = start[:0]
    for column in range(most, -1, -1):
        new = start[edges[column] : edges[column + 1]]
        keys = np.concatenate([2 * text[now + column] + (1 - stop_bit), 2 * text[new + column] + stop_bit])
        now = np.concatenate([now, new])[_stable_order(keys)]
    return now


def _induce_columns(s: np.ndarray, is_s: np.ndarray, lms: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The same for alphabets of any size and runs of one type that are short:
    L suffixes from the LMS suffixes they run into, then S from L."""
    n = len(s)
    text = np.append(s.astype("i8") + 1, 0)  # the end sorts before every symbol
    lms = lms[_stable_order(s[lms])]
    rank = np.full(n + 1, -1, "i8")
    rank[lms] = np.arange(len(lms))
    place = np.arange(n + 1)

    def following(mask: np.ndarray) -> np.ndarray:
        return np.minimum.accumulate(np.where(np.append(mask, True), place, n)[::-1])[::-1]

    large, small = np.flatnonzero(~is_s), np.flatnonzero(is_s)
    large = _by_runs(text, large, following(is_s)[large], rank, 1)
    rank[large] = np.arange(len(large))
    small = _by_runs(text, small, following(~is_s)[small], rank, 0)
    both = np.concatenate([large, small])
    return both[_stable_order(s[both])].astype(np.int32)


def _induce_steps(s: np.ndarray, is_s: np.ndarray, lms: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The same suffix by suffix, for alphabets of any size."""
    n = len(s)
    ends = np.cumsum(counts)
    starts = ends - counts
    middles = ends - np.bincount(s[is_s], minlength=len(counts))
    text, kind = s.tolist(), is_s.tolist()
    sa = [-1] * n
    at = middles.tolist()
    for i in lms.tolist():
        c = text[i]
        sa[at[c]] = i
        at[c] += 1
    at = starts.tolist()
    sa[at[text[-1]]] = n - 1
    at[text[-1]] += 1
    for i in sa:
        if i > 0 and not kind[i - 1]:
            c = text[i - 1]
            sa[at[c]] = i - 1
            at[c] += 1
    at = ends.tolist()
    for k in range(n - 1, -1, -1):
        i = sa[k]
        if i > 0 and kind[i - 1]:
            c = text[i - 1]
            at[c] -= 1
            sa[at[c]] = i - 1
    return np.array(sa, np.int32)


def suffix_array(s: np.ndarray) -> np.ndarray:
    """The suffixes of ``s`` (integers from 0) in order; the end of the text
    sorts before every symbol."""
    n = len(s)
    if n < 2:
        return np.arange(n, dtype=np.int32)
    is_s = classify(s)
    lms = np.flatnonzero(is_s[1:] & ~is_s[:-1]).astype(np.int32) + 1
    small = int(s.max()) < BYTES
    counts = np.bincount(s, minlength=BYTES if small else 0)
    if small and n > 4 * BYTES:
        induce = _induce_runs
    else:
        edges = np.flatnonzero(np.append(is_s[1:] != is_s[:-1], True))
        induce = _induce_columns if int(np.diff(edges, prepend=-1).max()) <= LONGEST else _induce_steps
    if not len(lms):
        return induce(s, is_s, lms, counts)
    by_substring = induce(s, is_s, lms, counts)
    is_lms = np.zeros(n + 1, bool)
    is_lms[lms] = True
    order = by_substring[is_lms[by_substring]]
    number = np.empty(n, np.int32)
    number[lms] = np.arange(len(lms))
    # equal neighbours in the order get equal names; the last substring, cut by the end, is like no other
    length = np.append(np.diff(lms), n)[number[order]]
    a, b = order[:-1], order[1:]
    check = np.flatnonzero(length[:-1] == length[1:])
    equal = np.zeros(len(order), bool)
    offset = 0
    while len(check):
        same = s[a[check] + offset] == s[b[check] + offset]
        check = check[same]
        finished = length[check] == offset
        equal[check[finished] + 1] = True
        check = check[~finished]
        offset += 1
    names = np.empty(len(lms), np.int32)
    names[number[order]] = np.cumsum(~equal) - 1
    if equal.any():
        order = lms[suffix_array(names)]
    return induce(s, is_s, order, counts)


def common_prefixes(s: np.ndarray, sa: np.ndarray, most: int) -> np.ndarray:
    """For each suffix in text order, the length of the prefix it shares with
    the suffix before it in ``sa`` (the permuted array), counted up to
    ``most``. ``s`` is of bytes; eight are compared at a time."""
    n = len(s)
    out = np.zeros(n, np.int32)
    if n < 2:
        return out
    wide = np.concatenate([s.astype(np.uint8), np.zeros(most + 16, np.uint8)])
    words = np.ndarray((n + most + 8,), "<u8", wide.tobytes(), strides=(1,))
    before = np.empty(n, np.int32)
    before[sa[1:]] = sa[:-1]
    before[sa[0]] = n
    active = np.flatnonzero(before < n)
    other = before[active]
    for step in range(0, most, 8):
        differ = words[active + step] ^ words[other + step]
        same = differ == 0
        x = differ[~same]
        low = x & (~x + np.uint64(1))
        out[active[~same]] = step + (np.log2(low.astype("f8")).astype(np.int32) >> 3)
        active, other = active[same], other[same]
    out[active] = most
    # a suffix ends where the text does
    return np.minimum(np.minimum(out, most), np.minimum(n - np.arange(n), n - np.where(before < n, before, 0)))
