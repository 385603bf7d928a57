import hashlib
import random

import numpy as np
import pytest

from emberledger.llm import induced_sorting as I
from emberledger.llm import suffix_dedup as S


def brute(rows, span=50):
    data = [(i, (t or "").encode()) for i, t in rows]
    first = {}
    for i, t in data:
        if i is not None:
            for p in range(len(t) - span + 1):
                w = t[p : p + span]
                first[w] = min(i, first.get(w, i))
    out = []
    for i, t in data:
        gone = bytearray(len(t))
        for p in range(len(t) - span + 1) if i is not None else ():
            if first[t[p : p + span]] < i:
                gone[p : p + span] = b"\1" * span
        kept = bytes(c for c, g in zip(t, gone) if not g)
        out.append((i, len(t), sum(gone), (b"\0" + bytes(gone)).count(b"\0\1"), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def result(docs, **options):
    return sorted((tuple(r) for r in S.dedup_digests(docs, **options).collect()), key=repr)


def frame(spark, rows, parts=5):
    return spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], "doc_id long, text string, spans string, k1 int").repartition(parts)


def prose(rng, n, words):
    return " ".join(rng.choice(words) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    words = [f"{a}{b}" for a in ("ma", "ti", "ro", "élu", "s") for b in ("n", "ka", "rest", "o", "日本")]
    passage = prose(rng, 30, words)
    out = [(i, prose(rng, rng.randint(0, 200), words)) for i in range(60)]
    for i in range(60, 110):  # a passage, whole or cut, in different surroundings
        lo, hi = sorted(rng.sample(range(len(passage)), 2))
        out.append((i, prose(rng, 10, words) + passage[lo:hi] + prose(rng, 10, words) + (passage if i % 3 == 0 else "")))
    near = out[5][1]
    for i in range(110, 130):  # near copies
        at = rng.randrange(len(near) + 1)
        out.append((i, near[:at] + rng.choice("xyz ") + near[at:]))
    out += [(130, out[3][1]), (131, out[3][1]), (2, out[3][1] + "!"), (None, out[7][1]), (None, None), (132, None), (133, "")]
    out += [(134, "ab" * 400), (135, "ab" * 300 + "c"), (136, "a" * 3000), (137, "a" * 49), (138, "a" * 50), (139, passage[:50]), (139, passage[:50])]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("options", [{}, {"busy": 3}, {"shard": 500}, {"sample": 12}])
def test_against_every_window(spark, rows, options, monkeypatch):
    monkeypatch.setattr(S, "BATCH", 3000)
    monkeypatch.setattr(S, "BUCKET", 2000)
    assert result(frame(spark, rows), **options) == brute(rows)


def test_a_full_filter_only_lets_more_through(spark, rows, monkeypatch):
    monkeypatch.setattr(S, "FILTER_MOST", 64)
    assert result(frame(spark, rows)) == brute(rows)


def test_awkward(spark, awkward, empty):
    assert result(awkward) == brute([(r.doc_id, r.text) for r in awkward.collect()])
    assert result(empty) == []
    assert result(awkward.limit(0)) == []
    assert result(frame(spark, [(1, "short"), (None, None)])) == brute([(1, "short"), (None, None)])


def test_texts(spark, rows):
    kept = {(r.doc_id, hashlib.sha256(r.kept).hexdigest()) for r in S.dedup_texts(frame(spark, rows)).collect()}
    assert kept == {(r[0], r[4]) for r in brute(rows)}


@pytest.mark.parametrize("symbols", [1, 2, 4, 200, 3000])
@pytest.mark.parametrize("longest", [0, 100])
def test_suffix_array(symbols, longest, monkeypatch):
    monkeypatch.setattr(I, "LONGEST", longest)
    rng = random.Random(symbols)
    for n in (0, 1, 2, 3, 10, 50, 2500):
        s = np.array([rng.randrange(symbols) for _ in range(n)], "i8")
        if symbols == 1 and n > 100:
            n, s = 1200, s[:1200]
        text = s.tolist()
        want = sorted(range(n), key=lambda i: text[i : i + 1300])
        assert I.suffix_array(s).tolist() == want
        if symbols <= 200:
            shared = I.common_prefixes(s, np.array(want, "i4"), 50)
            for a, b in zip(want, want[1:]):
                m = 0
                while m < 50 and max(a, b) + m < n and text[a + m] == text[b + m]:
                    m += 1
                assert shared[b] == m
