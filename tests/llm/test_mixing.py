import re
import struct
from collections import Counter, defaultdict

import pytest
import xxhash

from emberledger.llm import mixing as M

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes):
    """Shares by weight, capped at twice the size, the excess reshared again and again."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, out, open_ = 1.5 * sum(sizes.values()), {}, set(order)
    while open_:
        left = total - sum(out.values())
        w = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / w > 2 * sizes[s] + 1e-9}
        if not over:
            return out | {s: left * weight[s] / w for s in open_}
        for s in over:
            out[s] = 2.0 * sizes[s]
        open_ -= over
    return out


def check(docs, **options):
    got = M.mix_taken(docs, **options).collect()
    size = Counter()
    for r in docs.collect():
        size[r.source] += len(WORD.findall(r.text or ""))
    want = targets(dict(size))
    source = defaultdict(list)
    for r in docs.collect():
        source[(r.doc_id, len(WORD.findall(r.text or "")))].append(r.source)
    taken, seen = Counter(), Counter()
    for r in got:
        assert r.taken <= 2 * r.size
        s = source[(r.doc_id, r.size)].pop()
        taken[s] += r.taken
        assert r.source_size == size[s] and r.target == pytest.approx(want[s])
        seen[s] += 1
    for s in want:
        assert abs(taken[s] - want[s]) <= 1, s
    return sorted((str(r.doc_id), r.size, r.taken) for r in got)


def test_awkward_documents(spark, awkward, empty):
    a = check(awkward, block_words=16)
    assert a == check(awkward.repartition(5), block_words=16)  # reruns and other partitionings agree
    check(awkward)
    assert M.mix_taken(empty).count() == 0
    assert M.mix_taken(awkward.filter("text is null or text = ''")).count() == 2


def test_permutation_is_one(spark):
    from pyspark.sql import functions as F

    for n in (1, 2, 7, 100):
        df = spark.range(n).select(M.permuted(F.col("id"), F.lit(n).cast("long"), F.lit("s"), 5).alias("p"))
        assert sorted(r.p for r in df.collect()) == list(range(n))


def test_counts_of_a_source_spread_over_shards(spark, awkward):
    _, slots = M.mix_plan(awkward.select("doc_id", "text", "source"), block_words=8, shard_blocks=200)
    rows = M.shard_counts(slots).collect()
    assert sum(r.blocks for r in rows) == slots.count()
    assert len({r.shard for r in rows if r._g == "0b"}) > 10


def test_mix_as_documents(spark, awkward):
    docs = awkward.filter("doc_id is not null")
    mixed = M.mix_documents(docs, block_words=16)
    assert mixed.columns == docs.columns
    words, originals = Counter(), Counter()
    for r in mixed.collect():
        words[r.doc_id] += len(WORD.findall(r.text))
        assert r.n_chars == len(r.text)
    for r in M.mix_taken(docs, block_words=16).collect():
        originals[r.doc_id] += r.taken
    assert {k: v for k, v in originals.items() if v} == dict(words)
    assert M.mix_documents(docs.limit(0)).count() == 0


def test_the_short_last_block_is_drawn_like_any_other(spark):
    """1.5 passes over 44 words in blocks of 8: the block of the last 4 words is in about half of the partial passes."""
    docs = spark.createDataFrame([(i, "w " * 11, "s") for i in range(4)], "doc_id long, text string, source string")
    drawn = []
    for seed in range(8):
        rows = M.mix_plan(docs, block_words=8, seed=seed)[1].collect()
        assert sorted(r._block for r in rows if r._epoch == 0) == list(range(6))
        assert sum(r._words for r in rows) == 66 and min(r._words for r in rows) > 0
        assert all(r._words <= (4 if r._block == 5 else 8) for r in rows)
        second = [r._block for r in rows if r._epoch == 1]
        assert len(set(second)) == len(second)
        drawn.append(5 in second)
    assert True in drawn and False in drawn


def hashed(*parts):
    """The engine's 64-bit hash of several values, as a signed number."""
    h = 42
    for form, x in parts:
        h = xxhash.xxh64_intdigest(x.encode() if form == "s" else struct.pack(form, x), seed=h)
    return h - (1 << 64) if h >> 63 else h


def place(index, n, key, seed):
    for r in range(1, M.ROUNDS + 1):
        other = (hashed(("<i", seed), ("s", key), ("<i", r)) % n - index) % n
        if hashed(("<i", seed + 1), ("s", key), ("<i", r), ("<q", max(index, other))) % 2:
            index = other
    return index


def test_taken_words_and_shards_against_brute_force(spark, awkward):
    """Every word of every slot, one by one, through a permutation and a shard draw in plain Python."""
    b, seed, per_shard = 16, 20, 30
    docs = awkward.select("doc_id", "text", "source")
    placed = M.mix_plan(docs, block_words=b, shard_blocks=per_shard, seed=seed)[0].collect()
    sources = defaultdict(list)
    for r in placed:
        sources[r._g].append(r)
    slots = {}
    for g, rows in sources.items():
        words = [None] * rows[0].source_size
        for r in rows:
            for i in range(r._start, r._start + r._size):
                assert words[i] is None
                words[i] = (g, r._bucket, r._row)
        assert None not in words
        left, epoch, n = min(round(rows[0].target), 2 * len(words)), 0, -(-len(words) // b)
        slots[g] = drawn = []
        while left > 0:
            for k in range(n):
                block = place(k, n, f"{g}/{epoch}", seed)
                own = words[block * b : (block + 1) * b][:left]
                left -= len(own)
                if own:
                    drawn.append(own)
            epoch += 1
    shards = -(-sum(map(len, slots.values())) // per_shard)
    want = defaultdict(Counter)
    for g, drawn in slots.items():
        for i, own in enumerate(drawn):
            for word in own:
                want[word][hashed(("<i", seed + 2), ("s", g), ("<q", i)) % shards] += 1
    expect = sorted((str(r.doc_id), r._size, sorted(want[(r._g, r._bucket, r._row)].items())) for r in placed)
    got = M.mix_taken(docs, block_words=b, shard_blocks=per_shard, seed=seed).collect()
    assert shards > 5
    assert sorted((str(r.doc_id), r.size, [(s.shard, s.words) for s in r.shards]) for r in got) == expect
    assert all(r.taken == sum(s.words for s in r.shards) for r in got)


def test_mix_by_shard(spark, awkward):
    """One row for each document, epoch and shard; the words of a shard are those that it drew."""
    docs = awkward.filter("doc_id is not null")
    options = {"block_words": 16, "shard_blocks": 30}
    mixed = M.mix_documents(docs, shard="part", **options)
    assert mixed.columns == [*docs.columns, "part"]
    got, want = Counter(), Counter()
    for r in mixed.collect():
        got[r.doc_id, r.part] += len(WORD.findall(r.text))
    for r in M.mix_taken(docs, **options).collect():
        for s in r.shards:
            want[r.doc_id, s.shard] += s.words
    assert got == want and len({part for _, part in got}) > 5
    assert M.mix_documents(docs.limit(0), shard="part").count() == 0
