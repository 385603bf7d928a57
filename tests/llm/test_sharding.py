import zlib
from collections import Counter, defaultdict

from emberledger.llm import sharding as S


def check(df, shards=16):
    got = S.shard_rows(df, shards).collect()
    want = Counter((str(r.doc_id), len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in df.collect())
    assert want == Counter((str(r.doc_id), r.size, r.text_crc32) for r in got)
    slots, size = defaultdict(list), Counter()
    for r in got:
        assert 0 <= r.shard < shards
        slots[r.shard].append(r.slot)
        size[r.shard] += r.size
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    even, largest = sum(size.values()) / shards, max((r.size for r in got), default=0)
    assert all(abs(size[s] - even) <= largest + 2 * S.TOLERANCE * even + 1 for s in range(shards))
    return got


def test_awkward_documents(spark, awkward, empty):
    check(awkward)
    check(awkward, 3)
    assert S.shard_rows(empty).count() == 0


def test_a_hot_text_is_split_and_small_groups_are_not(spark):
    rows = [(i, "the same text for a third of all rows") for i in range(700)]
    rows += [(1000 + i, f"text {i // 2} " * 6) for i in range(1400)]
    got = check(spark.createDataFrame(rows, "doc_id long, text string"))
    where = defaultdict(set)
    for r in got:
        where[r.text_crc32].add(r.shard)
    hot = max(where.values(), key=len)
    assert len(hot) > 3
    assert sum(len(s) > 1 for s in where.values()) <= 16


def test_one_row_and_equal_rows(spark):
    check(spark.createDataFrame([(1, "x")], "doc_id long, text string"))
    # rows that agree in id and text are one key: they stay together
    got = S.shard_rows(spark.createDataFrame([(1, "x")] * 50, "doc_id long, text string")).collect()
    assert len({r.shard for r in got}) == 1 and sorted(r.slot for r in got) == list(range(50))
