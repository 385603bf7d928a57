import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from emberledger.llm import packing as P
from emberledger.llm.common import let_go, per_process
from emberledger.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def test_encoder_equals_whole_text(tokenizer):
    e = P.Encoder(tokenizer_path(), cache=50)
    rng = random.Random(1)
    bits = ["a", "bc", "d.", "e,", "f!", " ", "  ", "\n", "\n\n", "\t", "it's", "I'll", "12", "3rd", "é", "日本", "<|endoftext|>", "\u00a0", "%%%", "ﬁ", "a\u0301"]
    texts = ["".join(rng.choice(bits) + rng.choice(["", " ", " "]) for _ in range(rng.randint(0, 40))) for _ in range(600)]
    for at in range(0, len(texts), 100):
        part = texts[at : at + 100]
        for t, got in zip(part, e.encode(part)):
            assert got.tolist() == tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


def test_nnls_meets_the_conditions_of_a_minimum():
    rng = np.random.default_rng(3)
    for _ in range(20):
        a, b = rng.random((12, 30)), rng.random(12) * 10
        x = P.nnls(a, b)
        grad = a.T @ (a @ x - b)
        assert (x >= 0).all() and (grad > -1e-5).all() and (abs(grad[x > 1e-9]) < 1e-5).all()


def test_repeats_use_every_piece_and_fill_windows():
    rng = random.Random(2)
    for units in (8, 32):
        h = np.array([0] + [rng.choice([0, 1, 5, 300]) for _ in range(units)])
        plan = P.repeats(h)
        used = Counter()
        for combo, times in plan:
            assert sum(combo) <= units and times > 0
            for c in combo:
                used[c] += times
        assert [used[c] for c in range(1, units + 1)] == h[1:].tolist()
    assert P.repeats(np.zeros(9, int)) == []
    # halves fill windows in pairs
    assert P.repeats(np.array([0, 0, 0, 0, 10, 0, 0, 0, 0])) == [((4, 4), 5)]


def check(rows, texts, tokenizer, window):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for doc, group in texts.items():
        want = []
        for t in group:
            ids = np.array(ids_of(tokenizer, t), "<u4")
            for s in range(0, len(ids), window):
                part = ids[s : s + window]
                want.append((s, len(part), zlib.crc32(part.tobytes()), len(ids)))
        assert sorted(want) == sorted((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in pieces[doc])
    assert set(pieces) == set(texts)
    for part in sequences.values():
        part.sort(key=lambda r: r.offset)
        at = 0
        for r in part:
            assert r.offset == at
            at += r.length
        assert at <= window
    return sum(r.length for r in rows) / (window * len(sequences))


def test_awkward_documents(spark, awkward, empty, tokenizer):
    texts = defaultdict(list)
    for r in awkward.collect():
        texts[r.doc_id].append(r.text)
    for window in (64, 2048):
        rows = P.pack(P.token_pieces(awkward, tokenizer_path(), window=window), window).collect()
        full = check(rows, texts, tokenizer, window)
    assert full > 0.8
    assert P.pack_documents(empty, tokenizer_path()).count() == 0


def test_little_padding(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = P.pack_documents(docs, tokenizer_path()).groupBy("sequence_id").sum("length").collect()
    assert sum(r[1] for r in rows) / (2048 * len(rows)) > 0.97


def test_texts_that_are_not_cut_have_the_tokenizer_s_ids():
    import pyarrow as pa
    import public_tokenizers

    texts = [
        "", None, "  ", "a\n", "\na", "a  b", "a\n\nb", "a \nb", "x\0y", "x \0 y", "a\tb", "a b", "a\u0085b", "a b", "w\x1cq", " lead",
        "trail ", "one two\nthree", "été à\nla", "日本 語", "don't I'll 123 45.6, x.,", "a \n b",
    ]
    encoder = P.Encoder(public_tokenizers.path("byte_bpe_50k.json"), cache=8)
    want = [encoder.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    for _ in range(3):  # the cache is full after the first
        assert [x.tolist() for x in encoder.encode(pa.array(texts))] == want
    assert encoder.encode([]) == [] and encoder.encode([t or "" for t in texts])[7].tolist() == want[7]


def test_marked_words_known_new_and_alone():
    encoder = P.Encoder(tokenizer_path())
    for texts in (["alpha betaq"], ["alpha, betaq. gammaz, gammaz deltaw, deltaw. . , x. été,"], ["deltaw gammaz. deltaw, 7. a.,"]):
        for got, text in zip(encoder.encode(texts), texts):
            assert got.tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_kept_encoders_are_let_go():
    made = []
    make = lambda: made.append(1) or object()
    first = per_process("test", make)
    assert per_process("test", make) is first
    let_go()
    assert per_process("test", make) is not first and len(made) == 2
    let_go()


def test_batches_are_small_while_pieces_are_made(spark, monkeypatch):
    """Texts reach the workers ``BATCH_ROWS`` at a time; the session's own setting is back afterwards."""
    key, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    usual = spark.conf.get(key)
    cut = P.cut
    monkeypatch.setattr(P, "cut", lambda df: seen.append(spark.conf.get(key)) or cut(df))
    docs = spark.createDataFrame([(i, f"some words {i}") for i in range(20)], "doc_id long, text string")
    assert P.pack_documents(docs, tokenizer_path()).count() == 20
    assert seen and set(seen) == {str(P.BATCH_ROWS)} and spark.conf.get(key) == usual
