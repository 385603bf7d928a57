import hashlib
import random
from bisect import bisect
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from emberledger.llm import alignment as A

JSON, MODEL = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def both():
    t = Tokenizer.from_file(JSON)
    t.encode_special_tokens = True
    letters = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in letters}
    byte.update({chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in letters)})
    back = {i: bytes(byte[c] for c in w) for w, i in t.get_vocab().items() if i != 50256}
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)

    def piece(i):
        p = sp.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode()

    def encode(text):
        a = t.encode(" " + text, add_special_tokens=False).ids
        b = sp.encode(text)
        return [(i, back[i]) for i in a], [(i, piece(i)) for i in b]

    return encode


def brute(rows, encode):
    aligned = []
    for i, text in rows:
        groups = []
        if text:
            a, b = encode(text)
            want = b" " + text.encode()
            if b"".join(x for _, x in a) == want == b"".join(x for _, x in b):
                def ends(tokens):
                    out, at = [], 0
                    for j, x in tokens:
                        at += len(x)
                        out.append((at, j))
                    return out

                ea, eb = ends(a), ends(b)
                cuts = sorted({p for p, _ in ea} & {p for p, _ in eb})
                for lo, hi in zip([0, *cuts], cuts):
                    groups.append(tuple([j for _, j in e[bisect(e, (lo, 1 << 60)) : bisect(e, (hi, 1 << 60))]] for e in (ea, eb)))
        aligned.append((i, groups))
    held = Counter()
    for _, groups in aligned:
        held.update({(x, y) for g, h in groups for x in g for y in h})
    best = defaultdict(int)
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    out = []
    for i, groups in aligned:
        links = [(x, y) for g, h in groups for x in g for y in h]
        text = ";".join(f"{','.join(map(str, g))}|{','.join(map(str, h))}" for g, h in groups)
        out.append((i, sum(len(g) for g, _ in groups), sum(len(h) for _, h in groups), len(groups), len(links),
                    sum(held[p] == best[p[0]] for p in links), sum(held[p] for p in links),
                    hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return sorted(out, key=repr)


def result(docs, **options):
    return sorted((tuple(r) for r in A.align(docs, JSON, MODEL, **options).collect()), key=repr)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    words = "the of naïve café token izer running 日本語 текст x1 2024 don't <|endoftext|> <s> <0x41> 😀 zß  \n\n \t .. , aaaa".split(" ")
    out = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 40)))) for i in range(80)]
    out += [(90, None), (91, ""), (92, " "), (93, "  lead and trail  "), (94, "▁"), (95, "a▁b"), (None, "no id"), (96, out[3][1]), (96, out[3][1]), (97, "tab\tnew\r\nline\x00nul")]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], "doc_id long, text string, body string, pair int").repartition(4)


@pytest.mark.parametrize("slice_rows", [A.SLICE, 40])
def test_against_all_links(spark, rows, both, slice_rows, monkeypatch):
    monkeypatch.setattr(A, "DOCS", 7)
    want = brute(rows, both)
    assert sum(r[3] > 0 for r in want) > 60  # tokens of most texts are kept
    assert result(frame(spark, rows), slice_rows=slice_rows) == want


def test_little_memory(spark, rows, both, monkeypatch):
    for name, value in (("DOCS", 5), ("WINDOWS", 3), ("HELD", 10), ("CHARS", 60), ("LARGE", 2)):
        monkeypatch.setattr(A, name, value)
    assert result(frame(spark, rows)) == brute(rows, both)


def test_awkward(spark, awkward, empty, both):
    assert result(awkward) == brute([(r.doc_id, r.text) for r in awkward.collect()], both)
    assert result(empty) == []


def test_long_runs(both):
    aligner = A.Aligner(A.ByteLevel(JSON), A.Pieces(MODEL))
    texts = ["a" * 20_000, " " * 3_000 + "x", "\n" * 3_000, "日本" * 4_000]
    rows, sizes, pairs, times = aligner.align(texts)
    for text, row in zip(texts, rows):
        a, b = both(text)
        whole = b" " + text.encode()
        kept = b"".join(x for _, x in a) == whole == b"".join(x for _, x in b)
        assert row[:2] == ((len(a), len(b)) if kept else (0, 0))
    assert sum(r[3] for r in rows) == times.sum() and len(pairs) == sizes.sum()


def test_ids_are_the_tokenizers_own(both):
    rng = random.Random(5)
    first = A.ByteLevel(JSON)
    pool = [chr(c) for c in range(32, 127)] + list(" \n\t\r\x0b\x1c\x85  ") * 5 + list("éüßñ日本語текст😀’ʼ٣Ⅳ²") * 2 + ["'ll", "<|endoftext|>"]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(1, 80))) for _ in range(2000)]
    assert first(texts) == [[i for i, _ in both(t)[0]] for t in texts]
