"""Cross-tokenizer alignment at whitespace-token anchors.

Every text is tokenised whole by two tokenizers whose tokens stand for bytes
of it. Offsets where a token of each ends cut the text into groups; the tokens
of a group are linked. Where such an offset comes before a space-marked token
of both, it is an anchor: anchors split the document into windows of token
ids, about one word each. What a window holds depends on its ids alone, so
windows are aligned once and remembered by their id tuples.

How many documents hold a linked pair of ids is counted over the corpus.
These counts come back to the documents in slices of a bounded number of
pairs, each broadcast, so no document's pairs are shuffled: a pair found in all
documents costs no more than any other.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberledger.llm.common import Scope, lookup, pack, per_process, unpack
from emberledger.llm.packing import byte_letters

#: Documents, and characters, that are aligned together.
DOCS, CHARS = 256, 1 << 21
#: Windows, and their tokens, that a process remembers.
WINDOWS, TOKENS = 400_000, 8_000_000
#: Links of a group from which on its pairs are counted by ids.
LARGE = 4096
#: Pairs of a task that are counted before they are sent on.
HELD = 2_000_000
#: Pairs that are broadcast at a time (25 bytes each).
SLICE = 4_000_000
SPACE_MARK = "▁"


class ByteLevel:
    """A byte-level BPE given by its JSON file, without special tokens."""

    #: Fixed value: how this kind of tokenizer splits a text before merging.
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            given = json.load(f)
        special = {t["content"] for t in given.get("added_tokens", [])}
        moved = byte_letters()
        letters = {chr(moved.get(b, b)): b for b in range(256)}
        ranks = {bytes(letters[c] for c in t): i for t, i in given["model"]["vocab"].items() if t not in special}
        # entries are numbered as merged, so ids are ranks
        self.encode = tiktoken.Encoding("bytes", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.bytes = [b""] * (1 + max(ranks.values()))
        for b, i in ranks.items():
            self.bytes[i] = b
        self.marked = [b[:1] == b" " for b in self.bytes]

    def __call__(self, texts: list[str]) -> list[list[int]]:
        return [self.encode(" " + t) for t in texts]


class Pieces:
    """A sentence-piece model with byte fallback; it adds the first space itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(n)]
        self.bytes = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(SPACE_MARK, " ").encode() for i, p in enumerate(pieces)
        ]
        self.marked = [p[:1] == SPACE_MARK for p in pieces]

    def __call__(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


class _Codes(dict):
    def __missing__(self, key):
        self[key] = code = len(self)
        return code


class _Grown:
    """Integers that are appended to, in an array with room to spare."""

    def __init__(self):
        self.room, self.n = np.zeros(1 << 10, "i8"), 0

    def append(self, new: np.ndarray) -> None:
        need = self.n + len(new)
        if need > len(self.room):
            self.room = np.concatenate([self.room[: self.n], np.zeros(2 * need - self.n, "i8")])
        self.room[self.n : need] = new
        self.n = need

    def __getitem__(self, at):
        return self.room[: self.n][at]


def _summed(where: np.ndarray, pair: np.ndarray, times: np.ndarray, total: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different pairs of each place, rising, with the sum of ``times``."""
    key = where * total + pair
    order = np.argsort(key, kind="stable")
    key = key[order]
    heads = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, "i8")
    key = key[heads]
    return key % total, np.add.reduceat(times[order], heads) if len(heads) else times, key // total


class Aligner:
    """Aligns texts of two tokenizers, remembering windows by their ids."""

    def __init__(self, first, second):
        self.first, self.second = first, second
        self.size_a, self.size_b = [len(x) for x in first.bytes], [len(x) for x in second.bytes]
        self.sizes = np.array(self.size_a, "i8"), np.array(self.size_b, "i8")
        self.marked = np.array(first.marked), np.array(second.marked)
        self.width = len(self.size_b)
        # ids as they are written: inside a group, at the end of its first half, of its second, of a window
        self.words = [f"{i}{c}" for n, ends in ((len(self.size_a), ",|"), (self.width, ",;\n")) for c in ends for i in range(n)]
        self._forget()

    def _forget(self) -> None:
        self.codes, self.texts, self.tokens = _Codes(), [], 0
        self.groups, self.links, self.counts, self.starts, self.pairs, self.times = (_Grown() for _ in range(6))

    def _learn(self, keys: list[bytes]) -> None:
        """Align new windows, all at once: their bytes are laid end to end."""
        flat, n = np.frombuffer(b"".join(keys), "<i4"), len(keys)
        window = np.repeat(np.arange(n), np.fromiter(map(len, keys), "i8", n) // 4)
        parted = np.cumsum(flat == -1)
        in_a, in_b = parted == window, (parted > window) & (flat >= 0)
        a, b, window_a, window_b = flat[in_a].astype("i8"), flat[in_b].astype("i8"), window[in_a], window[in_b]
        ends_a, ends_b = np.cumsum(self.sizes[0][a]), np.cumsum(self.sizes[1][b])
        at = np.searchsorted(ends_b, ends_a)
        cut_a = ends_b[at] == ends_a  # a group ends here
        cut_b = np.zeros(len(b), bool)
        cut_b[at[cut_a]] = True
        group_a, group_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
        n_a, n_b = np.bincount(group_a), np.bincount(group_b)
        of = window_a[cut_a]
        links = np.zeros(n, "i8")
        np.add.at(links, of, n_a * n_b)
        self.groups.append(np.bincount(of, minlength=n))
        self.links.append(links)
        # pairs: all of a group, but large groups by how often an id is in them
        large = n_a * n_b > LARGE
        some = ~large[group_a]
        many = n_b[group_a[some]]
        first_b = np.cumsum(n_b) - n_b
        other = np.arange(many.sum()) + np.repeat(first_b[group_a[some]] - (np.cumsum(many) - many), many)
        pair, where = np.repeat(a[some], many) * self.width + b[other], np.repeat(window_a[some], many)
        times = np.ones(len(pair), "i8")
        first_a = np.cumsum(n_a) - n_a
        for g in np.flatnonzero(large).tolist():
            x, nx = np.unique(a[first_a[g] : first_a[g] + n_a[g]], return_counts=True)
            y, ny = np.unique(b[first_b[g] : first_b[g] + n_b[g]], return_counts=True)
            pair = np.append(pair, (x[:, None] * self.width + y).ravel())
            times = np.append(times, np.outer(nx, ny).ravel())
            where = np.append(where, np.full(len(x) * len(y), of[g]))
        pair, times, where = _summed(where, pair, times, len(self.size_a) * self.width)
        counts = np.bincount(where, minlength=n)
        self.starts.append(self.pairs.n + np.cumsum(counts) - counts)
        self.counts.append(counts)
        self.pairs.append(pair)
        self.times.append(times)
        self.tokens += len(flat) + len(pair)
        # texts: every id with what follows it
        first, second = len(self.size_a), self.width
        last_b = np.append(window_b[1:] != window_b[:-1], True)
        said = np.empty(len(a) + len(b), "i8")
        said[np.arange(len(a)) + first_b[group_a]] = a + first * cut_a
        said[np.arange(len(b)) + (first_a + n_a)[group_b]] = 2 * first + b + second * cut_b + second * last_b
        self.texts += "".join(map(self.words.__getitem__, said.tolist())).split("\n")[:-1]

    def tokens_of(self, texts: list[str]) -> tuple[list, list]:
        """Token ids of both, empty where the bytes of either are not those
        of the text after a space."""
        some = [k for k, t in enumerate(texts) if t]
        a, b = [[] for _ in texts], [[] for _ in texts]
        x, y = self.first.bytes, self.second.bytes
        given = [texts[k] for k in some]
        for k, i, j in zip(some, self.first(given), self.second(given)):
            want = b" " + texts[k].encode()
            if b"".join(map(x.__getitem__, i)) == want and b"".join(map(y.__getitem__, j)) == want:
                a[k], b[k] = i, j
        return a, b

    def align(self, texts: list[str]) -> tuple[list[tuple], np.ndarray, np.ndarray, np.ndarray]:
        """Per text (tokens of each, groups, links, digest of the groups);
        and of all texts, in order, how many different pairs each has, the
        pairs (rising per text) and how often each is linked."""
        a, b = self.tokens_of(texts)
        n_a, n_b = (np.fromiter(map(len, x), "i8", len(x)) for x in (a, b))
        ids_a, ids_b = (np.fromiter(chain.from_iterable(y), "i4", int(n.sum())) for y, n in ((a, n_a), (b, n_b)))
        # offsets run on over all texts: their bytes are the same in both
        ends_a, ends_b = np.cumsum(self.sizes[0][ids_a]), np.cumsum(self.sizes[1][ids_b])
        starts_a, starts_b = ends_a - self.sizes[0][ids_a], ends_b - self.sizes[1][ids_b]
        first_a = np.zeros(len(ids_a), bool)
        first_a[(np.cumsum(n_a) - n_a)[n_a > 0]] = True
        first_b = np.zeros(len(ids_b), bool)
        first_b[(np.cumsum(n_b) - n_b)[n_b > 0]] = True
        can_a = np.flatnonzero(first_a | self.marked[0][ids_a])
        can_b = np.flatnonzero(first_b | self.marked[1][ids_b])
        at = np.searchsorted(starts_b[can_b], starts_a[can_a])
        # an anchor is an end of both, with a marked token of both after it
        anchor = np.append(starts_b[can_b], -1)[at] == starts_a[can_a]
        lo_a, lo_b = can_a[anchor], can_b[at[anchor]]
        n = len(lo_a)
        hi_a, hi_b = np.append(lo_a[1:], len(ids_a))[:n], np.append(lo_b[1:], len(ids_b))[:n]
        # windows as id tuples: ids of the first, -1, ids of the second
        joined, place = np.full(len(ids_a) + len(ids_b) + n, -1, "<i4"), np.arange(n)
        joined[np.arange(len(ids_a)) + np.repeat(lo_b + place, hi_a - lo_a)] = ids_a
        joined[np.arange(len(ids_b)) + np.repeat(hi_a + place + 1, hi_b - lo_b)] = ids_b
        cuts = (4 * np.append(lo_a + lo_b + place, len(joined))).tolist()
        flat, kept = joined.tobytes(), len(self.codes)
        keys = [flat[s:e] for s, e in zip(cuts, cuts[1:])]
        code = np.fromiter(map(self.codes.__getitem__, keys), "i8", n)
        if len(self.codes) > kept:
            new = np.unique(code[code >= kept], return_index=True)[1]
            known = np.flatnonzero(code >= kept)[new]
            self._learn([keys[k] for k in known.tolist()])
        # windows of each text
        per_text = np.add.reduceat(np.append(first_a[lo_a], True), [0]) if not n else np.diff(np.append(np.flatnonzero(first_a[lo_a]), n))
        of = np.repeat(np.flatnonzero(n_a > 0), per_text) if n else np.zeros(0, "i8")
        groups, links = (np.bincount(of, weights=x[code], minlength=len(texts)).astype("i8") for x in (self.groups, self.links))
        rows, codes, lo = [], code.tolist(), 0
        windows = np.bincount(of, minlength=len(texts)).tolist()
        for k, m in enumerate(windows):
            text = ";".join(map(self.texts.__getitem__, codes[lo : lo + m]))
            lo += m
            digest = hashlib.sha256(text.encode()).hexdigest() if m else ""
            rows.append((int(n_a[k]), int(n_b[k]), int(groups[k]), int(links[k]), digest))
        # different pairs of each text
        many = self.counts[code]
        take = np.arange(many.sum()) + np.repeat(self.starts[code] - (np.cumsum(many) - many), many)
        pair, times, text = _summed(np.repeat(of, many), self.pairs[take], self.times[take], len(self.size_a) * self.width)
        if len(self.codes) > WINDOWS or self.tokens > TOKENS:
            self._forget()
        return rows, np.bincount(text, minlength=len(texts)), pair, times


def _pack_pairs(sizes: np.ndarray, pairs: np.ndarray, times: np.ndarray) -> bytes:
    steps = np.diff(pairs, prepend=0)
    heads = (np.cumsum(sizes) - sizes)[sizes > 0]
    steps[heads] = pairs[heads]
    return pack(sizes.astype("<i4"), *(x.astype("<i8").view("u1").reshape(-1, 8).T for x in (steps, times)))


def _unpack_pairs(body: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes, steps, times = unpack(body, "<i4", "u1", "u1")
    steps, times = (np.ascontiguousarray(x.reshape(8, -1).T).view("<i8").ravel() for x in (steps, times))
    total = np.cumsum(steps)
    heads = np.cumsum(sizes) - sizes
    return sizes, total - np.repeat(np.append(0, total)[heads], sizes), times


FIELDS = ("n_a", "n_b", "n_groups", "n_links", "groups_sha256")


def aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Documents aligned, some hundred to a row: lists of ``doc_id`` and
    ``FIELDS``, and ``body``, the packed linked pairs of each."""
    kind = docs.select("doc_id").schema[0].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = per_process(("aligner", path_a, path_b), lambda: Aligner(ByteLevel(path_a), Pieces(path_b)))
        for batch in batches:
            texts = batch.column(1).fill_null("").to_pylist()
            lo = 0
            while lo < len(texts):
                hi, size = lo, 0
                while hi < len(texts) and hi - lo < DOCS and (hi == lo or size + len(texts[hi]) <= CHARS):
                    size += len(texts[hi])
                    hi += 1
                rows, *pairs = aligner.align(texts[lo:hi])
                cols = list(zip(*rows))
                lists = [pa.array(c, t) for c, t in zip(cols, (*[pa.int64()] * 4, pa.string()))]
                edges = pa.array([0, hi - lo], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(edges, c) for c in (batch.column(0).slice(lo, hi - lo), *lists)] + [pa.array([_pack_pairs(*pairs)], pa.binary())],
                    names=["doc_id", *FIELDS, "body"],
                )
                lo = hi

    fields = ", ".join(f"{f} array<{'string' if f == FIELDS[-1] else 'long'}>" for f in FIELDS)
    texts = docs.select("doc_id", F.col("text").cast("string"))
    return texts.mapInArrow(run, f"doc_id array<{kind.simpleString()}>, {fields}, body binary")


def pair_counts(rows: DataFrame) -> DataFrame:
    """``pair``, ``n``: how many documents hold it. Counted in the tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, counts, waiting, size = np.zeros(0, "i8"), np.zeros(0, "i8"), [], 0

        def merge():
            pairs, n = np.concatenate([held, *waiting]), np.concatenate([counts, np.ones(sum(map(len, waiting)), "i8")])
            order = np.argsort(pairs, kind="stable")
            pairs = pairs[order]
            heads = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1])) if len(pairs) else np.zeros(0, "i8")
            return pairs[heads], np.add.reduceat(n[order], heads) if len(heads) else n

        def told():
            for lo in range(0, len(held), 1 << 17):
                yield pa.RecordBatch.from_arrays([pa.array(held[lo : lo + (1 << 17)]), pa.array(counts[lo : lo + (1 << 17)])], names=["pair", "n"])

        for batch in batches:
            for body in batch.column(0).to_pylist():
                waiting.append(_unpack_pairs(body)[1])
                size += len(waiting[-1])
                if size > HELD:
                    held, counts = merge()
                    waiting, size = [], 0
                    if len(held) > HELD:
                        yield from told()
                        held, counts = held[:0], counts[:0]
        held, counts = merge()
        yield from told()

    return rows.select("body").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def align(docs: DataFrame, path_a: str, path_b: str, slice_rows: int = SLICE) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``): ``doc_id``, ``n_a``,
    ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``,
    ``groups_sha256``.

    A null or empty text has no tokens, nor has one that a tokenizer does not
    give back byte for byte after a space: zeros and an empty digest. Every row
    is a document of its own, also where ids or texts repeat or the id is null.
    Texts of any length are taken whole; other columns are left out; no
    documents, no rows.
    """
    scope = Scope(docs.sparkSession)
    rows = scope.cut(aligned(docs, path_a, path_b))
    width = _width(path_b)
    counted = scope.cut(pair_counts(rows).withColumn("a", F.expr(f"pair div {width}")))
    top = scope.cut(counted.groupBy("a").agg(F.max("n").alias("top")))  # a row per id of the first tokenizer
    told = scope.cut(lookup(counted, top, "a").select("pair", "a", "n", (F.col("n") == F.col("top")).alias("best")))
    slices = max(1, -(-told.count() // slice_rows))
    zeros = [F.transform("n_a", lambda _: F.lit(0).cast("long")).alias(c) for c in ("n_best", "count_sum")]
    rows = rows.select("*", *zeros)
    names = ["doc_id", *FIELDS, "n_best", "count_sum"]
    for k in range(slices):
        part = told.filter(F.pmod("a", F.lit(slices)) == k).orderBy("pair") if slices > 1 else told.orderBy("pair")
        got = part.select("pair", "n", "best").toArrow()  # about slice_rows rows
        sent = docs.sparkSession.sparkContext.broadcast(tuple(c.to_numpy() for c in got.columns))
        rows = _add_counts(rows, names, sent, last=k == slices - 1)
        if k < slices - 1:
            rows = scope.cut(rows)
    return rows.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def _width(path: str) -> int:
    return len(Pieces(path).bytes)


def _add_counts(rows: DataFrame, names: list[str], sent, last: bool) -> DataFrame:
    """Add to ``n_best`` and ``count_sum`` what a slice of the pairs tells.
    The last slice gives a row per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, n, best = sent.value
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                columns = {c: row.column(row.schema.get_field_index(c)).flatten() for c in names}
                sizes, mine, times = _unpack_pairs(row.column(row.schema.get_field_index("body"))[0].as_py())
                at = np.searchsorted(pairs, mine)
                known = np.append(pairs, -1)[at] == mine
                of, at, times = np.repeat(np.arange(len(sizes)), sizes)[known], at[known], times[known]
                for c, weight in (("n_best", times * best[at]), ("count_sum", times * n[at])):
                    total = np.zeros(len(sizes), "i8")
                    np.add.at(total, of, weight)
                    columns[c] = pa.array(columns[c].to_numpy() + total)
                if last:
                    yield pa.RecordBatch.from_arrays([columns[c] for c in names], names=names)
                else:
                    edges = pa.array([0, len(sizes)], pa.int32())
                    lists = [pa.ListArray.from_arrays(edges, columns[c]) for c in names]
                    yield pa.RecordBatch.from_arrays([*lists, row.column(row.schema.get_field_index("body"))], names=[*names, "body"])

    if last:
        schema = ", ".join(f"{f.name} {f.dataType.elementType.simpleString()}" for f in rows.select(names).schema)
        return rows.select(*names, "body").mapInArrow(run, schema)
    return rows.select(*names, "body").mapInArrow(run, rows.select(*names, "body").schema)
