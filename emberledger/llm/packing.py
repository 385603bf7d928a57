"""Packing documents into fixed windows by non-negative least squares.

A document's tokens are cut into full windows and one remainder. Remainders
fall into length classes; the *histogram* of the classes is what is packed:
combinations of few classes that fill a window are enumerated, repeat counts
for them solved against the histogram by non-negative least squares and
rounded, and what remains is packed greedily, longest class first. The plan
is a bounded table of (class, range of numbers) -> sequence; a remainder
finds its sequence by its number in its class. Only lengths are planned, so
token ids never leave the task that made them.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emberledger.llm.common import arrow_rows, cut, give_back, per_process, ranked

WINDOW = 2048
#: Width of a length class in tokens: what a remainder can waste at most.
STEP = 8
#: Most pieces in an enumerated combination.
DEPTH = 3
#: Chunks that a worker's token cache keeps, and documents encoded at once.
CACHE, AT_ONCE = 700_000, 512
#: Texts per batch between the JVM and Python, and encodings after which a worker gives back unused memory.
BATCH_ROWS, GIVE_BACK = 1024, 4
#: Texts that are encoded whole: with other white space than blanks and newlines, with two such characters
#: in a row, with one at an end, or with a NUL.
UNCUT = (
    "[\\x{0}\\x{9}\\x{b}-\\x{d}\\x{1c}-\\x{1f}\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}"
    "\\x{205f}\\x{3000}]|[ \\n][ \\n]|\\A[ \\n]|[ \\n]\\z"
)


# -- tokens ---------------------------------------------------------------

def byte_letters() -> dict[int, int]:
    """The printable character that byte-level vocabularies use for each byte:
    printable bytes stand for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: 256 + i for i, b in enumerate(rest)}


class _Codes(dict):
    """Chunk -> number, in order of first appearance."""

    def __missing__(self, chunk: str) -> int:
        code = self[chunk] = len(self)
        return code


class Encoder:
    """Token ids of whole texts by a byte-level BPE of ``tokenizers``.

    The vocabulary splits texts before every blank that follows a word, and
    around a newline between words, and never merges across. So the ids of a
    text are those of such chunks one after the other, and chunks repeat: up to
    about ``cache`` of them are kept, those found most often. A text with any other white
    space, or with two such characters in a row, is encoded as one chunk.
    """

    def __init__(self, path: str, cache: int = CACHE):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core; each thread would hold memory of its own
        from tokenizers import Tokenizer

        self.tokenizer, self.cache = Tokenizer.from_file(path), cache
        self.model, self.letters = self.tokenizer.model, byte_letters()
        self.blank = chr(self.letters[32])
        self.marks = {m: self._ids([m])[0] for m in ".,"}
        self.codes = _Codes()
        self.flat, self.lengths, self.used = np.zeros(0, "<u4"), np.zeros(0, "i8"), np.zeros(0, "i8")

    def _ids(self, chunks: list[str]) -> list[list[int]]:
        """A word of letters, with or without a blank before it, is one piece
        for the model's merges; other chunks go through the whole tokenizer."""
        out: list = [None] * len(chunks)
        other = []
        for i, w in enumerate(chunks):
            if w.isalpha() or w[:1] == " " and w[1:].isalpha():
                if w.isascii():
                    w = self.blank + w[1:] if w[0] == " " else w
                else:
                    w = w.encode().decode("latin-1").translate(self.letters)
                out[i] = [t.id for t in self.model.tokenize(w)]
            else:
                other.append(i)
        for i, e in zip(other, self.tokenizer.encode_batch_fast([chunks[i] for i in other], add_special_tokens=False)):
            out[i] = e.ids
        return out

    def _learn(self, new: list[str], starts: np.ndarray) -> None:
        """Append the ids of new chunks, which have the numbers from
        ``len(starts)`` on. A full stop or comma after a letter is a token of
        its own, so the word before it may be known, or be new as well."""
        marks, known = self.marks, len(starts)
        marked = [i for i, w in enumerate(new) if w[-1:] in marks and w[-2:-1].isalpha()]
        words = [new[i][:-1] for i in marked]
        codes = [dict.get(self.codes, w) for w in words]
        extra = {w: i for i, w in enumerate(dict.fromkeys(w for w, c in zip(words, codes) if c is None), len(new))}
        skip = set(marked)
        ask = [i for i in range(len(new)) if i not in skip]
        ids: list = [None] * len(new) + [None] * len(extra)
        for i, found in zip([*ask, *extra.values()], self._ids([*map(new.__getitem__, ask), *extra])):
            ids[i] = found
        for i, w, code in zip(marked, words, codes):
            if code is None:
                word = ids[extra[w]]
            elif code < known:
                word = self.flat[starts[code] : starts[code] + self.lengths[code]].tolist()
            else:
                word = ids[code - known]  # a word ends with a letter, so it is not marked itself
            ids[i] = word + marks[new[i][-1]]
        del ids[len(new) :]
        sizes = np.fromiter(map(len, ids), "i8", len(ids))
        self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(ids), "<u4", int(sizes.sum()))])
        self.lengths = np.concatenate([self.lengths, sizes])
        self.used = np.concatenate([self.used, np.zeros(len(new), "i8")])

    def _forget(self, starts: np.ndarray) -> None:
        """Keep the chunks that were found most often, half the cache at most."""
        order = np.argsort(-self.used, kind="stable")[: self.cache // 2]
        keep = np.sort(order[self.used[order] > 1])
        n = self.lengths[keep]
        at = np.arange(n.sum()) + np.repeat(starts[keep] - (np.cumsum(n) - n), n)
        chunks, self.codes = list(self.codes), _Codes()  # the old table goes before the new one is made
        self.codes = _Codes((chunks[k], i) for i, k in enumerate(keep.tolist()))
        self.flat, self.lengths, self.used = self.flat[at], n, self.used[keep] // 2

    def _chunks(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of the chunks of all texts, how many each text has, and the
        order the texts are in: those cut into chunks, then the others. Only
        the different chunks of ``texts`` become Python strings."""
        texts = texts.cast(pa.large_string()).fill_null("")
        whole = pc.match_substring_regex(texts, UNCUT)
        order = np.argsort(whole.to_numpy(zero_copy_only=False), kind="stable")
        marked = pc.replace_substring(pc.replace_substring(texts.filter(pc.invert(whole)), " ", "\0 "), "\n", "\0\n\0")
        lists = pc.split_pattern(marked, "\0")
        different = pa.concat_arrays([lists.flatten().cast(pa.large_string()), texts.filter(whole)]).dictionary_encode()
        kept = len(self.codes)
        known = different.dictionary.to_pylist()
        code = np.fromiter(map(self.codes.__getitem__, known), "i8", len(known))[different.indices.to_numpy()]
        if len(self.codes) > kept:
            self._learn(list(islice(self.codes, kept, None)), np.cumsum(self.lengths) - self.lengths)
        each = np.concatenate([pc.list_value_length(lists).to_numpy().astype("i8"), np.ones(len(texts) - len(lists), "i8")])
        return code, each, order

    def encode(self, texts: pa.Array | list[str]) -> list[np.ndarray]:
        if not len(texts):
            return []
        code, each, order = self._chunks(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string()))
        starts = np.cumsum(self.lengths) - self.lengths
        n = self.lengths[code]
        ends = np.cumsum(n)
        at = np.arange(ends[-1]) + np.repeat(starts[code] - (ends - n), n)
        flat = self.flat[at]
        stops = ends[np.cumsum(each) - 1]
        out: list = [None] * len(order)
        for i, lo, hi in zip(order.tolist(), [0, *stops[:-1].tolist()], stops.tolist()):
            out[i] = flat[lo:hi]
        self.used += np.bincount(code, minlength=len(self.used))
        if len(self.codes) > self.cache:
            self._forget(starts)
        return out


def token_pieces(docs: DataFrame, path: str, end_id: int = 1, window: int = WINDOW) -> DataFrame:
    """The pieces of every document: ``doc_id``, ``start``, ``length``,
    ``ids_crc32``, ``doc_tokens``. Every ``window`` tokens are a piece, and
    so is the remainder. A null or empty text is its end id alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, encoded = per_process(("encoder", path), lambda: Encoder(path)), 0
        for batch in batches:
            for lo in range(0, batch.num_rows, AT_ONCE):
                part = batch.slice(lo, AT_ONCE)
                ids = part.column(0).to_pylist()
                out: list[tuple] = []
                for doc, tokens in zip(ids, encoder.encode(part.column(1))):
                    tokens = np.append(tokens, np.array([end_id], "<u4"))
                    data = memoryview(tokens.astype("<u4", copy=False).tobytes())
                    for s in range(0, len(tokens), window):
                        n = min(window, len(tokens) - s)
                        out.append((doc, s, n, zlib.crc32(data[4 * s : 4 * (s + n)]), len(tokens)))
                cols = list(zip(*out))
                types = (batch.schema.field(0).type, pa.int64(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, types)], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                )
                encoded += 1
                if encoded % GIVE_BACK == 0:
                    give_back()
        give_back()  # the worker is kept

    kind = docs.select("doc_id").schema[0].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long"
    )


# -- plan -----------------------------------------------------------------


def combinations(units: int, depth: int = DEPTH) -> list[tuple[int, ...]]:
    """All falling tuples of at most ``depth`` classes that sum to ``units``."""
    out: list[tuple[int, ...]] = []

    def grow(head: tuple[int, ...], left: int, most: int) -> None:
        if left == 0:
            out.append(head)
        elif len(head) < depth:
            for c in range(min(left, most), 0, -1):
                if c * (depth - len(head)) >= left:
                    grow((*head, c), left - c, c)

    grow((), units, units)
    return out


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 5000, tol: float = 1e-9) -> np.ndarray:
    """Minimise |a x - b| over x >= 0 by an active-set method: the column that
    helps most enters, the equations are solved on the entered columns, and
    columns that would turn negative leave."""
    x, used = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    scale = tol * max(1.0, float(np.abs(a.T @ b).max(initial=0)))
    for _ in range(rounds):
        gain = np.where(used, -np.inf, a.T @ (b - a @ x))
        best = int(np.argmax(gain))
        if gain[best] <= scale:
            break
        used[best] = True
        while used.any():
            on = np.flatnonzero(used)
            part = a[:, on]
            gram = part.T @ part
            gram[np.diag_indices(len(on))] += 1e-10
            z = np.linalg.solve(gram, part.T @ b)
            old = x[on]
            x[:] = 0
            if (z > 0).all():
                x[on] = z
                break
            bad = z <= 0
            step = np.min(old[bad] / np.maximum(old[bad] - z[bad], 1e-300))
            new = old + step * (z - old)
            new[bad & (new <= 1e-9 * max(1.0, float(b.max(initial=0))))] = 0
            x[on] = np.maximum(new, 0)
            used[on[new <= 0]] = False
        if not used[best]:
            break
    return x


def repeats(histogram: np.ndarray, depth: int = DEPTH) -> list[tuple[tuple[int, ...], int]]:
    """(combination of classes, how often) that use up ``histogram`` exactly.

    ``histogram[c]`` counts the pieces of class ``c`` (``c`` steps long);
    its length less one is the window in steps. Works on counts only.
    """
    units = len(histogram) - 1
    left = histogram.astype("i8").copy()
    plan: list[tuple[tuple[int, ...], int]] = []
    present = {c for c in range(1, units + 1) if left[c] > 0}
    combos = [c for c in combinations(units, depth) if set(c) <= present]
    if combos:
        a = np.zeros((units + 1, len(combos)))
        for j, combo in enumerate(combos):
            for c in combo:
                a[c, j] += 1
        # an uncovered long piece costs more than a short one
        weight = np.sqrt(np.arange(units + 1) / units)[:, None]
        x = nnls(a * weight, left * weight[:, 0])
        for j in np.argsort(-x):
            times = min(int(round(x[j])), *(int(left[c] // combos[j].count(c)) for c in combos[j]))
            if times > 0:
                plan.append((combos[j], times))
                for c in combos[j]:
                    left[c] -= times
    while left[1:].any():
        fill, space, take = [], units, left.copy()
        for c in range(units, 0, -1):
            n = min(int(take[c]), space // c)
            fill += [c] * n
            space -= n * c
        times = min(int(left[c] // fill.count(c)) for c in set(fill))
        plan.append((tuple(fill), times))
        for c in fill:
            left[c] -= times
    return plan


def slots(plan: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(class, first number, end, sequence of the first, pieces of the class
    per sequence, place in the sequence): the numbers of a class are dealt to
    the combinations in order."""
    used: dict[int, int] = {}
    out, sequence = [], 0
    for combo, times in plan:
        place = 0
        for c in sorted(set(combo), reverse=True):
            per = combo.count(c)
            first = used.get(c, 0)
            out.append((c, first, first + per * times, sequence, per, place))
            used[c] = first + per * times
            place += per
        sequence += times
    return out


def pack(pieces: DataFrame, window: int = WINDOW, step: int = STEP, depth: int = DEPTH) -> DataFrame:
    """Give every piece its ``sequence_id`` and gapless ``offset``.

    Full windows are sequences of their own; remainders follow the plan. The
    histogram (``window / step`` numbers) is all that reaches the driver. A
    class that holds a third of all pieces is numbered in hash buckets.
    """
    spark = pieces.sparkSession
    units = window // step
    pieces = cut(pieces.withColumn("class", F.ceil(F.col("length") / step).cast("int")))
    rests, full = pieces.filter(F.col("length") < window), pieces.filter(F.col("length") == window)
    histogram = np.zeros(units + 1, "i8")
    for r in rests.groupBy("class").count().collect():
        histogram[r[0]] = r[1]
    plan = repeats(histogram, depth)
    base = sum(times for _, times in plan)
    where = spark.createDataFrame(slots(plan) or [(0, 0, 0, 0, 1, 0)], "class int, lo long, hi long, seq long, per int, place int")
    order = [F.col("doc_id"), F.col("start"), F.col("length"), F.col("ids_crc32"), F.col("doc_tokens")]
    numbered = ranked(rests, ["class"], order, order[:2]).withColumnRenamed("_at", "_nth").drop("_bucket", "_row")
    # at most units * (depth + units) short rows, whatever the input
    at = (F.col("_nth") >= F.col("lo")) & (F.col("_nth") < F.col("hi"))
    placed = numbered.join(F.broadcast(where.withColumnRenamed("class", "_c")), (F.col("class") == F.col("_c")) & at)
    k = F.col("_nth") - F.col("lo")
    placed = placed.withColumn("sequence_id", F.col("seq") + F.expr("(_nth - lo) div per")).withColumn(
        "_place", F.col("place") + F.pmod(k, F.col("per"))
    )
    in_sequence = Window.partitionBy("sequence_id").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("offset", F.coalesce(F.sum("length").over(in_sequence), F.lit(0)).cast("long"))
    out = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    whole = ranked(full.withColumn("_g", F.lit(0)), ["_g"], order, order[:2])
    whole = whole.withColumn("sequence_id", F.col("_at") + F.lit(base)).withColumn("offset", F.lit(0).cast("long"))
    return placed.select(out).unionByName(whole.select(out))


def pack_documents(docs: DataFrame, path: str, window: int = WINDOW) -> DataFrame:
    """Tokenize and pack ``docs`` (``doc_id``, ``text``): one row per piece.

    An empty table gives no rows; documents with equal ids are packed each
    on its own; ids may be null.
    """
    with arrow_rows(docs.sparkSession, BATCH_ROWS):  # the pieces are computed inside
        return pack(token_pieces(docs, path, window=window), window)
