"""Suffix-array dedup of byte strings that repeat across documents.

A byte goes if a string of ``SPAN`` bytes that covers it also starts in a
document with a smaller id. Texts are never gathered: equal strings meet in a
shard, chosen by what they hold.

1. Documents with equal texts are one; the later ones go whole.
2. Every window of ``SPAN`` bytes has a sampled string: the one of its
   ``SAMPLE``-byte strings with the least hash. Equal windows have equal
   sampled strings, so a window can repeat only if its sampled string is in
   two documents. Tasks send the hashes of the sampled strings of a batch of
   documents once each; a filter of bounded size is made of the shared ones.
3. The runs of windows that share a sampled string and pass the filter are
   cut out as fragments of at most ``2 SPAN - SAMPLE`` bytes, and sent, each
   once per batch, to the bucket of that string. Sampled strings found in very
   many documents are dealt out by whole windows instead.
4. In a bucket, the different fragments are laid end to end in shards. Each
   shard's suffix array is induced and its permuted common prefixes give the
   classes of equal windows: the smallest document id of a class is the
   first holder. What goes back to a batch is, per fragment, the first holder of
   the whole and a bit mask of the windows that an earlier document holds.
5. The batches turn masks into spans, and the spans are cut from the texts.

Hot passages cost one fragment per batch, whatever number of documents hold
them, and no step holds more than a batch, a bucket or a shard.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberledger.llm.common import Scope, by_key, lookup, pack, unpack
from emberledger.llm.induced_sorting import common_prefixes, suffix_array

SPAN = 50
#: Bytes of a sampled string; a window has ``SPAN - SAMPLE + 1`` of them.
SAMPLE = 24
#: Bytes of text that a batch takes together, of sampled hashes that a bucket gets, and of a shard's text.
BATCH, BUCKET, SHARD = 16 << 20, 8 << 20, 2 << 20
#: Bits of the filter per shared string, and in all: beyond it lets more through, with the same result.
FILTER_BITS, FILTER_MOST = 16, 1 << 30
#: Documents from which on a sampled string's windows are dealt out one by one.
BUSY = 50_000
_ODD = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
LOW = 40


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def string_hashes(b: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of every ``k``-byte string of ``b``, by doubling."""
    parts = {1: b.astype(np.uint64)}
    m = 1
    while 2 * m <= k:
        h = parts[m]
        parts[2 * m] = h[:-m] * np.uint64(pow(_ODD, m, 1 << 64)) + h[m:]
        m *= 2
    out, used = parts[m], m
    for m in sorted(parts, reverse=True):
        if used + m <= k:
            n = len(b) - used - m + 1
            out = out[:n] * np.uint64(pow(_ODD, m, 1 << 64)) + parts[m][used : used + n]
            used += m
    return _mixed(out)


def sampled(b: np.ndarray, span: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The runs of windows of a text that share their sampled string: hash,
    first window, number of windows (at most ``span - k + 1``)."""
    n, width = len(b) - span + 1, span - k + 1
    if n <= 0:
        return np.zeros(0, "u8"), np.zeros(0, "i8"), np.zeros(0, "i8")
    least, step = string_hashes(b, k), 1
    while 2 * step <= width:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if step < width:
        least = np.minimum(least[:n], least[width - step : width - step + n])
    starts = np.append(0, np.flatnonzero(least[1:] != least[:-1]) + 1)
    counts = np.diff(np.append(starts, n))
    if (counts > width).any():  # a repeating text: cut the run
        pieces = -(-counts // width)
        at = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        starts, left = np.repeat(starts, pieces) + at * width, np.repeat(counts, pieces) - at * width
        counts = np.minimum(left, width)
    # least hashes are small numbers: mixed again, their bits are even
    return _mixed(least[starts] * np.uint64(_ODD)), starts, counts


def _batches(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[list, list, list]]:
    """Ids, text hashes and texts (as bytes) of about ``size`` bytes of text."""
    ids, keys, texts, held = [], [], [], 0
    for batch in batches:
        for i, k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary()).to_pylist()):
            ids.append(i)
            keys.append(k)
            texts.append(t)
            held += len(t)
            if held >= size:
                yield ids, keys, texts
                ids, keys, texts, held = [], [], [], 0
    if ids:
        yield ids, keys, texts


def _scan(texts: list[bytes], span: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``sampled`` of every text, with the text's number."""
    found = [sampled(np.frombuffer(t, np.uint8), span, k) for t in texts]
    hashes, starts, counts = (np.concatenate([f[j] for f in found]) for j in range(3))
    return hashes, np.repeat(np.arange(len(texts)), [len(f[0]) for f in found]), starts, counts


def _prefix(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Of a hash: the bucket (``bits`` bits) and the ``LOW`` bits after it."""
    return hashes >> np.uint64(64 - LOW - bits)


def _fives(values: np.ndarray) -> bytes:
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def _from_fives(body: bytes) -> np.ndarray:
    out = np.zeros((len(body) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(body, np.uint8).reshape(-1, 5)
    return out.view("<u8").ravel()


# -- shared sampled strings -----------------------------------------------


def _shared_strings(texts: DataFrame, bits: int, span: int, k: int, busy: int, scope: Scope) -> DataFrame:
    """Per bucket: how many sampled strings are in two documents, and in
    ``busy`` ones, and their low bits."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, part in _batches(batches, BATCH):
            hashes, doc, _, _ = _scan(part, span, k)
            if not len(hashes):
                continue
            prefix = _prefix(hashes, bits)
            order = np.argsort(prefix, kind="stable")
            prefix, doc = prefix[order], doc[order]
            new = np.append(True, prefix[1:] != prefix[:-1])
            starts = np.flatnonzero(new)
            docs = np.add.reduceat(np.append(True, new[1:] | (doc[1:] != doc[:-1])).astype("i8"), starts)
            prefix = prefix[starts]
            edges = np.searchsorted(prefix >> np.uint64(LOW), np.arange((1 << bits) + 1))
            rows = []
            for b in np.flatnonzero(np.diff(edges)).tolist():
                lo, hi = edges[b], edges[b + 1]
                more = np.flatnonzero(docs[lo:hi] > 1)
                rows.append((b, _fives(prefix[lo:hi]), more.astype("<u4").tobytes(), docs[lo:hi][more].astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.binary(), pa.binary(), pa.binary()))],
                names=["bucket", "low", "at", "docs"],
            )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in by_key(batches):
            low = np.concatenate([_from_fives(r[1]) for r in rows])
            docs, base = np.ones(len(low), "i8"), 0
            for r in rows:
                docs[base + np.frombuffer(r[2], "<u4")] = np.frombuffer(r[3], "<u4")
                base += len(r[1]) // 5
            order = np.argsort(low)
            low = low[order]
            starts = np.flatnonzero(np.append(True, low[1:] != low[:-1]))
            docs = np.add.reduceat(docs[order], starts)
            low = low[starts]
            one, two = low[docs > 1], low[docs > busy]
            yield pa.RecordBatch.from_arrays(
                [pa.array([bucket], pa.int32()), pa.array([len(one)], pa.int64()), pa.array([len(two)], pa.int64()),
                 pa.array([_fives(one)], pa.binary()), pa.array([_fives(two)], pa.binary())],
                names=["bucket", "n_shared", "n_busy", "shared", "busy"],
            )

    sent = texts.mapInArrow(send, "bucket int, low binary, at binary, docs binary")
    sent = sent.repartition(1 << min(bits, 15), "bucket").sortWithinPartitions("bucket")
    return scope.cut(sent.mapInArrow(meet, "bucket int, n_shared long, n_busy long, shared binary, busy binary"))


def _places(low: np.ndarray, size: int) -> list[np.ndarray]:
    """Two bits of a filter segment of ``size`` bits for each value."""
    x = _mixed(low * np.uint64(_ODD))
    return [x % np.uint64(size), (x >> np.uint64(32)) * np.uint64(0xC2B2AE3D27D4EB4F) % np.uint64(size)]


def _filter(shared: DataFrame, column: str, count: int, bits: int) -> np.ndarray:
    """A Bloom filter of the strings of ``column``, a segment per bucket: at
    most ``FILTER_MOST`` bits, whatever the input."""
    want = min(FILTER_MOST, max(1, FILTER_BITS * count))
    size = 1 << max(6, want.bit_length() - bits) if count else 8

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bucket, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held = np.zeros(size, bool)
                for at in _places(_from_fives(body), size):
                    held[at] = True
                yield pa.RecordBatch.from_arrays(
                    [pa.array([bucket], pa.int32()), pa.array([np.packbits(held, bitorder="little").tobytes()], pa.binary())],
                    names=["bucket", "body"],
                )

    out = np.zeros((1 << bits, size // 8), np.uint8)
    if count:
        some = shared.filter(f"n_{column} > 0").select("bucket", column)
        for bucket, body in some.mapInArrow(segments, "bucket int, body binary").toLocalIterator():
            out[bucket] = np.frombuffer(body, np.uint8)
    return out


def _passes(filter_: np.ndarray, hashes: np.ndarray, bits: int) -> np.ndarray:
    prefix = _prefix(hashes, bits)
    bucket, low = (prefix >> np.uint64(LOW)).astype("i8"), prefix & np.uint64((1 << LOW) - 1)
    flat, size = filter_.ravel(), filter_.shape[1] * 8
    out = np.ones(len(hashes), bool)
    for at in _places(low, size):
        bit = bucket * size + at.astype("i8")
        out &= (flat[bit >> 3] >> (bit & 7).astype(np.uint8) & 1).astype(bool)
    return out


# -- fragments ------------------------------------------------------------


def _fragments(texts: DataFrame, some: np.ndarray, busy: np.ndarray, bits: int, span: int, k: int, scope: Scope) -> DataFrame:
    """Per batch and bucket: the batch's different fragments and where they
    are; and per batch (bucket -1) its documents."""
    sent = texts.sparkSession.sparkContext.broadcast((some, busy))  # two filters of at most FILTER_MOST bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        some, busy = sent.value
        no = TaskContext.get().partitionId() << 32
        for ids, keys, part in _batches(batches, BATCH):
            hashes, doc, start, count = _scan(part, span, k)
            keep = _passes(some, hashes, bits)
            hashes, doc, start, count = hashes[keep], doc[keep], start[keep], count[keep]
            if not len(hashes):
                continue
            alone = _passes(busy, hashes, bits)
            if alone.any():  # deal these out window by window
                many = np.where(alone, count, 1)
                at = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                single = np.repeat(alone, many)
                hashes, doc, start = np.repeat(hashes, many), np.repeat(doc, many), np.repeat(start, many) + np.where(single, at, 0)
                count = np.where(single, 1, np.repeat(count, many))
            else:
                single = alone
            cuts = [part[d][s:e] for d, s, e in zip(doc.tolist(), start.tolist(), (start + count + span - 1).tolist())]
            digest = np.fromiter(map(xxhash.xxh3_64_intdigest, cuts), "u8", len(cuts))
            hashes = np.where(single, _mixed(digest), hashes)
            order = np.lexsort((digest, hashes))
            h, f = hashes[order], digest[order]
            new = np.append(True, (h[1:] != h[:-1]) | (f[1:] != f[:-1]))
            heads = np.flatnonzero(new)
            first = np.minimum.reduceat(np.array(ids, "i8")[doc[order]], heads)
            of = np.cumsum(new) - 1  # fragment of each place
            bucket = (h[heads] >> np.uint64(64 - bits)).astype("i8")
            edges = np.searchsorted(bucket, np.arange((1 << bits) + 1))
            at = np.searchsorted(of, edges)
            rows = [(no, -1, pack(np.array(ids, "<i8"), np.array(keys, "<i8")), None)]
            for b in np.flatnonzero(np.diff(edges)).tolist():
                lo, hi, i, j = edges[b], edges[b + 1], at[b], at[b + 1]
                own = heads[lo:hi]
                frags = pack(h[own], f[own], first[lo:hi], count[order[own]].astype("u1"), b"".join([cuts[x] for x in order[own].tolist()]))
                places = order[i:j]
                where = pack((of[i:j] - lo).astype("<u4"), doc[places].astype("<u4"), start[places].astype("<u4"), count[places].astype("u1"))
                rows.append((no, b, frags, where))
            no += 1
            for lo in range(0, len(rows), 256):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows[lo : lo + 256]), (pa.int64(), pa.int32(), pa.binary(), pa.binary()))],
                    names=["batch", "bucket", "body", "places"],
                )

    return scope.cut(texts.mapInArrow(run, "batch long, bucket int, body binary, places binary"))


def first_holders(firsts: np.ndarray, counts: np.ndarray, texts: list[bytes], span: int, shard: int = SHARD) -> np.ndarray:
    """For different fragments with the smallest id that holds each: a bit
    mask of the windows that a document with a smaller id holds."""
    masks = np.zeros(len(texts), "u8")
    sizes = np.fromiter(map(len, texts), "i8", len(texts))
    glue = b"\x00".join(texts) + b"\x00"
    # bytes of UTF-8 are below 0xF5: moved up by one, 0 is left for what is between fragments
    s = np.frombuffer(glue, np.uint8) + np.uint8(1)
    starts = np.cumsum(sizes + 1) - sizes - 1
    s[starts + sizes] = 0
    sa = suffix_array(s)
    shared = common_prefixes(s, sa, span)
    offset = np.arange(len(s)) - np.repeat(starts, sizes + 1)
    owner = np.repeat(np.arange(len(texts)), sizes + 1)
    window = offset < np.repeat(counts, sizes + 1)
    sa = sa[window[sa]]  # suffixes that start a window; others share fewer than span bytes without a break
    if not len(sa):
        return masks
    new = shared[sa] < span
    new[0] = True
    heads = np.flatnonzero(new)
    least = np.minimum.reduceat(firsts[owner[sa]], heads)[np.cumsum(new) - 1]
    hit = sa[least < firsts[owner[sa]]]
    np.bitwise_or.at(masks, owner[hit], np.uint64(1) << offset[hit].astype("u8"))
    return masks


def _answers(frags: DataFrame, bits: int, span: int, shard: int) -> DataFrame:
    """Per batch and bucket, for each of the batch's fragments there: the
    smallest id that holds it, and the mask of ``first_holders``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in by_key(batches):
            blocks = [unpack(r[2], "<u8", "<u8", "<i8", "u1", "bytes") for r in rows]
            h, f, first, count = (np.concatenate([b[j] for b in blocks]) for j in range(4))
            order = np.lexsort((f, h))
            h, f, first, count = h[order], f[order], first[order], count[order].astype("i8")
            new = np.append(True, (h[1:] != h[:-1]) | (f[1:] != f[:-1]))
            heads = np.flatnonzero(new)
            least = np.minimum.reduceat(first, heads)
            # the bytes of one of each
            sizes = np.concatenate([b[3] for b in blocks]).astype("i8") + span - 1
            ends = np.concatenate([np.cumsum(b[3].astype("i8") + span - 1) for b in blocks])
            block = np.repeat(np.arange(len(blocks)), [len(b[0]) for b in blocks])
            pick = order[heads]
            texts = [blocks[b][4][e - n : e] for b, e, n in zip(block[pick].tolist(), ends[pick].tolist(), sizes[pick].tolist())]
            # shards: whole groups of a sampled string
            group = np.flatnonzero(np.append(True, h[heads][1:] != h[heads][:-1]))
            total = np.append(0, np.cumsum(sizes[pick]))
            masks, lo = np.zeros(len(heads), "u8"), 0
            while lo < len(heads):
                at = np.searchsorted(group, np.searchsorted(total, total[lo] + shard), "right") - 1
                hi = int(group[at]) if group[at] > lo else int(np.append(group, len(heads))[np.searchsorted(group, lo, "right")])
                if total[-1] - total[lo] <= shard:
                    hi = len(heads)
                masks[lo:hi] = first_holders(least[lo:hi], count[heads[lo:hi]], texts[lo:hi], span)
                lo = hi
            number = np.empty(len(order), "i8")
            number[order] = np.cumsum(new) - 1
            edges = np.append(0, np.cumsum([len(b[0]) for b in blocks]))
            for r, lo, hi in zip(rows, edges, edges[1:]):
                which = number[lo:hi]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[1]], pa.int64()), pa.array([bucket], pa.int32()), pa.array([pack(least[which], masks[which])], pa.binary())],
                    names=["batch", "bucket", "body"],
                )

    rows = frags.filter("bucket >= 0").select("bucket", "batch", "body")
    rows = rows.repartition(1 << min(bits, 15), "bucket").sortWithinPartitions("bucket", "batch")
    return rows.mapInArrow(run, "batch long, bucket int, body binary")


def merged(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals of each document, joined where they overlap or touch."""
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    step = int(end.max(initial=0)) + 2  # documents apart on one axis
    far = np.maximum.accumulate(doc * step + end)
    new = np.append(True, (doc * step + start)[1:] > far[:-1])
    heads = np.flatnonzero(new)
    return doc[heads], start[heads], np.maximum.reduceat(end, heads)


def _spans(frags: DataFrame, answers: DataFrame, span: int) -> DataFrame:
    """``doc_id``, ``k1`` and the removed intervals of documents that lose bytes."""
    asked = frags.select("batch", "bucket", F.when(F.col("bucket") >= 0, F.col("places")).otherwise(F.col("body")).alias("body"), F.lit(0).alias("kind"))
    both = asked.unionByName(answers.select("batch", "bucket", "body", F.lit(1).alias("kind")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in by_key(batches):
            ids = keys = None
            parts, places = [], None
            for _, bucket, kind, body in rows:
                if bucket < 0:
                    ids, keys = unpack(body, "<i8", "<i8")
                elif kind == 0:
                    places = unpack(body, "<u4", "<u4", "<u4", "u1")
                else:
                    least, masks = unpack(body, "<i8", "<u8")
                    of, doc, start, count = (p.astype("i8") for p in places)
                    later = ids[doc] > least[of]
                    parts.append((doc[later], start[later], start[later] + count[later] + span - 1))
                    some = ~later & (masks[of] > 0)
                    bit, doc, start = masks[of][some], doc[some], start[some]
                    for j in range(int(bit.max(initial=0)).bit_length() if len(bit) else 0):
                        on = (bit >> np.uint64(j) & np.uint64(1)).astype(bool)
                        parts.append((doc[on], start[on] + j, start[on] + j + span))
            if not parts or not sum(len(p[0]) for p in parts):
                continue
            doc, start, end = merged(*(np.concatenate([p[j] for p in parts]) for j in range(3)))
            heads = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
            edges = np.append(heads, len(doc)).tolist()
            pairs = np.stack([start, end], axis=1).astype("<i8")
            which = doc[heads]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[which]), pa.array(keys[which]), pa.array([pairs[a:b].tobytes() for a, b in zip(edges, edges[1:])], pa.binary())],
                names=["doc_id", "k1", "spans"],
            )

    both = both.repartition("batch").sortWithinPartitions("batch", "bucket", "kind").select("batch", "bucket", "kind", "body")
    return both.mapInArrow(run, "doc_id long, k1 long, spans binary")


# -- documents ------------------------------------------------------------


def removed_spans(docs: DataFrame, span: int = SPAN, sample: int = SAMPLE, busy: int = BUSY, shard: int = SHARD) -> DataFrame:
    """Per row of ``docs`` (``doc_id`` an integer, ``text``): ``doc_id``,
    ``text``, and ``spans``, the byte intervals that go (pairs of
    little-endian 64-bit start and end), null without any."""
    scope = Scope(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = docs.select("doc_id", text.alias("text")).withColumn("k1", F.xxhash64("text"))
    keyed = base.select("doc_id", "k1", F.xxhash64(F.lit(1), "text").alias("k2"), F.octet_length("text").cast("long").alias("size"))
    keyed = scope.cut(keyed.filter("doc_id is not null"))
    size = keyed.agg(F.sum("size")).first()[0] or 0
    bits = max(4, int(size * 10 // (span - sample) // BUCKET).bit_length())
    groups = keyed.filter(f"size >= {span}").groupBy("k1", "k2", "size").agg(F.min("doc_id").alias("rep"), F.count("*").alias("c"))
    copies = scope.cut(lookup(keyed, scope.cut(groups.filter("c > 1").drop("c")), ["k1", "k2", "size"], "inner").filter("doc_id > rep").select("doc_id", "k1", "size").distinct())
    first = lookup(base.filter(f"doc_id is not null and octet_length(text) >= {span}").select("doc_id", "k1", "text"), copies, ["doc_id", "k1"], "left_anti")
    texts = first.select(F.col("doc_id").cast("long"), "k1", "text")

    shared = _shared_strings(texts, bits, span, sample, busy, scope)
    n_shared, n_busy = shared.agg(F.coalesce(F.sum("n_shared"), F.lit(0)), F.coalesce(F.sum("n_busy"), F.lit(0))).first()
    some, often = _filter(shared, "shared", n_shared, bits), _filter(shared, "busy", n_busy, bits)
    frags = _fragments(texts, some, often, bits, span, sample, scope)
    answers = scope.cut(_answers(frags, bits, span, shard))
    whole = copies.select(F.col("doc_id").cast("long"), "k1", _whole_span(F.col("size")).alias("spans"))
    # repeated rows (equal id and text) have equal spans
    spans = scope.cut(_spans(frags, answers, span).unionByName(whole).dropDuplicates(["doc_id", "k1"]))
    spans = spans.withColumnsRenamed({"doc_id": "_id", "k1": "_k"})
    return lookup(base.withColumns({"_id": F.col("doc_id").cast("long"), "_k": F.col("k1")}), spans, ["_id", "_k"]).select("doc_id", "text", "spans")


def _whole_span(size):
    """The interval from 0 to ``size`` as two little-endian 64-bit numbers."""
    turned = F.concat(*[F.substring(F.lpad(F.hex(size), 16, "0"), 15 - 2 * i, 2) for i in range(8)])
    return F.unhex(F.concat(F.lit("0" * 16), turned))


def dedup_texts(docs: DataFrame, **options) -> DataFrame:
    """``doc_id`` and what is left of each text, as bytes (a cut may fall
    inside a character)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left = [_without(t, s)[0] for t, s in _texts_and_spans(batch)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(left, pa.binary())], names=["doc_id", "kept"])

    spans = removed_spans(docs, **options)
    return spans.mapInArrow(run, f"doc_id {spans.schema[0].dataType.simpleString()}, kept binary")


def _texts_and_spans(batch: pa.RecordBatch) -> Iterator[tuple[bytes, list]]:
    for t, s in zip(batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist()):
        yield t, np.frombuffer(s, "<i8").reshape(-1, 2).tolist() if s else []


def _without(text: bytes, spans: list) -> tuple[bytes, int]:
    at, left = 0, []
    for lo, hi in spans:
        left.append(text[at:lo])
        at = hi
    left.append(text[at:])
    kept = b"".join(left)
    return kept, len(text) - len(kept)


def dedup_digests(docs: DataFrame, **options) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_bytes``, ``n_removed``,
    ``n_spans`` and ``kept_sha256``.

    A null text is empty. Texts shorter than ``SPAN`` bytes lose and cause
    nothing, nor do rows with a null id. Rows with equal ids take nothing from
    each other; each is judged by its own text. Of equal texts all but those with the
    smallest id go whole. Texts of any length are taken whole, other columns
    left out; no documents, no rows.
    """
    spans = removed_spans(docs, **options)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for t, s in _texts_and_spans(batch):
                kept, gone = _without(t, s)
                rows.append((len(t), gone, len(s), hashlib.sha256(kept).hexdigest()))
            cols = list(zip(*rows)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    kind = spans.schema[0].dataType.simpleString()
    return spans.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
