"""Line dedup over all documents.

Lines are hashed; the hashes are range-partitioned with a secondary sort by
document and position. Streaming through a run of equal hashes gives its
first occurrence (that of the largest document id, which keeps its lines) and
the number of documents. The result is a bitmap of dropped positions per
document, kept as its non-zero words; no text is shuffled for it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberledger.llm.common import BLANKS, LOWER, UPPER, cut

MIN_CHARS, MIN_DOCS = 20, 3
#: Positions per bitmap word.
BITS = 63
#: Parts of a run of equal hashes, so that no line is too frequent for a task.
PARTS = 256
#: Bytes up to which the bitmaps may be broadcast.
BROADCAST_BYTES = 32 << 20


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def drop_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """Per document that loses lines: ``doc_id``, ``_th`` (hash of its text)
    and ``words``, an array of (``word``, ``bits``): bit i of word w stands
    for line w * 63 + i. Rows with one id count as one document."""
    spark = docs.sparkSession
    lines = docs.select("doc_id", F.xxhash64("text").alias("_th"), F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
    key = lines.withColumn("key", line_key(F.col("line"))).filter(F.char_length("key") >= min_chars)
    occurrences = cut(key.select(F.xxhash64("key").alias("h"), F.xxhash64(F.lit(7), F.col("key")).alias("h2"), "doc_id", "_th", "pos"))
    # a run of equal hashes is cut by document, so a line of a third of all documents spreads over PARTS tasks
    part = F.pmod(F.xxhash64(F.lit(3), F.col("doc_id")), F.lit(PARTS)).cast("int")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = occurrences.withColumn("part", part).repartitionByRange(n, "h", "h2", "part")
    run = Window.partitionBy("h", "h2", "part").orderBy(F.col("doc_id").desc_nulls_last(), "_th", "pos")
    new = F.row_number().over(run).alias("nth"), F.lag(F.struct("doc_id")).over(run).alias("before")
    firsts = dealt.select("h", "h2", "doc_id", *new).filter((F.col("nth") == 1) | ~F.col("before").eqNullSafe(F.struct("doc_id")))
    found = (
        firsts.groupBy("h", "h2")
        .agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("keeper"))
        .filter(F.col("n_docs") >= min_docs)
        .select("h", "h2", "keeper")
    )
    found = cut(found)
    small = found.limit(1_000_001).count() <= 1_000_000  # 24 bytes a row
    hit = occurrences.join(F.broadcast(found) if small else found, ["h", "h2"])
    words = (
        hit.filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
        .groupBy("doc_id", "_th", F.floor(F.col("pos") / BITS).cast("int").alias("word"))
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("pos") % BITS)).alias("bits"))
    )
    return cut(words.groupBy("doc_id", "_th").agg(F.collect_list(F.struct("word", "bits")).alias("words")))


def with_kept_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with ``_lines`` (all lines) and ``_kept`` (those that stay).

    A line's key is the line without white space at its ends, in lower case
    (A-Z). Keys of at least ``min_chars`` characters found in at least
    ``min_docs`` documents stay only in the document with the largest id that
    holds them (null counts as the smallest). A null or empty text is one
    empty line.
    """
    maps = drop_bitmaps(docs.select("doc_id", "text"), min_chars, min_docs)
    size = maps.agg(F.sum(F.size("words") * 24 + 64)).first()[0] or 0
    maps = maps.select(F.col("doc_id").alias("_doc"), F.col("_th").alias("_hash"), "words")
    keyed = docs.withColumn("_lines", lines_of(F.col("text")))
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.xxhash64("text") == F.col("_hash"))
    joined = keyed.join(F.broadcast(maps) if size <= BROADCAST_BYTES else maps, same, "left")
    bits = F.map_from_entries("words")

    def stays(_line: Column, pos: Column) -> Column:
        word = F.coalesce(F.element_at(F.col("_bits"), F.floor(pos / BITS).cast("int")), F.lit(0).cast("long"))
        return F.call_function("shiftright", word, (pos % BITS).cast("int")).bitwiseAND(F.lit(1)) == 0

    joined = joined.withColumn("_bits", bits)
    kept = F.when(F.col("words").isNull(), F.col("_lines")).otherwise(F.filter("_lines", stays))
    return joined.withColumn("_kept", kept).drop("_doc", "_hash", "words", "_bits")


def line_digests(docs: DataFrame) -> DataFrame:
    """Per document: number of lines, of dropped lines, and the SHA-256 of what stays."""
    k = with_kept_lines(docs.select("doc_id", "text"))
    return k.select(
        "doc_id",
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size("_kept")).cast("long").alias("n_dropped"),
        F.sha2(F.encode(F.array_join("_kept", "\n"), "UTF-8"), 256).alias("kept_sha256"),
    )


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the text of the lines that stay (a null text stays null)."""
    k = with_kept_lines(docs)
    text = F.when(F.col("text").isNotNull(), F.array_join("_kept", "\n"))
    out = {"text": text} | ({"n_chars": F.char_length(text).cast("long")} if "n_chars" in docs.columns else {})
    return k.select(*[out[c].alias(c) if c in out else F.col(f"`{c}`") for c in docs.columns])
