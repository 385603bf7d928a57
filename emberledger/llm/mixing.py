"""Mixing sources to target weights.

The words of a source, its documents end to end, are cut into blocks of a
fixed number of words. Every source has a quota of slots; each slot draws its
output shard by hash, so that the counts of a source over the shards are
multinomial, while the totals of the sources stay on their targets. A slot
maps to a block of its source by a pseudorandom permutation of the block
indexes, and slots and blocks are joined by index. A source whose target is
above its size goes through its blocks again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberledger.llm.common import WORD, cut, lookup, null_last, ranked

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (5, 2, 1)
#: Share of all words that the targets sum to, and the most of a source.
SHARE, MOST = 1.5, 2
BLOCK_WORDS = 256
SHARD_BLOCKS = 4096
ROUNDS = 12
#: Slots of a source that one row generates.
CHUNK = 4096


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """Per source (``_g``, ``source_size``) its ``target``: shares by weight,
    none above ``MOST`` times its size, what is cut off going to the others by
    weight. With the sources ordered by size over weight, the first of them
    whose share fits under its bound fixes the level of all later ones.
    """
    one = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    nth = (F.row_number().over(Window.orderBy("_g")) - 1) % len(WEIGHTS)
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), nth + 1).cast("double")
    s = sizes.withColumn("_weight", weight).withColumn("_most", F.col("source_size").cast("double") * MOST)
    by_level = Window.orderBy(F.col("_most") / F.col("_weight"), "_g")
    before, after = (
        by_level.rowsBetween(Window.unboundedPreceding, -1),
        by_level.rowsBetween(0, Window.unboundedFollowing),
    )
    left = F.lit(SHARE) * F.sum("source_size").over(one) - F.coalesce(F.sum("_most").over(before), F.lit(0.0))
    s = s.withColumn("_level", left / F.sum("_weight").over(after))
    fits = F.when(F.col("_level") * F.col("_weight") <= F.col("_most"), F.col("_level"))
    s = s.withColumn("_fit", fits)
    level = F.first("_fit", ignorenulls=True).over(by_level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return s.withColumn("target", F.least("_most", F.coalesce(level, F.lit(0.0)) * F.col("_weight"))).select(
        "_g", "source_size", "target"
    )


def permuted(index: Column, n: Column, key: Column, seed: int, rounds: int = ROUNDS, back: bool = False) -> Column:
    """A pseudorandom permutation of 0..n-1 that depends on ``key``: in each
    round an index and its mirror image about a hashed point either both stay
    or change places, decided by a hash of the pair. ``back`` undoes it."""

    def step(at: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(F.lit(seed), key, r), n) - at, n)
        swap = F.pmod(F.xxhash64(F.lit(seed + 1), key, r, F.greatest(at, other)), F.lit(2)) == 1
        return F.when(swap, other).otherwise(at)

    return F.aggregate(F.sequence(F.lit(rounds), F.lit(1)) if back else F.sequence(F.lit(1), F.lit(rounds)), index, step)


def mix_plan(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    block_words: int = BLOCK_WORDS,
    shard_blocks: int = SHARD_BLOCKS,
    seed: int = 20,
) -> tuple[DataFrame, DataFrame]:
    """(placed documents with source figures, slots).

    Documents: the columns of ``docs`` but for the text, ``_size``, ``_g``,
    ``_bucket``, ``_row`` (a key of the row), ``_start`` (its place among its
    source's words), ``source_size``, ``target``. Slots: ``_g``, ``_block``,
    ``_epoch``, ``_words`` (how many of the block's words it takes), ``shard``.
    A null source is a source, last in order; a null text has no words.
    """
    sized = docs.withColumn("_size", word_count(text)).withColumn("_g", null_last(source))
    sized = sized.withColumn("_th", F.xxhash64(F.col(text))).drop(text)
    sized = cut(sized)
    sources = cut(source_targets(sized.groupBy("_g").agg(F.sum("_size").alias("source_size"))))
    placed = ranked(sized, ["_g"], [F.col(doc_id), F.col("_size"), F.col("_th")], [F.col(doc_id), F.col("_th")], F.col("_size"))
    placed = lookup(placed.withColumnRenamed("_at", "_start"), sources, "_g")

    def epoch_key(epoch: str) -> Column:
        return F.concat_ws("/", "_g", F.col(epoch).cast("string"))

    b = F.lit(block_words).cast("long")
    want = F.least(F.round("target").cast("long"), F.col("source_size") * MOST)
    s = (
        sources.filter("source_size > 0")
        .withColumn("_want", want)
        .withColumn("_epochs", F.expr("_want div source_size"))
        .withColumn("_rest", F.expr("_want % source_size"))
        .withColumn("_n", F.ceil(F.col("source_size") / b))
        # words that the last block is short of, and its slot in the pass that is taken in part
        .withColumn("_gap", F.col("_n") * b - F.col("source_size"))
        .withColumn("_short", permuted(F.col("_n") - 1, F.col("_n"), epoch_key("_epochs"), seed, back=True))
        .withColumn("_more", F.when(F.col("_short") < F.ceil(F.col("_rest") / b), F.col("_gap")).otherwise(0))
        .withColumn("_slots", F.col("_epochs") * F.col("_n") + F.ceil((F.col("_rest") + F.col("_more")) / b))
        .withColumn("_shards", F.ceil(F.sum("_slots").over(Window.partitionBy()) / F.lit(shard_blocks)))
        .filter("_slots > 0")
        .withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(_slots - 1) div {CHUNK}"))))
        .repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "_g", "_chunk")
        .withColumn(
            "_slot",
            F.explode(F.sequence(F.col("_chunk") * CHUNK, F.least(F.col("_slots"), (F.col("_chunk") + 1) * CHUNK) - 1)),
        )
    )
    k, g = F.expr("_slot % _n"), F.col("_g")
    s = s.withColumn("_epoch", F.expr("_slot div _n")).withColumn("_k", k)
    s = s.withColumn("_block", permuted(F.col("_k"), F.col("_n"), epoch_key("_epoch"), seed))
    whole = F.least(b, F.col("source_size") - F.col("_block") * b)
    before = F.col("_k") * b - F.when(F.col("_k") > F.col("_short"), F.col("_gap")).otherwise(0)
    last = F.least(whole, F.col("_rest") - before)
    slots = s.select(
        "_g",
        "_block",
        "_epoch",
        F.when(F.col("_epoch") < F.col("_epochs"), whole).otherwise(last).cast("int").alias("_words"),
        F.pmod(F.xxhash64(F.lit(seed + 2), g, F.col("_slot")), F.col("_shards")).alias("shard"),
    )
    return placed, slots


def shard_counts(slots: DataFrame) -> DataFrame:
    """Blocks that each output shard draws from each source."""
    return slots.groupBy("shard", "_g").agg(F.count("*").alias("blocks"))


def pieces(placed: DataFrame, slots: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Join blocks by index: a row for every part of a document in a block
    and every slot that takes it, with the part's first and last word in the
    document (``_lo``, ``_hi``, end exclusive; none if no slot takes it)."""
    b = F.lit(block_words).cast("long")
    first, end = F.col("_start"), F.col("_start") + F.col("_size")
    blocks = F.when(F.col("_size") > 0, F.sequence((first / b).cast("long"), ((end - 1) / b).cast("long")))
    parts = placed.withColumn("_block", F.explode_outer(blocks))
    # a slot per block grows with the data and its size can't be seen before it is made: never broadcast
    joined = parts.join(slots.hint("merge"), ["_g", "_block"], "left")
    at = F.col("_block") * b
    lo = F.greatest(first, at) - first
    hi = F.least(end, at + F.col("_words")) - first
    return joined.withColumn("_lo", F.when(F.col("_words").isNotNull() & (hi > lo), lo)).withColumn(
        "_hi", F.when(F.col("_lo").isNotNull(), hi)
    )


def mix_taken(docs: DataFrame, block_words: int = BLOCK_WORDS, **options) -> DataFrame:
    """Per document its ``size``, ``source_size``, ``target``, ``taken``
    words (repeats counted) and ``shards``: the output shards that drew it, in
    order, and the words each takes. Every row of ``docs`` gives one row; an
    empty table gives none; a document without words takes none. Null ids,
    equal rows and very long texts (cut over many blocks) need no care of the
    caller; other columns are left out."""
    placed, slots = mix_plan(docs.select("doc_id", "text", "source"), block_words=block_words, **options)
    p = pieces(placed.drop("source", "_th"), slots, block_words)
    words = (F.col("_hi") - F.col("_lo")).cast("long")
    numbers = F.array_sort(F.array_distinct(F.transform("_drawn", lambda x: x["shard"])))

    def total(shard: Column) -> Column:
        own = F.filter("_drawn", lambda x: x["shard"] == shard)
        return F.struct(shard.alias("shard"), F.aggregate(own, F.lit(0).cast("long"), lambda n, x: n + x["words"]).alias("words"))

    return (
        p.groupBy("_g", "_bucket", "_row", "doc_id", F.col("_size").alias("size"), "source_size", "target")
        .agg(
            F.coalesce(F.sum(words), F.lit(0)).cast("long").alias("taken"),
            F.collect_list(F.when(words > 0, F.struct("shard", words.alias("words")))).alias("_drawn"),
        )
        .select("doc_id", "size", "source_size", "target", "taken", F.transform(numbers, total).alias("shards"))
    )


def mix_documents(docs: DataFrame, block_words: int = BLOCK_WORDS, shard: str | None = None, **options) -> DataFrame:
    """The mix as documents: for each epoch in which a document is drawn, one
    row with the words taken. A document taken whole keeps its text as it is;
    of one taken in part, the words are joined by single spaces. With
    ``shard``, the name of a column to add, there is one row for each epoch
    and output shard, so that the mix can be written by shard. Other columns
    are kept; an empty table gives no rows; null ids are values of their own.
    """
    columns = docs.columns
    placed, slots = mix_plan(docs.select("doc_id", "text", "source"), block_words=block_words, **options)
    placed = placed.withColumn("_k", F.xxhash64("doc_id")).select("_g", "_bucket", "_row", "_k", "_th", "_size", "_start")
    key = ["_k", "_th", "_g"]
    by = [F.col("shard").alias("_shard")] if shard else []
    spans = (
        pieces(placed, slots, block_words)
        .filter("_lo is not null")
        .groupBy(*key, "_bucket", "_row", "_size", "_epoch", *by)
        .agg(F.sort_array(F.collect_list(F.struct("_lo", "_hi"))).alias("_spans"), F.sum(F.col("_hi") - F.col("_lo")).alias("_taken"))
        .withColumn("_spans", F.when(F.col("_taken") < F.col("_size"), F.col("_spans")))
    )
    # rows with one id, text and source are numbered on both sides, so that each gets its own share
    own = Window.partitionBy(*key, "_epoch").orderBy("_bucket", "_row")
    spans = spans.select(*key, F.dense_rank().over(own).alias("_nth"), "_spans", *(["_shard"] if shard else []))
    keyed = docs.withColumns({"_k": F.xxhash64("doc_id"), "_th": F.xxhash64("text"), "_g": null_last("source")})
    numbered = keyed.withColumn("_nth", F.row_number().over(Window.partitionBy(*key).orderBy("_th")))
    # as a range, so that the text is shuffled once, by the key of the window
    same = (F.col("d._nth") <= F.col("s._nth")) & (F.col("d._nth") >= F.col("s._nth"))
    for c in key:
        same = same & (F.col(f"d.{c}") == F.col(f"s.{c}"))
    j = numbered.alias("d").join(spans.alias("s"), same)
    words = F.regexp_extract_all(F.col("d.text"), F.lit(WORD), F.lit(0))
    cutout = F.array_join(
        F.flatten(F.transform(F.col("s._spans"), lambda x: F.slice(words, x["_lo"].cast("int") + 1, (x["_hi"] - x["_lo"]).cast("int")))), " "
    )
    text = F.when(F.col("s._spans").isNull(), F.col("d.text")).otherwise(cutout)
    out = {"text": text} | ({"n_chars": F.char_length(text).cast("long")} if "n_chars" in columns else {})
    kept = [out[c].alias(c) if c in out else F.col(f"d.`{c}`").alias(c) for c in columns]
    return j.select(*kept, *([F.col("s._shard").alias(shard)] if shard else []))
