"""Mixing sources to target weights, in DataFrame functions alone.

Each source's documents, in a seeded order, are one stream of words, packed into blocks of a fixed length. The mix is a
row of slots, cut into output shards. A shard's source counts are a multinomial draw with the target shares (each of
its slots draws a source by a hash); the few slots by which a source's total misses its quota are then passed from
sources with too many to sources with too few. A source's slots run through its blocks epoch after epoch in a
pseudorandom order: a keyed permutation of the block indexes, computed per slot. Slots and blocks are joined by index.
A source's last, short block closes each epoch, and its last slot takes only the words still due, so that a source's
taken words are its target rounded, however small the source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import WORD, cut_lineage, join_small, read, running_offsets

BLOCK = 64  # words
SHARD = 1024  # slots
CAP = 3.0  # times a source's size
ROUNDS = 24  # of the permutation
CELLS = 4096  # of the table that finds a draw's source
RUN = 1000  # copies of one row that stay in one hash bucket
TASK_SLOTS = 1 << 16  # permuted by one task
SEED = 11
ROW = "_mix_row"  # number of a row, no part of what is hashed


def _hash(*parts) -> Column:
    return F.xxhash64(*[F.lit(x) if isinstance(x, (int, str)) else x for x in parts])


def permuted(index: Column, n: Column, key: Column, rounds: int = ROUNDS) -> Column:
    """A keyed permutation of 0..n-1 applied to ``index``: swap-or-not rounds. A round pairs x with k - x (mod n) and
    swaps a pair or not by a hash of its larger member, so it permutes any n; rounds with other k compose."""
    def turn(x: Column, r: Column) -> Column:
        partner = F.pmod(F.pmod(_hash(SEED, "pair", key, r), n) - x, n)
        swap = F.pmod(_hash(SEED, "swap", key, r, F.greatest(x, partner)), F.lit(2)) == 1
        return F.when(swap, partner).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), index.cast("long"), turn)


def source_targets(sources: DataFrame) -> DataFrame:
    """From (source, source_size): idx (from 0, by code point, null last), weight 1, 2, 3, repeating, and target.

    The targets share the whole size by weight, but none exceeds CAP times its source's size; what is cut is shared
    again by weight. Filling in the order of cap over weight gives the level in one pass: with the caps of the
    sources before it taken out, the first source that the level does not fill fixes it for the rest.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    fill = Window.orderBy("_ratio", "idx")
    everything = Window.partitionBy()
    rows = sources.withColumn("idx", (F.row_number().over(order) - 1).cast("long"))
    rows = rows.withColumn("weight", (F.col("idx") % 3 + 1).cast("double")).withColumn("_cap", CAP * F.col("source_size"))
    rows = rows.withColumn("_ratio", F.col("_cap") / F.col("weight"))
    rows = rows.withColumn("_left", F.sum("source_size").over(everything) - F.sum("_cap").over(fill.rowsBetween(Window.unboundedPreceding, 0)) + F.col("_cap"))
    rows = rows.withColumn("_open", F.sum("weight").over(fill.rowsBetween(0, Window.unboundedFollowing)))
    rows = rows.withColumn("_level", F.min(F.when(F.col("_left") / F.col("_open") <= F.col("_ratio"), F.struct(F.col("_ratio"), F.col("_left") / F.col("_open"))))
                           .over(everything))
    level = F.col("_level")["col2"]
    target = F.when(level.isNull(), F.col("_cap")).otherwise(F.least(F.col("_cap"), level * F.col("weight")))
    return rows.withColumn("target", F.when(F.col("source_size") > 0, target).otherwise(0.0)).drop("_cap", "_ratio", "_left", "_open", "_level")


def row_hashes(docs: DataFrame) -> list[Column]:
    return [F.xxhash64(F.lit(SEED + k), *[F.col(f"`{c}`") for c in docs.columns if c != ROW]).alias(n) for k, n in enumerate(("h", "h2"))]


def copy_numbers(rows: DataFrame) -> DataFrame:
    """Add copy: a number from 0 for rows with the same h and h2. ``rows`` has part, where the row was written; a part's
    copies are numbered by themselves, after those of the parts before, so no task holds all copies of a row."""
    counts = rows.groupBy("h", "h2", "part").agg(F.count(F.lit(1)).alias("_n"))
    ahead = Window.partitionBy("h", "h2").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("h", "h2", "part", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_base"))
    inside = F.row_number().over(Window.partitionBy("h", "h2", "part").orderBy("h")) - 1
    return rows.withColumn("_copy", inside).join(bases, ["h", "h2", "part"]).withColumn("copy", F.col("_base") + F.col("_copy")).drop("_base", "_copy", "part")


def streams(docs: DataFrame, keep: list[str]) -> tuple[DataFrame, DataFrame]:
    """The documents' places in their sources' streams, and the sources; both written tables.

    ``docs`` has text, source and, beside ``keep``, any column that tells rows apart. Places: the columns ``keep``, size,
    idx, at (the first word's place). Sources: source, source_size, idx, weight, target, n_blocks, quota (slots) and
    last_words (that the last slot takes). The order in a source is by a seeded hash of the row; equal rows are
    interchangeable. The running sums go over hash buckets and then inside each, and every RUN copies of a row have
    another bucket, so no task holds a source or a group of equal rows.
    """
    rows = cut_lineage(docs.select(*keep, F.col("source").cast("string").alias("source"), *row_hashes(docs),
                                   F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
                                   F.spark_partition_id().alias("part")))
    sources = source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs")))
    sources = sources.withColumn("n_blocks", F.ceil(F.col("source_size") / BLOCK).cast("long"))
    words = F.round("target").cast("long")
    filled = F.col("source_size") > 0
    epoch_words = F.greatest(F.lit(1), F.col("source_size"))
    rest = F.when(filled, words % epoch_words).otherwise(0)  # beyond whole epochs
    quota = F.when(filled, F.floor(words / epoch_words) * F.col("n_blocks") + F.ceil(rest / BLOCK)).otherwise(0)
    sources = cut_lineage(sources.withColumns({"quota": quota.cast("long"), "last_words": F.when(rest > 0, (rest - 1) % BLOCK + 1).otherwise(BLOCK).cast("long")}))
    named = sources.select(F.col("source").alias("_source"), "idx", F.greatest(F.lit(1), F.ceil(F.col("n_docs") / 2000)).cast("long").alias("_buckets"))
    rows = join_small(copy_numbers(rows), named, F.col("source").eqNullSafe(F.col("_source")))
    rows = rows.withColumn("_bucket", F.pmod(_hash(SEED, F.col("h"), F.floor(F.col("copy") / RUN)), F.col("_buckets")))
    sums = rows.groupBy("idx", "_bucket").agg(F.sum("size").alias("_sum"))
    bases = running_offsets(sums, ["idx"], "_bucket", "_sum", "_base").select("idx", "_bucket", "_base")
    inside = Window.partitionBy("idx", "_bucket").orderBy("h", "h2", "copy").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("_before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    placed = join_small(placed, cut_lineage(bases), ["idx", "_bucket"])
    return cut_lineage(placed.select(*keep, "size", "idx", (F.col("_base") + F.col("_before")).alias("at"))), sources


def slots(sources: DataFrame) -> DataFrame:
    """(shard, slot, idx, block, epoch, words) for each slot of the mix; the slot takes the first ``words`` of its block."""
    spark = sources.sparkSession
    total = sources.agg(F.sum("quota")).first()[0] or 0
    whole = Window.orderBy("idx").rowsBetween(Window.unboundedPreceding, 0)
    shares = sources.where("quota > 0").withColumn("_to", F.sum("quota").over(whole)).withColumn("_from", F.col("_to") - F.col("quota"))
    cell = total / CELLS if total else 1.0
    last = F.least(F.lit(CELLS - 1), F.floor((F.col("_to") - 1e-9) / cell)).cast("int")
    cells = cut_lineage(shares.select("idx", "_from", "_to", F.explode(F.sequence(F.floor(F.col("_from") / cell).cast("int"), F.greatest(F.floor(F.col("_from") / cell).cast("int"), last))).alias("_cell")))
    # a number in [0, total) picks the source whose share holds it
    draws = spark.range(total).select(F.col("id").alias("_n"), F.floor(F.col("id") / SHARD).cast("long").alias("shard"),
                                      (F.pmod(_hash(SEED, "draw", F.col("id")), F.lit(1 << 40)) / float(1 << 40) * total).alias("_u"))
    draws = draws.withColumn("_cell", F.least(F.lit(CELLS - 1), F.floor(F.col("_u") / cell)).cast("int"))
    drawn = join_small(draws, cells, "_cell").where((F.col("_u") >= F.col("_from")) & (F.col("_u") < F.col("_to"))).select("_n", "shard", "idx")
    counts = drawn.groupBy("idx", "shard").agg(F.count(F.lit(1)).alias("n"))
    counts = cut_lineage(running_offsets(counts, ["idx"], "shard", "n", "_base"))
    rank = F.row_number().over(Window.partitionBy("idx", "shard").orderBy("_n")) - 1
    ranked = drawn.withColumn("_rank", rank).join(counts.select("idx", "shard", "_base"), ["idx", "shard"])
    ranked = ranked.select("_n", "shard", "idx", (F.col("_base") + F.col("_rank")).alias("j"))
    ranked = join_small(ranked, sources.select("idx", "quota"), "idx")
    # what was drawn over some quotas is as much as what is missing from others
    totals = counts.groupBy("idx").agg(F.sum("n").alias("got"))
    balance = sources.select("idx", "quota").join(totals, "idx", "left").select("idx", "quota", F.coalesce("got", F.lit(0)).alias("got"))
    upto = Window.orderBy("idx").rowsBetween(Window.unboundedPreceding, -1)
    balance = balance.withColumns({"_over": F.greatest(F.lit(0), F.col("got") - F.col("quota")), "_under": F.greatest(F.lit(0), F.col("quota") - F.col("got"))})
    balance = cut_lineage(balance.withColumns({"_over_at": F.coalesce(F.sum("_over").over(upto), F.lit(0)), "_under_at": F.coalesce(F.sum("_under").over(upto), F.lit(0))}))
    missing = balance.where("_under > 0").select(F.col("idx").alias("_to"), "got", F.col("_under_at"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("_under") - 1)).alias("_k"))
    missing = missing.select((F.col("_under_at") + F.col("_k")).alias("_r"), "_to", (F.col("got") + F.col("_k")).alias("_j"))
    within = ranked.where(F.col("j") < F.col("quota")).select("_n", "shard", "idx", "j")
    over = join_small(ranked.where(F.col("j") >= F.col("quota")), balance.select("idx", "_over_at"), "idx")
    passed = over.withColumn("_r", F.col("_over_at") + F.col("j") - F.col("quota")).join(missing, "_r").select("_n", "shard", F.col("_to").alias("idx"), F.col("_j").alias("j"))
    # the permutation is most of the work, so its tasks go by the number of slots
    final = within.unionByName(passed).repartition(max(1, -(-total // TASK_SLOTS)), "idx", "j")
    final = join_small(final, sources.select("idx", "n_blocks", "source_size", "quota", "last_words"), "idx")
    epoch = F.floor(F.col("j") / F.col("n_blocks")).cast("long")
    index, n_whole = F.col("j") % F.col("n_blocks"), F.floor(F.col("source_size") / BLOCK).cast("long")
    # another order in each epoch
    block = F.when(index < n_whole, permuted(index, F.greatest(F.lit(1).cast("long"), n_whole), _hash(F.col("idx"), epoch))).otherwise(index)
    words = F.when(F.col("j") == F.col("quota") - 1, F.col("last_words")).otherwise(BLOCK).cast("long")
    return final.select("shard", (F.col("_n") % SHARD).alias("slot"), "idx", block.alias("block"), epoch.alias("epoch"), words.alias("words"))


def pieces(placed: DataFrame) -> DataFrame:
    """The parts that blocks cut documents into: idx, block, at (of the document in the stream), first (in the document),
    n, and inside (the part's place in the block), beside the columns of ``placed``."""
    first, last = F.floor(F.col("at") / BLOCK), F.floor((F.col("at") + F.col("size") - 1) / BLOCK)
    parts = placed.where("size > 0").select("*", F.explode(F.sequence(first.cast("long"), last.cast("long"))).alias("block"))
    begin = F.greatest(F.col("at"), F.col("block") * BLOCK)
    end = F.least(F.col("at") + F.col("size"), (F.col("block") + 1) * BLOCK)
    return parts.withColumns({"first": begin - F.col("at"), "n": end - begin, "inside": begin - F.col("block") * BLOCK})


def op7_block_mix(spark, sf_dir):
    """Words taken of each document. Null text: no words. Null source: the last source. Empty input: empty result. Rows
    equal in every column are documents of their own. A source without words has target 0."""
    placed, sources = streams(read(spark, sf_dir, "documents").select("doc_id", "text", "source"), ["doc_id"])
    whole = F.col("words") == BLOCK
    times = slots(sources).groupBy("idx", "block").agg(F.count_if(whole).alias("times"), F.max(F.when(~whole, F.col("words"))).alias("some"))
    some = F.when(F.col("some").isNull(), 0).otherwise(F.greatest(F.lit(0), F.least(F.col("n"), F.col("some") - F.col("inside"))))
    # a document is known by its source and the place of its first word
    taken = (pieces(placed).join(times, ["idx", "block"])
             .groupBy("idx", "at").agg(F.sum(F.col("n") * F.col("times") + some).alias("taken")))
    words = placed.withColumn("_key", F.when(F.col("size") > 0, F.col("at")))
    out = words.join(taken.withColumnRenamed("at", "_key"), ["idx", "_key"], "left")
    out = join_small(out, sources.select("idx", "source_size", "target"), "idx")
    return out.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix as documents: for each document and epoch a row with the words that the mix takes of it then.

    The columns of ``docs`` (text, source and any others) stay; text is the taken words in their order, joined by blanks,
    or the whole text as it is where all its words are taken; n_chars, if there, is the new length. Null texts and texts
    without words have nothing to mix and stay once, as they are. Repeated rows are documents of their own. Empty input:
    empty result. The numbered rows are written once, and their texts shuffled once, to meet their cuts.
    """
    columns = docs.columns
    rows = cut_lineage(docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias(ROW)))
    placed, sources = streams(rows.select("doc.*", ROW), [ROW])
    n = F.least(F.col("n"), F.col("words") - F.col("inside"))
    cut = (pieces(placed).join(slots(sources).drop("shard", "slot"), ["idx", "block"]).withColumn("n", n).where("n > 0")
           .groupBy(ROW, "epoch").agg(F.array_sort(F.collect_list(F.struct("first", "n"))).alias("cuts"), F.sum("n").alias("taken"), F.first("size").alias("size")))
    none = placed.where("size = 0").select(ROW, F.lit(0).cast("long").alias("epoch"), F.lit(None).cast("array<struct<first:bigint,n:bigint>>").alias("cuts"),
                                           F.lit(0).cast("long").alias("taken"), "size")
    part_of = F.col("taken") < F.col("size")
    rows = rows.join(cut.unionByName(none), ROW).withColumn("words", F.when(part_of, F.regexp_extract_all("doc.text", F.lit(WORD), F.lit(0))))
    part = F.array_join(F.flatten(F.transform("cuts", lambda c: F.slice("words", (c["first"] + 1).cast("int"), c["n"].cast("int")))), " ")
    rows = rows.select("doc", F.when(part_of, part).otherwise(F.col("doc.text")).alias("text"))
    value = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return rows.select(*[value.get(c, F.col(f"doc.`{c}`")).alias(c) for c in columns])
