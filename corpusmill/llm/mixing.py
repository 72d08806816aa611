"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree. DataFrame functions only.

1. Each source's documents are dealt by hash into blocks, and its target is met in takings of blocks: every block is taken
   `floor(target / size)` times, and the blocks of a seeded permutation once more until the rest of the target is reached; the
   block in which it is reached is taken document by document, in a taking of its own. So a source has an exact number of
   takings, its block quota.
2. The quotas are split among the output shards by a binary tree. A node has as many slots as its sources' quotas add up to;
   which of them go left is drawn without replacement: the first half of a seeded permutation of the slots, of which only
   the source is known. How many slots of each source go left is then a draw from the multivariate hypergeometric
   distribution. The leaves are quotas of each shard and source that add up exactly.
3. Each source's takings are permuted once more, and each shard draws its quota of them, one shard after the other: its
   takings are disjoint from all other shards', and two takings of a block are drawn like any others.
4. Within a shard, the documents of its takings are put into a seeded order.

Nothing here gathers a source: documents are summed by block before they are summed by source, and only the table of
blocks (at most BLOCKS a source) and its takings are ordered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Blocks of a source, at most; each is a share of 1/BLOCKS of it.
BLOCKS, SHARDS, SEED = 1024, 8, 17
WEIGHTS, SHARE, MOST = (5.0, 2.0, 1.0), 1.5, 2.0


def size_of(text: Column) -> Column:
    """Number of words `[^\\x20\\x09-\\x0D]+` (null: 0): the places where one starts."""
    t = F.coalesce(text, F.lit(""))
    blank = F.translate(t, "\t\n\x0b\x0c\r", "     ")
    words = F.size(F.split(F.trim(blank), " +"))
    return F.when(F.trim(blank) == "", 0).otherwise(words).cast("long")


def _draw(*of: Column) -> Column:
    return F.xxhash64(F.lit(SEED), *of)


def _block(doc_id: Column) -> Column:
    return F.pmod(_draw(F.lit("block"), doc_id.cast("long")), F.lit(BLOCKS)).cast("int")


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, block and a mark of the text, without the text. Repeated rows fall into the same block."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), size_of(F.col("text")).alias("size"), _block(F.col("doc_id")).alias("block"), F.xxhash64("text").alias("mark"))


def targets(blocks: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """source, source_size, target from (source, words). Sources by code point, null last, have the weights in turn.

    Targets are `share` of all words by weight; those above `most` times their source stop there and what is over is
    shared by weight again. That ends at one level: target = min(most * size, level * weight). Ordered by size / weight,
    the sources up to some place stop, and the level is what is left over the weights that are left.
    """
    s = blocks.groupBy("source").agg(F.sum("words").cast("long").alias("source_size"))
    by = Window.orderBy(F.asc_nulls_last("source"))
    w = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(by) - 1, F.lit(len(weights))) + 1).cast("int"))
    s = s.withColumn("weight", w).withColumn("total", F.sum("source_size").over(Window.partitionBy()) * F.lit(share))
    s = s.withColumn("cap", F.col("source_size") * F.lit(most)).withColumn("ratio", F.col("cap") / F.col("weight"))
    order = Window.orderBy("ratio", F.asc_nulls_last("source"))
    s = s.withColumn("stopped", F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    s = s.withColumn("left", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
    s = s.withColumn("here", (F.col("total") - F.col("stopped")) / F.col("left"))
    level = F.max(F.when(F.col("here") <= F.col("ratio"), F.col("here"))).over(Window.partitionBy())
    target = F.when(level.isNull(), F.col("cap")).otherwise(F.least("cap", level * F.col("weight")))
    return s.select("source", "source_size", target.cast("double").alias("target"))


def planned(docs: DataFrame, **how) -> tuple[DataFrame, DataFrame]:
    """Of the documents: sized(), as a table. Of the blocks: source, block, words, targets, times (whole takings), and part (words
    to take besides)."""
    rows = written(sized(docs), "sizes")
    blocks = rows.groupBy("source", "block").agg(F.sum("size").cast("long").alias("words"))
    by_source = targets(blocks, **how).withColumnRenamed("source", "s")
    b = blocks.join(by_source, F.col("source").eqNullSafe(F.col("s"))).select("source", "block", "words", "source_size", "target")
    times = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    b = b.withColumn("times", F.when(F.col("words") > 0, times).otherwise(0)).withColumn("rest", F.round(F.col("target") - times * F.col("source_size")).cast("long"))
    order = Window.partitionBy("source").orderBy(_draw(F.lit("order"), "source", "block"), "block")
    b = b.withColumn("before", F.coalesce(F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    b = b.withColumn("part", F.greatest(F.lit(0), F.least("words", F.col("rest") - F.col("before")))).drop("before", "rest")
    return rows, b


def takings(plan: DataFrame) -> DataFrame:
    """source, block and taking (from 1): a row for each time that a block is taken, the last one being the part."""
    n = (F.col("times") + (F.col("part") > 0).cast("int")).cast("int")
    return plan.where(n > 0).select("source", "block", F.explode(F.sequence(F.lit(1), n)).alias("taking"))


def quotas(counts: DataFrame, shards: int = SHARDS) -> DataFrame:
    """source, shard and quota from (source, n): the splitting tree. Each level halves every node's shards and gives the left
    half its share of the node's slots; nodes with one shard are leaves. The quotas of a source add up to n."""
    b = counts.where("n > 0").select("source", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("slot")).withColumn("lo", F.lit(0)).withColumn("hi", F.lit(shards))
    level = 0
    while (1 << level) < shards:
        node = Window.partitionBy("lo", "hi").orderBy(_draw(F.lit("split"), F.lit(level), "source", "slot"), F.asc_nulls_last("source"), "slot")
        mid = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
        left = F.floor(F.count(F.lit(1)).over(Window.partitionBy("lo", "hi")) * (mid - F.col("lo")) / (F.col("hi") - F.col("lo")))
        go = (F.row_number().over(node) <= left) & (mid > F.col("lo"))
        b = b.withColumn("go", go).withColumn("mid", mid)
        b = b.select("source", "slot", F.when(F.col("go") | (F.col("mid") == F.col("lo")), F.col("lo")).otherwise(F.col("mid")).alias("lo"), F.when(F.col("go"), F.col("mid")).otherwise(F.col("hi")).alias("hi"))
        level += 1
    return b.groupBy("source", F.col("lo").alias("shard")).agg(F.count("*").alias("quota"))


def drawn(taken: DataFrame, quota: DataFrame) -> DataFrame:
    """taken with the shard of each taking: shards draw their quotas from a seeded permutation of the source's takings."""
    ends = F.sum("quota").over(Window.partitionBy("source").orderBy("shard"))
    cuts = quota.withColumn("end", ends).groupBy(F.col("source").alias("s")).agg(F.array_sort(F.collect_list(F.struct("end", "shard"))).alias("cuts"))  # SHARDS entries at most
    place = F.row_number().over(Window.partitionBy("source").orderBy(_draw(F.lit("taking"), "source", "block", "taking"), "block", "taking"))
    at = taken.withColumn("place", place).join(cuts, F.col("source").eqNullSafe(F.col("s")))
    return at.select("source", "block", "taking", F.filter("cuts", lambda c: c["end"] >= F.col("place"))[0]["shard"].alias("shard"))


def dealt_plan(docs: DataFrame, shards: int, **how) -> tuple[DataFrame, DataFrame]:
    """Of the documents: sized(), as a table. Of the blocks, as a table: s, b (source and block), source_size, target, times, part,
    whole (whether the part is the whole block), cut (whether it is neither that nor nothing), and the shard of each taking."""
    rows, plan = planned(docs, **how)
    plan = written(plan, "plan")
    taken = takings(plan)
    dealt = drawn(taken, quotas(taken.groupBy("source").agg(F.count("*").alias("n")), shards))
    of = dealt.groupBy(F.col("source").alias("ds"), F.col("block").alias("db")).agg(F.array_sort(F.collect_list(F.struct("taking", "shard"))).alias("dealt"))  # 2 at most
    p = plan.join(of, F.col("source").eqNullSafe(F.col("ds")) & (F.col("block") == F.col("db")), "left")
    shard = F.coalesce(F.transform("dealt", lambda x: x["shard"]), F.array().cast("array<int>"))
    return rows, written(p.select(F.col("source").alias("s"), F.col("block").alias("b"), "source_size", "target", "times", "part", (F.col("part") == F.col("words")).cast("int").alias("whole"), ((F.col("part") > 0) & (F.col("part") < F.col("words"))).alias("cut"), shard.alias("dealt")), "dealt")


def _copied(d: DataFrame, positive: Column, size: Column, mark: Column) -> DataFrame:
    """d (documents joined with dealt_plan()) with `m`: copies, and of each copy its shard and its place in the shard's order.

    Only the rows of the one block a source is cut in are ordered, to the nearer side of its target.
    """
    ends = Window.partitionBy("s", "b").orderBy(_draw(F.lit("row"), "doc_id"), "doc_id", "_size", "_mark").rowsBetween(Window.unboundedPreceding, 0)
    cut = d.where("cut").withColumn("_size", size).withColumn("_mark", mark).withColumn("_end", F.sum("_size").over(ends))
    near = (F.col("_end") - F.col("part") <= F.col("part") - (F.col("_end") - F.col("_size"))) & (F.col("_size") > 0)
    cut = cut.withColumn("_more", near.cast("int")).drop("_size", "_mark", "_end")
    d = d.where("not cut").withColumn("_more", F.col("whole")).unionByName(cut)
    copies = F.when(positive, F.col("times") + F.col("_more")).otherwise(0).cast("int")
    shards = F.slice("dealt", F.lit(1), copies)
    return d.withColumn("m", F.struct(copies.alias("copies"), shards.alias("shards"), F.transform(shards, lambda x, i: _draw(F.lit("place"), "doc_id", i)).alias("places")))


def mix(docs: DataFrame, shards: int = SHARDS, **how) -> DataFrame:
    """doc_id, size, source_size, target, copies (0 to 2), taken, source, and shards and places (of each copy, its shard and its
    number in the seeded order of that shard's rows) of every row.

    Texts without words are never taken; a source without words has the target 0; a null source is a source, the last; a
    repeated row is a document of its own. An empty table gives no rows.
    """
    rows, plan = dealt_plan(docs, shards, **how)
    d = rows.join(plan, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b")))
    d = _copied(d, F.col("size") > 0, F.col("size"), F.col("mark"))
    return d.select("doc_id", "size", "source_size", "target", "m.copies", (F.size("m.shards") * F.col("size")).cast("long").alias("taken"), "source", "m.shards", "m.places")


def mixed_documents(docs: DataFrame, shards: int = SHARDS, **how) -> DataFrame:
    """The rows of docs, all columns, as often as mix() takes them, by shard in each shard's seeded order. Rows get their copies
    through their block, not through their id: null and repeated ids are rows like others."""
    _, plan = dealt_plan(docs, shards, **how)
    d = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("text").alias("t"))
    d = d.join(plan, F.col("source").eqNullSafe(F.col("s")) & (_block(F.col("doc_id")) == F.col("b")))
    d = _copied(d, F.coalesce(F.col("t").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)), size_of(F.col("t")), F.xxhash64("t"))
    out = d.where("m.copies > 0").select("row", F.explode(F.arrays_zip("m.shards", "m.places")).alias("at"))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = ((F.col("at.places") / F.lit(2.0**64) + 0.5) * max(1, n // shards)).cast("int")  # a range of places
    return out.repartition(n, "at.shards", part).sortWithinPartitions("at.shards", "at.places").select("row.*")


def mixture(mixed: DataFrame) -> DataFrame:
    """The mix itself, from mix(): a row for each copy, shard by shard in the seeded order of each: shard, place, doc_id, copy.

    A shard's rows are dealt to several tasks by ranges of their places.
    """
    m = mixed.where("copies > 0").select("doc_id", F.posexplode(F.arrays_zip("shards", "places")).alias("copy", "at"))
    m = m.select(F.col("at.shards").alias("shard"), F.col("at.places").alias("place"), "doc_id", (F.col("copy") + 1).alias("copy"))
    n = int(mixed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return m.repartitionByRange(n, "shard", "place").sortWithinPartitions("shard", "place", "doc_id", "copy")
