"""Mixing sources to target weights.

Every document gets a hash-random key. Within a source the documents are sorted by it, range by range:
the keys are uniform, so equal widths are the quantiles and need no sample. Totals of the ranges give each
range its offset, sorted rows inside give the rest of the prefix sum, and the source is cut at its budget of
words, after as many whole passes as the budget holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from obsloom.llm.quality import words_of
from obsloom.llm.texts import Sealed, pick, text_mark, whole_text
from obsloom.session import checkpointed

WEIGHTS = (5, 2, 1)
#: Words of the mix as a share of all words, and of a source's words at most, both in hundredths.
MIX_PERCENT = 150
MOST_PERCENT = 200
#: A key has 60 bits; so many leading bits name its range.
KEY_BITS, RANGE_BITS = 60, 10
SOURCE = ("src", "no_src")


def random_key(name: str, seed: int) -> Column:
    """60 bits of the MD5 of seed and identifier; a null identifier counts as empty text."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(name).cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, KEY_BITS // 4), 16, 10).cast("long")


def sized(docs: DataFrame, source: str, seed: int) -> DataFrame:
    """The thin rows that are sorted: identifier, text mark, source, words, key and range."""
    rows = pick(docs, "doc_id", "text", source).toDF("doc_id", "text", "source")
    return rows.select(
        "doc_id",
        text_mark(whole_text()).alias("mark"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("src"),
        F.col("source").isNull().alias("no_src"),
        F.size(words_of(whole_text())).cast("long").alias("size"),
        random_key("doc_id", seed).alias("key"),
    ).withColumn("range", F.shiftright("key", KEY_BITS - RANGE_BITS).cast("int"))


def targets(totals: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """From one row per source (src, no_src, source_size): its target, and its budget in whole words.

    Sources in code-point order, null last, get the weights in turn. Sorted by size per weight, a source
    stops at its cap when its share of what the sources before it leave is larger; the others share what
    is then left by weight. The windows run over one row per source.
    """
    by_name = Window.orderBy("no_src", "src")
    weight = F.get(F.array(*map(F.lit, weights)), (F.row_number().over(by_name) - 1) % len(weights)).cast("long")
    by_room = Window.orderBy(F.col("source_size") / F.col("weight"), "no_src", "src")
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = F.lit(0).cast("long")
    cap = F.col("source_size") * MOST_PERCENT
    turn = (
        totals.withColumn("weight", weight)
        .withColumn("mix", F.sum("source_size").over(whole) * MIX_PERCENT)
        .withColumn("cap_before", F.coalesce(F.sum(cap).over(before), zero))
        .withColumn("weight_left", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), zero))
        .withColumn("capped", (F.col("mix") - F.col("cap_before")) * F.col("weight") > cap * F.col("weight_left"))
    )
    shared = (
        turn.withColumn("left", F.col("mix") - F.coalesce(F.sum(F.when(F.col("capped"), cap)).over(whole), zero))
        .withColumn("sharing", F.coalesce(F.sum(F.when(~F.col("capped"), F.col("weight"))).over(whole), zero) * 100)
    )
    product = F.col("left") * F.col("weight")
    twice = F.expr(f"source_size * {MOST_PERCENT} div 100")
    return shared.select(
        *SOURCE, "source_size",
        F.when(F.col("capped"), cap / F.lit(100)).otherwise(product.cast("double") / F.col("sharing").cast("double")).alias("target"),
        F.when(F.col("capped"), twice).otherwise(F.expr("(left * weight) div sharing")).alias("budget"),
    )


def mix_plan(docs: DataFrame, source: str = "source", weights: tuple[int, ...] = WEIGHTS, seed: int = 9) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text and the source column): how many of its words the mix takes.

    Returns doc_id, mark, src, no_src, size, source_size, target, budget, taken. Each source's ``taken`` adds
    up to its budget, the target rounded down; the document at the cut gives the words that are still
    missing, later ones none in the last pass. Texts without words, and null texts, take 0; a null source
    is a source of its own, the last. Ties of the key go by identifier and size, so reruns agree. An empty
    table gives no rows; other columns are not looked at.
    """
    rows = checkpointed(sized(docs, source, seed))
    ranges = rows.groupBy(*SOURCE, "range").agg(F.sum("size").alias("range_size"))
    before = Window.partitionBy(*SOURCE).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.withColumn("offset", F.coalesce(F.sum("range_size").over(before), F.lit(0).cast("long")))
    totals = ranges.groupBy(*SOURCE).agg(F.sum("range_size").alias("source_size"))
    offsets = offsets.join(targets(totals, weights), list(SOURCE)).drop("range_size")

    inside = Window.partitionBy(*SOURCE, "range").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.withColumn("upto", F.sum("size").over(inside)).join(offsets, [*SOURCE, "range"])
    passes = F.when(F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(0)
    rest = F.col("budget") - passes * F.col("source_size") - (F.col("offset") + F.col("upto") - F.col("size"))
    taken = passes * F.col("size") + F.greatest(F.least(rest, F.col("size")), F.lit(0).cast("long"))
    return summed.select("doc_id", "mark", *SOURCE, "size", "source_size", "target", "budget", taken.cast("long").alias("taken"))


def mix_documents(docs: DataFrame, source: str = "source", weights: tuple[int, ...] = WEIGHTS, seed: int = 9) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, in whole documents; same columns.

    The document at a source's cut counts when at least half of it is inside. Rows that repeat an
    identifier, text and source are all taken as often as the first of them.
    """
    plan = mix_plan(docs, source, weights, seed).filter("taken > 0")
    copies = F.floor((2 * F.col("taken") + F.col("size")) / (2 * F.col("size"))).cast("int")
    often = plan.groupBy("doc_id", "mark", *SOURCE).agg(F.max(copies).alias("copies")).filter("copies > 0")
    sealed = Sealed(docs)
    same = (
        sealed["doc_id"].eqNullSafe(often["doc_id"])
        & (text_mark(F.coalesce(sealed["text"], F.lit(""))) == often["mark"])
        & (F.coalesce(sealed[source].cast("string"), F.lit("")) == often["src"])
        & (sealed[source].isNull() == often["no_src"])
    )
    taken = sealed.frame.join(often, same).withColumn("pass", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return sealed.opened(taken)
